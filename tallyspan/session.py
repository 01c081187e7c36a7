"""The session every job and test runs under."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Own folders by application, made on one machine only.
_OWN: dict[str, str] = {}


def build_session(
    app: str = "tallyspan",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session pinned to UTC, with adaptive execution on.

    Driver memory must be known before the JVM starts, so it travels by
    PYSPARK_SUBMIT_ARGS; on a cluster leave master and memory to spark-submit.
    """
    if driver_memory and "PYSPARK_SUBMIT_ARGS" not in os.environ:
        os.environ["PYSPARK_SUBMIT_ARGS"] = f"--driver-memory {driver_memory} pyspark-shell"
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    if master and master.startswith("local"):
        settings |= {"spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1"}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in (settings | (conf or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the
    session. Only on one machine (a local master, as in tests) a temporary folder
    stands in where that is unset; on a cluster its files would be lost to the
    other machines, so there it is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="tallyspan-")
        atexit.register(shutil.rmtree, _OWN[app], True)
    return f"file://{_OWN[app]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def settled(df: DataFrame) -> DataFrame:
    """df as it comes out now, in the shared folder: whatever executor is lost
    later, it is not computed anew (and perhaps dealt anew)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
