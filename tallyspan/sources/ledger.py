"""Which files of a landing zone earlier runs have read: a table of path, size and
time of change, with the run that read them, to which each run adds its files.

A zone is listed as a DataFrame (the files' content is not read), so comparing it
with the ledger is a join. Edge cases: a zone that does not exist, or holds no
file, is an error and never "unchanged"; without a ledger all files are new; of
several entries of a path the latest counts; a path may not be null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.operators.rows import first_per_key
from tallyspan.session import settled
from tallyspan.sources import store

_ENTRY = "path string, length long, changed_at timestamp"


def zone_files(spark: SparkSession, root: str, pattern: str = "*.jsonl.gz") -> DataFrame:
    """(path, length, changed_at) of a zone's files."""
    if not store.exists(root, spark):
        raise FileNotFoundError(f"no landing zone at {root}")
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(root)
    files = settled(files.select("path", "length", F.col("modificationTime").alias("changed_at")))
    if files.isEmpty():
        raise FileNotFoundError(f"the landing zone at {root} holds no {pattern}")
    return files


def known_files(spark: SparkSession, ledger: str) -> DataFrame:
    """The latest entry of each path."""
    if not store.exists(ledger, spark):
        return spark.createDataFrame([], _ENTRY)
    rows = spark.read.parquet(ledger)
    return first_per_key(rows, ["path"], [F.desc("recorded_at"), F.desc("changed_at")]).where("length is not null").select("path", "length", "changed_at")


def compare(files: DataFrame, known: DataFrame) -> DataFrame:
    """(path, state) of all that is not as it was: new, changed or gone."""
    met = files.alias("f").join(known.alias("k"), F.col("f.path") == F.col("k.path"), "full_outer")
    same = (F.col("f.length") == F.col("k.length")) & (F.col("f.changed_at") == F.col("k.changed_at"))
    state = F.when(F.col("k.path").isNull(), "new").when(F.col("f.path").isNull(), "gone").when(~same, "changed")
    return met.select(F.coalesce("f.path", "k.path").alias("path"), state.alias("state")).where("state is not null")


def record(files: DataFrame, known: DataFrame, ledger: str, run: str) -> None:
    """Adds a run's files to the ledger, and of files that are gone that they are
    (an entry without a length)."""
    gone = known.join(files, "path", "left_anti").select("path", F.lit(None).cast("long").alias("length"), F.lit(None).cast("timestamp").alias("changed_at"))
    new = files.join(known, ["path", "length", "changed_at"], "left_anti")
    stamp = {"run": F.lit(run), "recorded_at": F.current_timestamp()}
    settled(new.unionByName(gone).withColumns(stamp)).coalesce(1).write.mode("append").parquet(ledger)


