"""Runs that read once, go on where the last one stopped, and leave a good lake when
they fail; small files on any store; content digests."""

import gzip
import json
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import normalize
from tallyspan.operators.publish import Publication, export, stale, verify
from tallyspan.plans import jobs
from tallyspan.sources import landing, ledger, readers, sinks, store

YEAR = 365 * 86400


def row(i, user, year, verdict="OK"):
    return {"id": i, "creationTimeSeconds": int(year * YEAR + (year // 4) * 86400 - 1970 * YEAR - 492 * 86400 + 86400 * 40), "verdict": verdict, "author": {"members": [{"handle": user}]}, "problem": {"contestId": i % 7, "index": "A"}}


def put(root, name, rows, raw=""):
    os.makedirs(root / "aa", exist_ok=True)
    with gzip.open(root / "aa" / f"{name}.jsonl.gz", "wt") as f:
        f.write("".join(json.dumps(r) + "\n" for r in rows) + raw)


@pytest.fixture
def zone(tmp_path):
    root = tmp_path / "in"
    put(root, "ann", [row(i, "ann", 2019 + i % 2) for i in range(10)])
    put(root, "bob", [row(i, "bob", 2019 + i % 2) for i in range(5, 15)])
    put(root, "again", [row(i, "again", 2019 + i % 2) for i in range(3)])  # first of its ids
    put(root, "zed", [row(i, "zed", 2019 + i % 2) for i in range(3)])  # nothing of its own
    put(root, "none", [], "\n \n")
    return tmp_path


def paths(zone):
    return [str(zone / x) for x in ("in", "lake", "reports")]


def scans(spark, folder):
    """How often executed plans have read JSON from a folder."""
    store_of = spark._jsparkSession.sharedState().statusStore()
    found, some = 0, store_of.executionsList()
    for i in range(some.size()):
        text = some.apply(i).physicalPlanDescription()
        parts = text.split("\n\n")
        found += sum("Scan json" in p and f"{folder}/" in p and p.lstrip().startswith("(") for p in parts)
    return found


def test_the_zone_is_read_once(spark, zone):
    src, lake, reports = paths(zone)
    before = scans(spark, src)
    counts = jobs.attempts_to_lake(spark, src, lake, reports)
    assert scans(spark, src) - before == 1
    want = normalize.census(readers.parquet(spark, lake), distinct=("submission_id", "problem_id", "handle"), true=("is_accepted",), null=("verdict",), extent=("submitted_year",)).first().asDict()
    assert {k: counts[k] for k in want} == want
    assert (counts["raw_rows"], counts["rows"], counts["duplicate_rows"]) == (26, 15, 11)
    # Of five files one is blank; one has only rows that others have too.
    assert (counts["files_on_disk"], counts["files_read"], counts["distinct_collected_via_handle"]) == (5, 4, 3)
    assert os.listdir(reports) == [f for f in os.listdir(reports) if f.endswith(".json")] and len(os.listdir(reports)) == 1


def test_a_failed_run_leaves_the_lake(spark, zone, monkeypatch):
    src, lake, reports = paths(zone)
    jobs.attempts_to_lake(spark, src, lake, reports)
    monkeypatch.setattr(jobs.normalize, "census", lambda df, **_: df.sparkSession.sql("select 1L rows, 1L distinct_submission_id"))
    with pytest.raises(ValueError, match="were written"):
        jobs.attempts_to_lake(spark, src, lake, reports)
    assert readers.parquet(spark, lake).count() == 15 and sorted(os.listdir(zone)) == ["in", "lake", "reports"]


def test_runs_by_ledger(spark, zone):
    src, lake, reports = paths(zone)
    book = str(zone / "ledger")
    run = lambda: jobs.attempts_increment(spark, src, lake, reports, book)
    files = lambda: {f: os.stat(f).st_mtime_ns for f in (os.path.join(d, n) for d, _, ns in os.walk(lake) for n in ns) if f.endswith(".parquet")}
    assert run()["run"] == "whole"
    first = files()
    assert run()["run"] == "skipped" and files() == first
    put(zone / "in", "aaa", [row(100, "aaa", 2020), row(1, "aaa", 2020)])  # one new, one that wins over "again"
    got = run()
    assert (got["run"], got["files_read"], got["raw_rows"], got["years"]) == ("increment", 1, 2, [2020])
    now = files()
    assert {f: t for f, t in first.items() if "2019" in f} == {f: t for f, t in now.items() if "2019" in f} and not {f for f in first if "2020" in f} & set(now)
    whole = str(zone / "whole")
    jobs.attempts_to_lake(spark, src, whole, reports)
    a, b = (readers.parquet(spark, x) for x in (lake, whole))
    assert a.count() == b.count() == 16 and sorted(a.collect()) == sorted(b.select(*a.columns).collect())
    assert a.where("submission_id = 1").first().collected_via_handle == "aaa"
    put(zone / "in", "aaa", [row(200, "aaa", 2021), row(201, "aaa", 2021), row(202, "aaa", 2021)])
    assert run()["run"] == "whole" and readers.parquet(spark, lake).where("submission_id = 1").first().collected_via_handle == "again"
    os.remove(zone / "in" / "aa" / "aaa.jsonl.gz")
    assert run()["run"] == "whole" and run()["run"] == "skipped" and readers.parquet(spark, lake).count() == 15
    shutil.rmtree(lake)
    assert run()["run"] == "whole" and readers.parquet(spark, lake).count() == 15


def test_an_attempt_whose_year_changed_moves(spark, zone):
    src, lake, reports = paths(zone)
    book = str(zone / "ledger")
    jobs.attempts_increment(spark, src, lake, reports, book)
    put(zone / "in", "aaa", [row(i, "aaa", 2022) for i in range(1, 15, 2)])  # all of 2020
    got = jobs.attempts_increment(spark, src, lake, reports, book)
    assert got["years"] == [2020, 2022]
    assert {r[0]: r[1] for r in readers.parquet(spark, lake).groupBy("submitted_year").count().collect()} == {2019: 8, 2022: 7}


def test_missing_zones_are_errors(spark, zone):
    src, lake, reports = paths(zone)
    for gone in (str(zone / "nowhere"), str(zone / "empty")):
        os.makedirs(str(zone / "empty"), exist_ok=True)
        with pytest.raises(FileNotFoundError):
            jobs.attempts_increment(spark, gone, lake, reports, str(zone / "ledger"))
        for session in (None, spark):
            with pytest.raises(FileNotFoundError):
                landing.landing_changed(gone, reports, session)
    report = sinks.report(reports, "x", {"files_on_disk": 5}, spark)
    assert not landing.landing_changed(src, report, spark) and landing.landing_changed(src, report + ".no", spark)
    put(zone / "in", "more", [])
    assert landing.landing_changed(src, report, spark)
    assert ledger.compare(ledger.zone_files(spark, src), ledger.known_files(spark, str(zone / "ledger"))).where("state = 'new'").count() == 6


def test_folders_replaced_or_left(spark, tmp_path):
    lake = str(tmp_path / "lake")
    df = spark.createDataFrame([(i, 2000 + i % 3) for i in range(30)], "k long, year int")
    sinks.missing_parts(df.where("year < 2002"), lake, "year")
    sinks.missing_parts(df.withColumn("k", F.col("k") + 1000), lake, "year")  # 2002 alone is missing
    assert {r[0]: r[1] for r in readers.parquet(spark, lake).where("k >= 1000").groupBy("year").count().collect()} == {2002: 10}
    sinks.lake_parts(df.where("year = 2001").limit(2), lake, "year")
    assert {r[0]: r[1] for r in readers.parquet(spark, lake).groupBy("year").count().collect()} == {2000: 10, 2001: 2, 2002: 10}


def test_many_empty_files_are_one_job(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"p{i:03}%5F.csv").write_text("a,b\n" if i % 2 else "")
    (tmp_path / "full.csv").write_text("a,b\n1,2\n")
    files = landing.listed(str(tmp_path))
    df = readers.csv_files(spark, [str(tmp_path / "full.csv")], "a int, b int", name_as="source_file")
    begun = time.time()
    spark.sparkContext.setJobGroup("accounting", "files")
    empty = landing.unread_files(files, df, "source_file")
    jobs_run = len(spark.sparkContext.statusTracker().getJobIdsForGroup("accounting"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(empty) == 300 and jobs_run < 12 and time.time() - begun < 60
    (tmp_path / "lost.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="lost"):
        landing.unread_files(landing.listed(str(tmp_path), spark), df, "source_file")


@pytest.fixture
def remote(spark, tmp_path):
    """A store that only Spark's file systems reach."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    name = tmp_path.name.replace("_", "-")  # mounts are kept by name
    conf.set(f"fs.viewfs.mounttable.{name}.link./data", f"file://{tmp_path}")
    return f"viewfs://{name}/data"


def test_small_files_on_another_store(spark, tmp_path, remote):
    df = spark.createDataFrame([("b", 9, 1.0), ("a", 2, None)], "country string, n int, mean double")
    rule = Publication(("country", "n", "mean"), ("-n", "country"), "As counted.", count="n", statistics=("mean",), least=5)
    for d in ("one", "two"):
        export(df, "t", f"{remote}/{d}", rule)
    assert verify(f"{remote}/one", {"t": rule}, spark=spark) == [] and stale(f"{remote}/one", f"{remote}/two", ["t"], spark) == []
    assert json.load(open(tmp_path / "one" / "t.json"))["row_count"] == 2
    path = f"{remote}/slice"
    sinks.sorted_slice(df, path, ["country"])
    sinks.write_manifest(path, sinks.artefact(spark, path) | {"digest": sinks.digests(df)}, spark)
    sinks.write_manifest(path, sinks.artefact(spark, path) | {"digest": sinks.digests(df)}, spark)  # over what is there
    assert sinks.verify_artefact(spark, path, content=True) == [] and os.path.exists(tmp_path / "slice.manifest.json")
    assert store.exists(sinks.report(f"{remote}/r", "run", {"a": 1}, spark), spark)
    assert not [n for d, _, names in os.walk(tmp_path) for n in names if n.endswith(".tmp")]


def test_a_whole_run_on_another_store(spark, zone, tmp_path, remote):
    src, lake, reports = (f"{remote}/{x}" for x in ("in", "lake", "reports"))
    assert jobs.attempts_increment(spark, src, lake, reports, f"{remote}/ledger")["files_read"] == 4
    assert jobs.attempts_increment(spark, src, lake, reports, f"{remote}/ledger")["run"] == "skipped"
    assert readers.parquet(spark, lake).count() == 15 and len([x for x in os.listdir(zone / "lake") if "=" in x]) == 2


def test_content_digests(spark, tmp_path):
    df = spark.createDataFrame([(i, f"s{i % 3}" if i % 5 else None, i / 7) for i in range(200)], "k long, s string, x double")
    sinks.sorted_slice(df, str(tmp_path / "a"), ["k"])
    df.orderBy(F.desc("x")).repartition(7).write.option("compression", "gzip").parquet(str(tmp_path / "b"))
    assert sinks.stale_content(spark, str(tmp_path / "a"), str(tmp_path / "b")) == []
    changed = df.withColumn("s", F.when(F.col("k") == 60, "").otherwise(F.col("s")))  # null to empty, one cell
    changed.write.parquet(str(tmp_path / "c"))
    assert sinks.stale_content(spark, str(tmp_path / "a"), str(tmp_path / "c")) == ["content of s", "content of (row)"]
    swapped = df.withColumn("s", F.when(F.col("k") == 1, "s2").when(F.col("k") == 2, "s1").otherwise(F.col("s")))
    swapped.write.parquet(str(tmp_path / "d"))  # the same values in other rows
    assert sinks.stale_content(spark, str(tmp_path / "a"), str(tmp_path / "d")) == ["content of (row)"]
    df.drop("x").write.parquet(str(tmp_path / "e"))
    assert sinks.stale_content(spark, str(tmp_path / "a"), str(tmp_path / "e")) == ["missing x"]
    assert sinks.content_digest(df.limit(0), {"all": df.columns}).first().asDict() == {"rows": 0, "all": "0"}
    sinks.write_manifest(str(tmp_path / "a"), sinks.artefact(spark, str(tmp_path / "a")) | {"digest": sinks.digests(df)}, spark)
    assert sinks.verify_artefact(spark, str(tmp_path / "a"), content=True) == []
    (tmp_path / "a" / "_manifest.json").unlink()
    sinks.write_manifest(str(tmp_path / "a"), sinks.artefact(spark, str(tmp_path / "a")) | {"digest": sinks.digests(changed)}, spark)
    assert len(sinks.verify_artefact(spark, str(tmp_path / "a"), content=True)) == 1


def test_census_copies_no_rows(spark, sf_dir):
    l = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    got = normalize.census(l, distinct=("l_orderkey", "l_partkey", "l_suppkey"))
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.first().asDict() == l.agg(F.count("*").alias("rows"), *[F.countDistinct(c).alias(f"distinct_{c}") for c in ("l_orderkey", "l_partkey", "l_suppkey")]).first().asDict()
