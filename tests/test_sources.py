import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import dimensions, normalize, quality
from tallyspan.operators.publish import Publication, export, stale, verify
from tallyspan.sources import landing, readers, sinks
from tallyspan.sources.landing import landing_changed


def attempt(i, *, members=("ann",), ghost=None, contest=5, index="A", problemset=None, verdict="OK", at=1577836799, tags=("dp",), kind="CONTESTANT"):
    return {
        "id": i, "contestId": 9, "creationTimeSeconds": at, "verdict": verdict, "points": 1.5, "unknown": 1,
        "author": {"ghost": ghost, "participantType": kind, "members": [{"handle": m, "secret": 1} for m in members]},
        "problem": {"contestId": contest, "index": index, "name": "N", "points": 2.5, "problemsetName": problemset, "tags": list(tags)},
    }


@pytest.fixture
def zone(tmp_path):
    def put(shard, name, rows):
        os.makedirs(tmp_path / "in" / shard, exist_ok=True)
        with gzip.open(tmp_path / "in" / shard / f"{name}.jsonl.gz", "wt") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)

    put("0a", "zoe", [attempt(1), attempt(2, members=("ann", "bob")), attempt(3, ghost=True), attempt(4, verdict=None, kind=None)])
    put("0b", "%5Fann", [attempt(1), attempt(5, contest=None, problemset="acm"), attempt(6, contest=None), attempt(7, at=1577836800, verdict="NEW", tags=())])
    return str(tmp_path / "in")


def test_attempts_from_landing_zone(spark, zone):
    raw = readers.json_lines(spark, landing.shard_globs(zone), readers.ATTEMPT_JSON, name_as="collected_via_handle")
    flat = normalize.classify_attempts(normalize.normalize_attempts(raw)).cache()
    got = {r.submission_id: r for r in flat.collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7} and len(flat.columns) == 34
    assert got[1].collected_via_handle == "_ann"
    assert (got[1].is_person_level, got[2].is_person_level, got[2].handle, got[3].is_person_level, got[1].handle) == (True, False, None, False, "ann")
    assert (got[1].problem_id, got[5].problem_id, got[6].problem_id) == ("5A", "acmA", None)
    assert (got[1].points_scored, got[1].problem_points, got[1].problem_tags) == (1.5, 2.5, ["dp"])
    assert (got[4].is_accepted, got[4].is_contest, got[4].verdict_class, got[4].is_evidence) == (False, False, "unjudged", False)
    assert (got[7].verdict_class, got[7].submitted_year, got[1].submitted_year) == ("unknown", 2020, 2019)
    assert landing.corpus_counts(raw) == {"attempts": 7, "one_person": 7}
    one = readers.json_lines(spark, landing.shard_globs(zone, ["0a"]), readers.ATTEMPT_JSON)
    assert one.count() == 4


def test_dimensions_and_facts(spark, zone, tmp_path):
    raw = readers.json_lines(spark, landing.shard_globs(zone), readers.ATTEMPT_JSON, name_as="collected_via_handle")
    flat = normalize.classify_attempts(normalize.normalize_attempts(raw))
    (tmp_path / "set.jsonl").write_text(json.dumps({"problem_id": "5A", "problem_rating": 1500, "problem_tags": ["a", "b"], "solved_count": 3}) + "\n")
    (tmp_path / "users.json").write_text(json.dumps({"status": "OK", "result": [{"handle": "zoe", "rating": 1500, "registrationTimeSeconds": 1577836799, "avatar": "x"}, {"handle": "_ann"}]}))
    problems = dimensions.problem_dimension(flat, readers.json_lines(spark, [str(tmp_path / "set.jsonl")], readers.PROBLEMSET_JSON)).cache()
    users = dimensions.user_dimension(readers.users(spark, str(tmp_path / "users.json"), "2024-01-01"))
    by = {r.problem_key: r for r in problems.collect()}
    assert set(by) == {"5A", "acmA"}
    assert (by["5A"].problem_tags, by["5A"].tags_source, by["5A"].in_public_problemset, by["5A"].is_unrated, by["acmA"].tags_source) == (["a", "b"], "problemset", True, True, "submissions")
    facts = dimensions.facts(flat, problems, users)
    assert facts.count() == 6 and len(facts.columns) == 22
    assert {r.user_key for r in facts.collect()} == {"zoe", "_ann"}


def test_hidden_and_unread_files(spark, zone, tmp_path):
    assert landing.audited(zone) == 2
    open(os.path.join(zone, "0a", "_x.jsonl.gz"), "w").close()
    with pytest.raises(ValueError, match="_x"):
        landing.audited(zone)
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "p1.csv").write_text("a,b\n1,2\n")
    (folder / "p2.csv").write_text("a,b\n")
    files = [str(folder / f) for f in ("p1.csv", "p2.csv")]
    df = readers.csv_files(spark, files, "a int, b int", name_as="source_file")
    assert landing.unread_files(files, df, "source_file") == [files[1]]
    with pytest.raises(ValueError, match="p1"):
        landing.unread_files(files, df.where("false"), "source_file")


def test_reordered_csv_header_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.csv_files(spark, [str(tmp_path / "x.csv")], "a int, b int").collect()


def test_ratings_look_for_biweekly_first(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([{"TitleSlug": s, "ContestSlug": c, "Rating": 1.5} for s, c in (("a", "weekly-contest-1"), ("b", "biweekly-contest-1"), ("c", "cup"))]))
    assert {r.title_slug: r.contest_type for r in readers.ratings(spark, str(tmp_path / "r.json")).collect()} == {"a": "weekly", "b": "biweekly", "c": "other"}


def test_lake_slice_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([(i, 2019 + i % 2) for i in range(20)], "k long, year int")
    sinks.lake(df, str(tmp_path / "lake"), "year")
    assert sorted(x for x in os.listdir(tmp_path / "lake") if x.startswith("year=")) == ["year=2019", "year=2020"]
    assert readers.parquet(spark, str(tmp_path / "lake")).where("year = 2020").count() == 10
    sinks.json_lines(df, str(tmp_path / "lines"))
    assert readers.json_lines(spark, [str(tmp_path / "lines")], "k long").count() == 20
    sinks.sorted_slice(df, str(tmp_path / "slice"), ["k"])
    found = sinks.artefact(spark, str(tmp_path / "slice"))
    assert found["rows"] == 20
    assert sinks.manifest_differences({"rows": 20, "schema": [["k", "bigint"], ["year", "int"]]}, found) == []
    assert sinks.manifest_differences({"rows": 21, "schema": [["year", "int"], ["k", "bigint"]]}, found) == ["rows: 21 to 20", "reordered columns"]
    assert sinks.schema_differences([["a", "int"], ["b", "int"]], [["b", "string"], ["c", "int"]]) == ["missing a", "extra c", "retyped b: int to string"]


def test_publication_gate(spark, tmp_path):
    rule = Publication(("country", "n", "mean"), ("-n", "country"), "As counted.", count="n", statistics=("mean",), least=5)
    df = spark.createDataFrame([("b", 9, 1.0), ("a", 2, None)], "country string, n int, mean double")
    for d in ("one", "two"):
        export(df, "t", str(tmp_path / d), rule)
    assert verify(str(tmp_path / "one"), {"t": rule}, denied=("handle",)) == [] and stale(str(tmp_path / "one"), str(tmp_path / "two"), ["t"]) == []
    with pytest.raises(ValueError, match="handle"):
        export(df.withColumnRenamed("mean", "handle"), "t", str(tmp_path / "x"), rule)
    export(df.na.fill({"mean": 7.0}), "t", str(tmp_path / "two"), rule)
    assert verify(str(tmp_path / "two"), {"t": rule}) == ["t: a cell of 2 has statistics"] and stale(str(tmp_path / "one"), str(tmp_path / "two"), ["t"]) == ["t"]
    assert verify(str(tmp_path), {"t": rule}) == ["t: no file"]
    assert [r["country"] for r in json.load(open(tmp_path / "one" / "t.json"))["rows"]] == ["b", "a"]
    export(df, "t", str(tmp_path / "three"), Publication(rule.columns, rule.order))
    assert verify(str(tmp_path / "three"), {"t": rule}) == ["t: no caveat"]


def test_a_large_folder_is_written_by_many_tasks(spark, tmp_path):
    """One year of rows, far over the advised size, is not one task's work, and
    small years are not torn."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        df = spark.range(300_000, numPartitions=40).selectExpr("id as k", "md5(cast(id as string)) as v", "if(id % 1000 = 0, 2018, 2019) as year")
        sinks.lake(df, str(tmp_path / "lake"), "year")
    finally:
        spark.conf.set(key, before)
    files = {y: len([f for f in os.listdir(tmp_path / "lake" / f"year={y}") if f.endswith(".parquet")]) for y in (2018, 2019)}
    assert files[2019] > 8 and files[2018] <= 4
    assert readers.parquet(spark, str(tmp_path / "lake")).count() == 300_000


def test_artefact_manifest_and_sidecar(spark, tmp_path):
    path = str(tmp_path / "a")
    df = spark.range(10).withColumnRenamed("id", "k")
    sinks.sorted_slice(df, path, ["k"])
    assert len(sinks.verify_artefact(spark, path)) == 2
    beside, sidecar = sinks.write_manifest(path, {"more": 1} | sinks.artefact(spark, path))
    assert sinks.verify_artefact(spark, path) == []
    sinks.sorted_slice(df.where("k < 9").withColumn("x", F.lit(1)), path, ["k"])
    assert sinks.verify_artefact(spark, path) == [f"no {sidecar}", "rows: 10 to 9", "extra x"]
    with open(sidecar, "w") as f:
        f.write("{}")
    assert "manifest and sidecar differ" in sinks.verify_artefact(spark, path)


def test_views_tables_and_the_catalogue(spark, tmp_path):
    df = quality.inline(spark, [("u1", 1), ("u2", None)], "handle string, n int")
    assert [tuple(r) for r in df.collect()] == [("u1", 1), ("u2", None)]
    sinks.materialise(df, "obs_bad", "staging")
    sinks.temp_view(df.select("n"), "obs_good")
    try:
        assert spark.sql("select count(*) from obs_bad").first()[0] == 2
        found = {(r.table, r.column, r.type) for r in quality.catalogue(spark).collect()}
        assert {("obs_bad", "handle", "string"), ("obs_good", "n", "int")} <= found
        assert [(r.table, r.column) for r in quality.denied_in_catalogue(spark, ["handle"], "obs_").collect()] == [("obs_bad", "handle")]
    finally:
        spark.catalog.dropTempView("obs_bad"), spark.catalog.dropTempView("obs_good")
    assert sinks.MATERIALISED == {"staging": "view", "marts": "table"}


def test_small_json_lines_are_whole_or_absent(tmp_path):
    path = str(tmp_path / "d" / "x.jsonl.gz")
    sinks.json_lines_file([{"b": 1, "a": "é"}], path)
    assert gzip.open(path, "rt", encoding="utf-8").read() == '{"a": "é", "b": 1}\n' and os.listdir(tmp_path / "d") == ["x.jsonl.gz"]


def test_files_of_any_store(spark, zone):
    """Listing by Spark's file systems finds what the local listing finds."""
    uri = f"file://{zone}"
    assert landing.audited(uri, spark) == landing.audited(zone) == 2
    open(os.path.join(zone, "0b", ".x.jsonl.gz"), "w").close()
    assert [f.rsplit("/", 1)[-1] for f in landing.hidden_files(uri, spark)] == [".x.jsonl.gz"]
    with pytest.raises(ValueError, match="1 files"):
        landing.audited(uri, spark)


def test_hidden_files_are_renamed_once(zone):
    names = ["_x.jsonl.gz", ".y.jsonl.gz"]
    for n in names:
        open(os.path.join(zone, "0a", n), "w").close()
    plan = landing.migrate(zone)
    assert sorted(os.path.basename(t) for t in plan.values()) == ["%2Ey.jsonl.gz", "%5Fx.jsonl.gz"] and len(landing.hidden_files(zone)) == 2
    with pytest.raises(RuntimeError, match="collection"):
        landing.migrate(zone, apply=True)
    assert len(landing.migrate(zone, apply=True, force=True)) == 2
    assert landing.hidden_files(zone) == [] and landing.migrate(zone, apply=True) == {}
    open(os.path.join(zone, "0a", "_x.jsonl.gz"), "w").close()
    with pytest.raises(FileExistsError):
        landing.migrate(zone, apply=True, force=True)


def test_corpus_count_fails_on_a_gap(spark, zone):
    raw = readers.json_lines(spark, landing.shard_globs(zone), readers.ATTEMPT_JSON, name_as="collected_via_handle")
    files = landing.listed(zone)
    assert landing.counted_corpus(raw, files, "collected_via_handle") == {"attempts": 7, "one_person": 7, "files": 2}
    with pytest.raises(ValueError, match="zoe"):
        landing.counted_corpus(raw.where("collected_via_handle <> 'zoe'"), files, "collected_via_handle")


def test_census_by_values(spark):
    df = quality.inline(spark, [("OK", "C"), ("OK", None), ("bad", "C")], "status string, language string")
    got = {(r.column, r.value): r.n for r in normalize.census_by(df, ("status", "language")).collect()}
    assert got == {("status", "OK"): 2, ("status", "bad"): 1, ("language", "C"): 2, ("language", None): 1}


def test_landing_change(zone, tmp_path):
    assert landing_changed(zone, str(tmp_path / "none.json"))
    path = sinks.report(str(tmp_path / "r"), "run", {"files_on_disk": 2})
    assert not landing_changed(zone, path)
