import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import dimensions, normalize, rules
from tallyspan.operators.publish import verify
from tallyspan.operators.snapshot import problemset, together
from tallyspan.plans import jobs
from tallyspan.sources import readers, sinks


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("w")
    verdicts = ["OK", "WRONG_ANSWER", "TIME_LIMIT_EXCEEDED", "PARTIAL", "SKIPPED"]
    i = 0
    for u in range(6):
        os.makedirs(root / "in" / f"{u:02x}", exist_ok=True)
        with gzip.open(root / "in" / f"{u:02x}" / f"user{u}.jsonl.gz", "wt") as f:
            for p in range(5):
                for again in range(2):
                    i += 1
                    row = {"id": i, "creationTimeSeconds": 1546300800 + (u + p + again) * 86400 * 120, "verdict": verdicts[(u + p + again) % 5], "author": {"members": [{"handle": f"user{u}"}], "participantType": "CONTESTANT" if p % 2 else "PRACTICE"}}
                    f.write(json.dumps(row | {"problem": {"contestId": 100 + p, "index": "A", "name": "Same" if p < 2 else f"P{p}", "rating": None if p < 2 else 1000 + p, "tags": ["dp", "math"][: p % 3]}}) + "\n")
            if u == 1:  # seen before, under another name
                f.write(json.dumps({"id": 1, "creationTimeSeconds": 1546300800, "author": {"members": [{"handle": "user0"}]}, "problem": {"contestId": 100, "index": "A"}}) + "\n")
    users = [{"handle": f"user{u}", "rating": 1000 + 300 * u, "country": "X" if u else None, "organization": " U  1", "registrationTimeSeconds": 1262304000 + u * 86400 * 700} for u in range(6)]
    (root / "users.json").write_text(json.dumps({"status": "OK", "result": users}))
    (root / "set.jsonl").write_text("".join(json.dumps({"problem_id": f"{100 + p}A", "problem_rating": 1000 + p, "problem_tags": ["t"], "solved_count": p}) + "\n" for p in (0, 2, 3)))
    counts = jobs.attempts_to_lake(spark, str(root / "in"), str(root / "lake"), str(root / "reports"))
    attempts = normalize.classify_attempts(readers.parquet(spark, str(root / "lake")))
    problems = dimensions.problem_dimension(attempts, readers.json_lines(spark, [str(root / "set.jsonl")], readers.PROBLEMSET_JSON)).cache()
    people = dimensions.user_dimension(readers.users(spark, str(root / "users.json"), "2024-01-01")).cache()
    return root, counts, dimensions.facts(attempts, problems, people).cache(), people, problems


def test_lake_counts(warehouse):
    root, counts, facts, *_ = warehouse
    assert (counts["rows"], counts["raw_rows"], counts["duplicate_rows"], counts["files_read"], counts["distinct_problem_id"]) == (60, 61, 1, 6, 5)
    assert facts.count() == 60 and len(os.listdir(root / "reports")) == 1


def test_published_tables_pass_their_gate(warehouse):
    root, _, facts, people, problems = warehouse
    jobs.publish(facts, people, problems, str(root / "out"), least=6)
    assert jobs.verify_published(str(root / "out")) == []
    assert verify(str(root / "out"), jobs.PUBLICATIONS, denied=("country",)) != []
    table = json.load(open(root / "out" / "obs_organization_participation.json"))
    assert [r["organization"] for r in table["rows"]] == ["U 1"] and table["rows"][0]["most_common_country"] == "X"
    tags = json.load(open(root / "out" / "obs_tag_landscape.json"))
    assert {r["tag"]: r["from_problemset"] for r in tags["rows"]}["t"] == 3
    bands = json.load(open(root / "out" / "obs_rating_distribution.json"))
    bands["rows"][0]["cohort_users"] += 1
    (root / "out" / "obs_rating_distribution.json").write_text(json.dumps(bands))
    assert jobs.verify_published(str(root / "out")) == ["obs_rating_distribution and obs_country_participation count different populations"]


def test_response_artefact(spark, warehouse):
    root, _, facts, _, problems = warehouse
    m = jobs.build_responses(facts, problems, str(root / "matrix"), cutoff="2020-06-01")
    assert m["twins"] == 1 and m["merged_items"] == 1 and m["responses"] < m["unmerged_responses"]
    assert m["merged_attempts"] == m["attempts"] == facts.where("is_evidence and is_person_level").count()
    assert m["rows"] == m["responses"] == spark.read.parquet(str(root / "matrix")).count()
    assert sinks.verify_artefact(spark, str(root / "matrix")) == [] and m["gap_matches"] == m["qualifying"] == 1
    assert json.load(open(root / "matrix.manifest.json"))["train"] == m["train"] > 0 < m["test"]
    with pytest.raises(ValueError, match="bank is"):
        jobs.build_responses(facts, problems, str(root / "other"), cutoff="2020-06-01", pins={"bank": 0})
    assert not os.path.exists(root / "other")


def test_slices_name_nobody(spark, warehouse):
    root, _, facts, people, _ = warehouse
    n = jobs.slices_without_identities(facts, people, str(root / "slices"), (2019, 2020))
    assert n["users"] == 6 and n["facts"] == facts.where("submitted_year between 2019 and 2020").count()
    assert not {"user_key", "handle"} & set(spark.read.parquet(str(root / "slices" / "facts")).columns)
    with pytest.raises(ValueError, match="not over"):
        jobs.slices_without_identities(facts, people, str(root / "x"), (2019, 2030))


def test_metadata_run(spark, tmp_path):
    head = "submission_id,problem_id,user_id,date,language,original_language,filename_ext,status,cpu_time,memory,code_size,accuracy\n"
    (tmp_path / "p1.csv").write_text(head + "s1,p1,u,1577836799,C,C,c,Accepted,1,2,3,4/4\ns2,p1,u,1577836800,C,C,c,Runtime Error,-1,2,3,0/4\n")
    (tmp_path / "p2.csv").write_text(head)
    (tmp_path / "index.csv").write_text("id,name,dataset,time_limit,memory_limit,rating,tags,complexity\np1,One,AIZU,1,2,,,\n")
    got = jobs.metadata_to_lake(spark, str(tmp_path), "index.csv", str(tmp_path / "lake"), str(tmp_path / "r"))
    assert (got["rows"], got["files"], got["empty_files"], got["true_has_corrupt_timing"], got["true_unknown"]) == (2, 2, ["p2.csv"], 1, 0)
    assert sorted(x for x in os.listdir(tmp_path / "lake") if "=" in x) == ["submitted_year=2019", "submitted_year=2020"]
    (tmp_path / "p3.csv").write_text(head + "s1,p1,u,1577836799,C,C,c,Accepted,1,2,3,4/4\n")
    with pytest.raises(ValueError, match="3 rows have 2 ids"):
        jobs.metadata_to_lake(spark, str(tmp_path), "index.csv", str(tmp_path / "lake"), str(tmp_path / "r"))


def test_snapshot(spark):
    p = "contestId int, index string, name string, type string, points double, rating int, tags array<string>, problemsetName string"
    s = "contestId int, index string, problemsetName string, solvedCount int"
    rows = [(1, "A", "x", "P", None, 800, ["a"], None), (None, "7", "y", "P", None, None, [], "old")]
    good = problemset(spark.createDataFrame(rows, p), spark.createDataFrame([(1, "A", None, 5)], s), "2024-01-01")
    assert {(r.problem_id, r.solved_count, r.problemset_source) for r in good.collect()} == {("1A", 5, "main"), ("old7", None, "main")}
    # A named set's statistics carry no name; the last of several counts, and one
    # without a count says nothing.
    named = problemset(spark.createDataFrame(rows[1:], p), spark.createDataFrame([(None, "7", None, 8), (None, "7", None, 9), (None, "7", None, None), (None, "6", None, None)], s).coalesce(1), "t", name="old")
    assert [(r.problem_id, r.solved_count, r.problemset_source, r.problem_tags) for r in named.collect()] == [("old7", 9, "old", [])]
    with pytest.raises(ValueError, match="no key"):
        problemset(spark.createDataFrame(rows, p), spark.createDataFrame([(None, "7", None, 8)], s), "t")
    bare = problemset(spark.createDataFrame([(2, "B", "z", "P", None, 1, None, None)], p), spark.createDataFrame([], s), "t").first()
    assert bare.problem_tags == [] and bare.solved_count is None
    with pytest.raises(ValueError, match="several sets"):
        together([named, named])
    assert together([good.where("problem_id = '1A'"), named]).count() == 2
    with pytest.raises(ValueError, match="1A occurs 2"):
        problemset(spark.createDataFrame([*rows, rows[0]], p), spark.createDataFrame([(1, "A", None, 5)], s), "x")
    with pytest.raises(ValueError, match="2B"):
        problemset(spark.createDataFrame(rows, p), spark.createDataFrame([(2, "B", None, 5)], s), "x")


def test_rules_can_fail(spark):
    df = spark.createDataFrame([("p00001", "A", 1, "unknown", "new"), ("xp00002", "B", None, "ok", "old"), ("p00001", "C", 2, "ok", "old")], "k string, j string, r int, kind string, raw string")
    assert [tuple(r) for r in rules.unknown_classes(df, "kind", "raw").collect()] == [("new", 1)]
    assert rules.outside_partition(df, "j", ["A", "B", "C"], "k", "p[0-9]{5}").count() == 1
    assert {r.k for r in rules.unresolved_ids(df, df.where("k = 'p00001'"), "k").collect()} == {"xp00002"}
    assert rules.uncovered(df, df, "k", "k").count() == 1 and rules.uncovered(df, df.select("k").distinct(), "k", "k").count() == 0
    assert [r.k for r in rules.ambiguous_keys(df, "k", ["j", "r"]).collect()] == ["p00001"]
    assert rules.disagreeing(df.where("j = 'B'"), df.where("j = 'B'").withColumn("r", F.lit(3)), "k", "r").count() == 1
    people = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    shown = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "g string, m double")
    assert [tuple(r) for r in rules.small_cells(shown, people, "g", ["m"], 2).collect()] == [("b", 1)]


def test_invented_inputs_run_from_files_to_tables(spark, tmp_path):
    from tallyspan.operators import history
    from tallyspan.plans import fixtures

    root = str(tmp_path)
    made = fixtures.write(root)
    again = fixtures.write(str(tmp_path / "again"))
    assert made == again and open(f"{root}/users.json").read() == open(f"{root}/again/users.json").read()
    counts = jobs.attempts_to_lake(spark, f"{root}/landing", f"{root}/lake", f"{root}/reports")
    assert (counts["rows"], counts["duplicate_rows"], counts["files_read"], counts["distinct_collected_via_handle"]) == (made["attempts"], made["repeats"], made["users"], made["users"])
    meta = jobs.metadata_to_lake(spark, f"{root}/metadata", "index.csv", f"{root}/lake2", f"{root}/reports")
    assert (meta["rows"], meta["empty_files"], meta["true_unknown"]) == (made["metadata"], ["p00002.csv"], 0)
    attempts = normalize.classify_attempts(readers.parquet(spark, f"{root}/lake"))
    assert rules.unknown_classes(attempts, "verdict_class", "verdict").count() == 0
    problems = dimensions.problem_dimension(attempts, readers.json_lines(spark, [f"{root}/problems.jsonl"], readers.PROBLEMSET_JSON))
    people = dimensions.user_dimension(readers.users(spark, f"{root}/users.json", "2024-01-01"))
    assert history.violations({"problem": (problems, "problem_key"), "user": (people, "user_key")}).count() == 0
    facts = dimensions.facts(attempts, problems, people)
    jobs.publish(facts, people, problems, f"{root}/out")
    assert jobs.verify_published(f"{root}/out") == []
    m = jobs.build_responses(facts, problems, f"{root}/matrix", cutoff="2020-01-01")
    assert m["twins"] == 1 and sinks.verify_artefact(spark, f"{root}/matrix") == []
