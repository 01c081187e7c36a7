import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import dimensions, history, normalize, observatory, quality, responses, rows

DAY = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_first_and_richest_rows(spark):
    df = spark.createDataFrame([(1, "b", ["x"]), (1, "a", ["y", "z"]), (2, "c", None), (1, "d", ["a", "z"])], "k int, h string, t array<string>")
    assert {(r.k, r.h) for r in rows.first_per_key(df, ["k"], [F.col("h").asc()]).collect()} == {(1, "a"), (2, "c")}
    assert {(r.k, r.h) for r in rows.richest_per_key(df, ["k"], "t", ["h"]).collect()} == {(1, "d"), (2, "c")}


def test_versions_and_as_of(spark):
    states = spark.createDataFrame([("u", DAY(3), "x"), ("u", DAY(9), "y"), ("v", DAY(5), "z")], "k string, since timestamp_ntz, a string")
    dim = history.versions(states, "k", "since", ["a"]).cache()
    assert {(r.k, r.a, r.is_current) for r in dim.collect()} == {("u", "x", False), ("u", "y", True), ("v", "z", True)}
    assert dim.where("valid_from = timestamp_ntz'1970-01-01'").count() == 2
    facts = spark.createDataFrame([("u", DAY(0)), ("u", DAY(9)), ("u", DAY(8)), ("w", DAY(1))], "who string, at timestamp_ntz")
    got = rows.as_of(facts, dim, key="who", version_key="k", at="at", keep=["a", "sk"])
    assert sorted(r.a for r in got.collect()) == ["x", "x", "y"]
    assert history.violations({"d": (dim, "k")}).count() == 0
    assert history.outside(got, dim, "at").count() == 0


def test_facts_outside_are_counted_for_few_versions_and_many(spark):
    states = spark.createDataFrame([(k, DAY(i), "x") for k in range(3) for i in range(0, 10 * (k + 1), 3)], "k int, since timestamp_ntz, a string")
    dim = history.versions(states, "k", "since", ["a"]).cache()
    facts = spark.createDataFrame([(i % 4, DAY(i % 37)) for i in range(300)] + [(1, None), (None, DAY(1))], "who int, at timestamp_ntz")
    given = rows.as_of(facts, dim, key="who", version_key="k", at="at", keep=["sk"]).withColumnRenamed("who", "k")
    # Facts a day off their version's begin are moved out of it.
    moved = given.withColumn("at", F.when(F.dayofmonth("at") % 5 == 0, F.col("at") - F.expr("INTERVAL 3 DAYS")).otherwise(F.col("at")))
    opens = {"own": F.col("valid_from"), "late": F.col("valid_from") + F.expr("INTERVAL 2 DAYS")}
    want = tuple(history.outside(moved, dim.withColumn("valid_from", c), "at").count() for c in opens.values())
    assert 0 < want[0] < want[1] < moved.count()
    for few in (100, 2):
        many = rows.keys_of_many(dim, "k", few)
        assert many.isEmpty() == (few == 100)
        assert tuple(history.count_outside(moved, dim, "at", key="k", many=many, opens=opens).first()) == want
    assert tuple(history.count_outside(moved.limit(0), dim, "at", key="k", many=many, opens=opens).first()) == (0, 0)


def test_version_rules_can_fail(spark):
    good = [("a", DAY(0), DAY(5), False), ("a", DAY(5), None, True)]
    for bad, check in (
        ([("a", DAY(0), DAY(6), False), ("a", DAY(5), None, True)], "overlap"),
        ([("a", DAY(0), DAY(5), False), ("a", DAY(0), None, True)], "overlap"),
        ([("a", DAY(0), DAY(5), False)], "single_current"),
        ([("a", DAY(0), DAY(5), True), ("a", DAY(5), None, True)], "single_current"),
    ):
        schema = "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
        found = history.violations({"good": (spark.createDataFrame(good, schema), "k"), "bad": (spark.createDataFrame(bad, schema), "k")}).collect()
        assert {(r.check, r.key) for r in found} == {(check, "bad:a")}


def test_number_keys_and_sets(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "k string")
    assert sorted(((r.k, r.n) for r in rows.number_keys(df, "k", "n").collect()), key=str) == [("a", 1), ("a", 1), ("b", 2), ("c", 3), (None, None)]
    other = spark.createDataFrame([("a",), (None,)], "k string")
    assert {r.k for r in rows.missing_keys(df, other, "k").collect()} == {"b", "c"}
    assert sorted((r.k, r.f) for r in rows.exists_flag(df.na.drop(), other, "k", "f").collect()) == [("a", True), ("a", True), ("b", False), ("c", False)]


def test_difference_finds_rows_values_and_nulls(spark):
    schema = "k string, n int, m double"
    a = spark.createDataFrame([("x", 1, 1.0), ("y", 2, None), ("z", 3, 1.0), ("w", 1, None)], schema)
    b = spark.createDataFrame([("x", 1, 1.005), ("y", 2, 1.0), ("z", 4, 1.5), ("v", 1, None)], schema)
    got = {(r.k, r.column) for r in rows.difference(a, b, "k", ["n"], ["m"]).collect()}
    assert got == {("y", "m"), ("z", "n"), ("z", "m"), ("w", "(row)"), ("v", "(row)")}


def test_sample_takes_whole_small_groups(spark):
    df = spark.createDataFrame([("g", i) for i in range(20)] + [("h", i) for i in range(3)] + [("i", i) for i in range(4)], "g string, k int")
    a = rows.sample_per_group(df, "g", "k", {"g": 5, "h": 10, "i": 0}, seed=1).collect()
    assert {g: sum(r.g == g for r in a) for g in "ghi"} == {"g": 5, "h": 3, "i": 4}
    assert sorted(a) == sorted(rows.sample_per_group(df, "g", "k", {"g": 5, "h": 10, "i": 0}, seed=1).collect())


def items(spark):
    data = [("100A", "Alpha", 100, 1500, True), ("101A", "Alpha", 101, 1500, False), ("200B", "Beta", 200, 1800, True), ("300C", "Gamma", 300, None, False)]
    return data, "item string, name string, contest int, rating int, published boolean"


@pytest.mark.parametrize(
    "more, expected",
    [
        ([], {("101A", "100A")}),
        ([("299C", "Gamma", 299, None, True)], {("101A", "100A"), ("300C", "299C")}),
        ([("299C", "Gamma", 299, 1200, True)], {("101A", "100A"), ("300C", "299C")}),
        ([("201B", "Beta", 201, 1900, False)], {("101A", "100A")}),
        ([("199B", "Beta", 199, 1800, False)], {("101A", "100A")}),
        ([("201X", None, 201, 1800, False), ("77", "Beta", None, 1800, False)], {("101A", "100A")}),
    ],
)
def test_twin_map(spark, more, expected):
    data, schema = items(spark)
    got = responses.twin_map(spark.createDataFrame(data + more, schema), 100_000)
    assert {(r.absent, r.present) for r in got.collect()} == expected


def test_ambiguous_twins_are_fatal(spark):
    data, schema = items(spark)
    twins = responses.twin_map(spark.createDataFrame([*data, ("100B", "Alpha", 100, 1500, True)], schema), 100_000)
    with pytest.raises(ValueError, match="101A"):
        responses.checked(twins)


def test_matrix_and_split(spark):
    data, schema = items(spark)
    it = spark.createDataFrame(data, schema)
    tries = [("u", "101A", 5, True, DAY(9)), ("u", "100A", 3, False, DAY(1)), ("v", "200B", 4, False, DAY(8)), ("v", "100A", 7, None, DAY(9)), ("u", "200B", 9, True, DAY(9))]
    own = spark.createDataFrame(tries, "user string, item string, attempt long, accepted boolean, at timestamp_ntz")
    got = responses.response_matrix(own, responses.twin_map(it, 100_000), it).cache()
    by = {(r.user, r.item): r for r in got.collect()}
    assert len(by) == 4 and sum(r.attempts for r in by.values()) == 5
    r = by["u", "100A"]
    assert (r.source_item, r.attempt, r.accepted, r.attempts, r.ever_accepted) == ("100A", 3, False, 2, True)
    assert by["v", "100A"].ever_accepted is False
    s = responses.temporal_split(got, F.lit(DAY(5))).first().asDict()
    assert s == {"train": 1, "test": 3, "known_both": 0, "new_item_only": 1, "new_user_only": 1, "both_new": 1, "known_both_accepted": 0}


def test_invariants_can_each_fail():
    good = dict(distinct_attempts=9, attempts=9, merged_attempts=9, responses=5, unmerged_responses=6, merged_items=1, twins=1, train=2, test=3, bank=5, known_both=2, new_item_only=1, new_user_only=0, both_new=0, known_both_accepted=1)
    good |= dict(gap_exactly_one_unrated=0, gap_differs=0, gap_matches=4, qualifying=4, reversed_matches=5, reversed_passing=4, reversed_both_unrated=1, reversed_exactly_one_unrated=1, reversed_agree=2, reversed_differs=1)
    assert responses.broken_invariants(good) == []
    for change in ({"distinct_attempts": 8}, {"merged_attempts": 8}, {"responses": 7}, {"merged_items": 2}, {"bank": 6}, {"both_new": 1}, {"known_both_accepted": 3}, {"known_both": 0, "new_item_only": 3, "known_both_accepted": 0}, {"gap_exactly_one_unrated": 1}, {"gap_differs": 1}, {"qualifying": 3}, {"reversed_matches": 6}, {"reversed_passing": 5}):
        assert len(responses.broken_invariants(good | change)) == 1, change


def test_suppression_and_ties(spark):
    rows_ = [("Uni  A ", "x", 10), ("Uni A", "y", 20), ("Uni A", None, None), ("Solo", "x", 5), (" ", "x", 1), (None, "x", 2)]
    got = {r.organization: r for r in observatory.organization_participation(spark.createDataFrame(rows_, "organization string, country string, rating int"), least=3, strong=15).collect()}
    assert set(got) == {"Uni A", observatory.SUPPRESSED}
    a, rest = got["Uni A"], got[observatory.SUPPRESSED]
    assert (a.members, a.mean_rating, a.median_rating, a.max_rating, a.strong, a.most_common_country) == (3, 15.0, 15.0, 20, 1, "x")
    assert (rest.members, rest.mean_rating, rest.is_reportable) == (1, None, False)


def test_country_statistics_are_hidden_below_threshold(spark):
    got = {r.country: r for r in observatory.country_participation(spark.createDataFrame([("a", 1), ("a", 3), ("", 9), (None, 8), (None, 7)], "country string, rating int"), least=3, strong=8).collect()}
    assert got["a"].mean_rating is None and got["a"].members == 2 and not got["a"].is_reportable
    assert (got["(undeclared)"].is_undeclared, got["(undeclared)"].strong, got["(undeclared)"].share_pct) == (True, 2, 60.0)


def test_cumulative_registrations_skip_no_year(spark):
    tries = spark.createDataFrame([(2019, "u", "i", True, True, False), (2021, "u", "j", None, False, True)], "year int, user string, item string, accepted boolean, person boolean, contest boolean")
    got = {r.year: r for r in observatory.activity_by_year(tries, spark.createDataFrame([(2011,), (2020,), (2022,)], "year int")).collect()}
    assert (got[2019].registered_by_then, got[2021].registered_by_then) == (1, 2)
    assert (got[2021].is_partial_year, got[2019].is_partial_year, got[2019].accepted_pct, got[2021].accepted_pct) == (True, False, 100.0, 0.0)


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (7, None)], "k int, s string")
    got = {r.check: r.failing for r in quality.row_checks(df, [quality.not_null("k"), quality.accepted("s", ["a", "b"]), quality.in_range("k", 0, 5, severity="warn", tags=("pin",))]).collect()}
    assert got == {"not_null:k": 1, "accepted:s": 1, "range:k": 1}
    assert quality.row_checks(df, [quality.not_null("k"), quality.in_range("k", 0, 5, tags=("pin",))], without_tag="pin").count() == 1
    assert quality.unique(df, "k").first().failing == 1
    assert quality.references(df, "k", spark.createDataFrame([(1,)], "p int"), "p").first().failing == 1
    assert quality.exact_count(df, "pin", 4).count() == 0 and quality.exact_count(df, "pin", 5).count() == 1
    assert quality.failures(quality.unique(df, "k").unionByName(quality.none_of(df, "w", "warn"))) == [("unique:k", 1)]
    assert quality.denied_columns({"t": df}, ["s"]) == [("t", "s")]


def test_metadata_of_second_source(spark):
    rows_ = [
        ("s1", "p1", "u", 1577836799, "C++", "C++14", "cpp", "Accepted", 10, 5, 7, "4/4"), ("s2", "p1", "u", 1577836800, "C++", "C++14", "cpp", "Runtime Error", -1, 5, 7, "0/4"),
        ("s3", "p2", "v", 1577836800, "C", "C", "c", "Compile Error", None, None, 7, None), ("s4", "p9", "v", 1577836800, "C", "C", "c", "Brand New", None, None, 7, ""), ("s5", "p2", "v", None, "C", "C", "c", None, 1, None, 7, "x"),
    ]
    from tallyspan.sources.readers import INDEX_CSV, METADATA_CSV

    index = spark.createDataFrame([("p1", "One", "AIZU", 1, 2, None, None, None), ("p2", " ", "AtCoder", 1, 2, None, None, None)], INDEX_CSV.replace("\n", ""))
    attempts = normalize.normalize_metadata(spark.createDataFrame(rows_, METADATA_CSV.replace("\n", "")), index).cache()
    got = {r.submission_id: r for r in attempts.collect()}
    assert (got["s2"].cpu_time_ms, got["s2"].has_corrupt_timing, got["s3"].cpu_time_ms, got["s3"].has_corrupt_timing) == (None, True, None, False)
    assert (got["s1"].tests_passed, got["s1"].tests_total, got["s3"].tests_total, got["s5"].tests_passed) == (4, 4, None, None)
    assert (got["s4"].verdict_class, got["s4"].is_evidence, got["s4"].judge, got["s5"].verdict_class, got["s5"].is_accepted) == ("unknown", False, None, "unknown", None)
    assert (got["s1"].submitted_year, got["s2"].submitted_year) == (2019, 2020)
    statements = spark.createDataFrame([("p1", "text")], "problem_id string, statement string")
    dim = {r.problem_key: r for r in dimensions.frozen_problem_dimension(index, attempts, statements, "archive-1.0").collect()}
    assert (dim["p1"].submission_count, dim["p1"].has_statement, dim["p2"].problem_name, dim["p2"].has_no_submissions) == (2, True, None, False)
