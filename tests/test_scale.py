"""Operators whose plain form would not survive hot keys: against plain Python."""

import random
from bisect import bisect_right
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import rows

START = datetime(1970, 1, 1)
FACT, VERSION = "id long, who long, at timestamp", "k long, sk string, valid_from timestamp, valid_to timestamp"


def versions_of(key, times):
    """Disjoint versions that begin at these times, the last one open."""
    times = sorted(set(times))
    return [(key, f"{key}@{i}", t, times[i + 1] if i + 1 < len(times) else None) for i, t in enumerate(times)]


def brute(facts, versions):
    by = defaultdict(list)
    for k, sk, a, b in versions:
        by[k].append((a, b, sk))
    k_ok = lambda who, at, a: who is not None and at is not None and a is not None
    out = Counter()
    for i, who, at in facts:
        for a, b, sk in by.get(who, []):
            if k_ok(who, at, a) and a <= at and (b is None or at < b):
                out[i, sk] += 1
    return out


def met(spark, facts, versions, **more):
    f, v = spark.createDataFrame(facts, FACT).repartition(3), spark.createDataFrame(versions, VERSION).repartition(3)
    got = rows.as_of(f, v, key="who", version_key="k", at="at", keep=["sk"], **more)
    assert got.columns == ["id", "who", "at", "sk"]
    return Counter((r.id, r.sk) for r in got.collect())


def sample(seed, crowd=False):
    rnd = random.Random(seed)
    at = lambda: START + timedelta(seconds=rnd.randint(0, 40_000) if crowd and rnd.random() < 0.9 else rnd.randint(0, 800_000_000))
    versions = versions_of(1, [START] + [at() for _ in range(300)]) + versions_of(2, [START, at()]) + versions_of(3, [at() for _ in range(60)]) + [(None, "null", START, None), (4, "gone", None, None)]
    borders = [v[2] for v in versions if v[2]] + [v[3] for v in versions if v[3]]
    facts = [(i, rnd.choice([1, 1, 1, 2, 3, 3, 5, None]), rnd.choice([at(), rnd.choice(borders), None])) for i in range(1200)]
    return facts + facts[:30], versions


@pytest.mark.parametrize("seed", [0])
@pytest.mark.parametrize("crowd", [False, True])
def test_as_of_in_buckets_and_in_ranges(spark, seed, crowd):
    facts, versions = sample(seed, crowd)
    want = brute(facts, versions)
    assert met(spark, facts, versions) == want  # the crowd of seconds is carried
    assert met(spark, facts, versions, crowd=10**9) == want  # buckets alone
    assert met(spark, facts, versions, few=10**9) == want  # the plain join
    assert met(spark, facts, versions, crowd=0) == want  # all of many versions carried
    assert met(spark, [], versions) == met(spark, facts[:0], versions) == Counter()


def test_which_way_a_key_goes(spark):
    flags = {}
    for crowd in (False, True):
        _, versions = sample(1, crowd)
        v = spark.createDataFrame(versions, VERSION).select(F.col("k").alias("_key"), "sk", F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"))
        flags[crowd] = {r._key: r._crowded for r in rows.bucket_cuts(v, rows.FEW, rows.CROWD).collect()}
    assert flags == {False: {1: False, 3: False}, True: {1: True, 3: True}}


def test_overlapping_versions(spark):
    rnd = random.Random(4)
    at = lambda: START + timedelta(hours=rnd.randint(0, 9000))
    versions = [(1, f"v{i}", a := at(), a + timedelta(hours=rnd.randint(1, 4000))) for i in range(80)]
    facts = [(i, 1, at()) for i in range(300)]
    assert met(spark, facts, versions, crowd=10**9) == brute(facts, versions)
    with pytest.raises(ValueError, match="overlap"):
        met(spark, facts, versions)


def test_a_hot_key_meets_few_versions(spark):
    """10^5 versions and 10^5 facts of one key: pairs before the interval is
    looked at are twice the facts at most, and tasks share them."""
    n = 100_000
    seconds = lambda x: F.timestamp_seconds(x)
    v = spark.range(n).select(F.lit(7).alias("k"), F.col("id").alias("sk"), seconds(F.col("id") * 500 + F.pmod(F.hash("id"), F.lit(400))).alias("valid_from"))
    v = v.withColumn("valid_to", F.when(F.col("sk") < n - 1, seconds((F.col("sk") + 1) * 500 + F.pmod(F.hash(F.col("sk") + 1), F.lit(400)))))
    f = spark.range(n).select("id", F.lit(7).alias("who"), seconds(F.pmod(F.xxhash64("id"), F.lit(n * 500))).alias("at"))
    slim = v.select(F.col("k").alias("_key"), "sk", F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"))
    cuts = rows.bucket_cuts(slim, rows.FEW, rows.CROWD)
    assert [r._crowded for r in cuts.collect()] == [False]
    own, theirs = rows.bucketed_facts(f, cuts, key="who", at="at"), rows.bucketed_versions(slim, cuts)
    assert theirs.count() <= 2 * n + 2
    pairs = own.join(theirs, (F.col("who") == F.col("_key")) & (F.col("_bucket") == F.col("_in")))
    assert pairs.count() <= 2 * n + 2
    got = rows.as_of(f, v, key="who", version_key="k", at="at", keep=["sk", "valid_from", "valid_to"])
    row = got.agg(F.count("*"), F.countDistinct("id"), F.count_if((F.col("at") < F.col("valid_from")) | (F.col("at") >= F.col("valid_to")))).first()
    early = f.where(F.col("at") < v.agg(F.min("valid_from")).first()[0]).count()
    assert tuple(row) == (n - early, n - early, 0)


def test_a_crowded_hot_key_is_cut_into_ranges(spark):
    n = 40_000
    second = F.when(F.col("id") < n - 1, F.col("id")).otherwise(10**9)
    v = spark.range(n).select(F.lit(7).alias("k"), F.col("id").alias("sk"), F.timestamp_seconds(second).alias("valid_from"), F.timestamp_seconds(F.when(F.col("id") < n - 2, F.col("id") + 1).when(F.col("id") == n - 2, 10**9)).alias("valid_to"))
    f = spark.range(n).select("id", F.lit(7).alias("who"), F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(2 * n))).alias("at"))
    got = rows.as_of(f, v, key="who", version_key="k", at="at", keep=["sk"]).select("id", "sk", F.unix_seconds("at").alias("s")).collect()
    starts = list(range(n - 1)) + [10**9]
    assert len(got) == n and all(r.sk == bisect_right(starts, r.s) - 1 for r in got)


def test_cohort_is_the_least_hashes_of_each_group(spark):
    import hashlib

    people = [(f"u{i}", "abcd"[i % 3] if i % 50 else None) for i in range(3000)] + [("u1", "b"), ("u1", "b")]
    df = spark.createDataFrame(people, "k string, g string").repartition(4)
    sizes = {"a": 17, "b": 0, "c": 5000, "z": 3}
    got = rows.sample_per_group(df, "g", "k", sizes, seed=3)
    of = lambda k: hashlib.md5(f"3|{k}".encode()).hexdigest()
    want = Counter()
    for g in {g for _, g in people}:
        own = sorted((k for k, x in people if x == g), key=lambda k: (of(k), k))
        n = sizes.get(g, 0)
        want.update((k, g) for k in (own[:n] if n > 0 else own))
    assert Counter((r.k, r.g) for r in got.collect()) == want and got.columns == ["k", "g"]
    assert Counter((r.k, r.g) for r in rows.sample_per_group(df, "g", "k", {}, seed=3).collect()) == Counter(people)


def test_cohort_ranks_no_whole_group(spark, sf_dir):
    """Windows see counts, and the rows of one group of digits in 65,536."""
    df = spark.range(200_000).select(F.col("id").alias("k"), F.lit("g").alias("g")).repartition(4)
    got = rows.sample_per_group(df, "g", "k", {"g": 1000}, seed=1)
    assert got.count() == 1000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    ranked = plan[plan.index("row_number") :]
    assert "_end" in ranked and "substring" in ranked  # what is ranked is cut before
    shuffled = rows.sample_per_group(df, "g", "k", {"g": 1000}, seed=1)
    met = shuffled.select(F.md5(F.concat(F.lit("1|"), "k")).alias("h")).agg(F.max("h")).first()[0]
    assert df.where(F.md5(F.concat(F.lit("1|"), F.col("k").cast("string"))) <= met).count() == 1000


def test_medians_of_groups_are_exact(spark):
    """Small groups, one value often, ties at the middle, no values, null keys; and a
    sketch so coarse that most values are left to it."""
    from statistics import median

    rnd = random.Random(6)
    data = [("one", 5.0), ("two", 1.0), ("two", 4.0), ("none", None), (None, 2.0), (None, 9.0), (None, None)]
    data += [("hot", rnd.choice([rnd.gauss(0, 1e6), 7.0])) for _ in range(20_001)] + [("same", 3.0)] * 4000 + [("steps", float(i // 2000)) for i in range(4000)]
    data += [("few", rnd.randint(0, 9) / 4) for _ in range(999)] + [("long", rnd.expovariate(1.0) ** 9) for _ in range(10_000)]
    df = spark.createDataFrame(data, "k string, v double").repartition(7)
    by = defaultdict(list)
    for k, v in data:
        by[k] += [] if v is None else [v]
    want = {k: median(v) if v else None for k, v in by.items()}
    for accuracy in (100, 10_000):
        got = rows.group_median(df, "k", "v", accuracy=accuracy).collect()
        assert len(got) == len(want) and {r.k: r.median for r in got} == want
    assert rows.group_median(df.limit(0), "k", "v").count() == 0


def test_median_ranks_few_values_of_a_hot_group(spark):
    """Of a million values in one group, a thousandth is ranked, none in a buffer."""
    df = spark.range(1_000_000).select(F.lit("g").alias("k"), (F.xxhash64("id") / 1e9).alias("v")).repartition(4)
    got = rows.group_median(df, "k", "v")
    assert got.first().median == df.select(F.median("v")).first()[0]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "median(" not in plan and "percentile(" not in plan
