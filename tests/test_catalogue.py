import duckdb
import pytest

from tallyspan.plans.catalogue import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if v is None or v != v:
        return "null"
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(tuple(cell(r[c]) for c in cols) for r in df.collect())
    want = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(cell(dict(zip(names, r))[c]) for c in cols) for r in want.fetchall())


def test_interval_join_is_no_nested_loop(spark, sf_dir):
    plan = QUERIES["asof_fact"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_dedupe_cuts_groups_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in QUERIES["dedupe_first"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_orders_are_not_dealt_by_the_keys_of_an_inline_relation(spark, sf_dir, threshold):
    """Three keys would be three tasks for all orders; only labels' counts move."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = QUERIES["inline_values"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BuildRight" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(label") == 1


def test_facts_are_not_dealt_again_by_the_sk_they_were_given(spark, sf_dir):
    """Lines are dealt by order and by customer, versions by day and by customer,
    whose result serves the as-of join and the count."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["asof_violations"](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(sk" not in plan and "hashpartitioning(_sk" not in plan
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 5
