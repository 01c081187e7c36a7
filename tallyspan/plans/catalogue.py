"""Queries over the star-schema tables, each with its SQL twin for DuckDB."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspan.collection import progress
from tallyspan.functions.columns import blank_to_null, clean_text, corrupt_below, first_complete_key, fraction, full_match, mapped, member, percent, shard, surrogate_key
from tallyspan.operators import history, normalize, observatory, publish, quality, responses, rows, rules, snapshot
from tallyspan.plans import jobs
from tallyspan.plans import tables as T
from tallyspan.session import settled, shared_dir
from tallyspan.sources import landing, ledger, readers, sinks, store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


_KIND = """CASE event_type WHEN 'purchase' THEN 'accepted' WHEN 'view' THEN 'partial' WHEN 'error' THEN 'rejected'
 WHEN 'click' THEN 'unjudged' WHEN 'signup' THEN 'unjudged' ELSE CASE WHEN event_type IS NULL THEN 'unjudged' ELSE 'unknown' END END"""


@query(f"""SELECT {_KIND} AS kind, {_KIND} IN ('accepted', 'partial', 'rejected') AS evidence, count(*)::BIGINT AS n
FROM events GROUP BY 1, 2""")
def classify_verdict(spark, sf_dir):
    return T.attempts(spark, sf_dir).groupBy("kind", "evidence").agg(F.count("*").alias("n"))


@query("""SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'rejected' WHEN '2-HIGH' THEN 'accepted' WHEN '3-MEDIUM' THEN 'accepted' WHEN '5-LOW' THEN 'unjudged' ELSE 'unknown' END AS kind,
 o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS evidence, count(*)::BIGINT AS n FROM orders GROUP BY 1, 2""")
def status_map_default(spark, sf_dir):
    table = {"1-URGENT": "rejected", "2-HIGH": "accepted", "3-MEDIUM": "accepted", "5-LOW": "unjudged"}
    kind = mapped(F.col("o_orderpriority"), table, "unknown")
    return T.read(spark, sf_dir, "orders").groupBy(kind.alias("kind"), member(kind, normalize.EVIDENCE).alias("evidence")).agg(F.count("*").alias("n"))


_BANDS = "CASE " + " ".join(f"WHEN rating < {e} THEN '{n}'" for e, n in zip(observatory.BAND_EDGES, observatory.BAND_NAMES)) + f" ELSE '{observatory.BAND_NAMES[-1]}' END"
_ORDER = "CASE " + " ".join(f"WHEN rating < {e} THEN {i + 1}" for i, e in enumerate(observatory.BAND_EDGES)) + " ELSE 10 END"
_PEOPLE = """(SELECT CASE WHEN {key} % 7 = 0 THEN '' ELSE n_name END AS country, ' team  ' || substr(n_name, 1, 2) || ' ' AS organization, round({c}_acctbal)::INT AS rating
 FROM {table} JOIN nation ON {c}_nationkey = n_nationkey)"""
_SUPPLIERS, _CUSTOMERS = _PEOPLE.format(key="s_suppkey", c="s", table="supplier"), _PEOPLE.format(key="c_custkey", c="c", table="customer")


@query(f"""SELECT rating_band, band_order::BIGINT AS band_order, members, min_rating::BIGINT AS min_rating, max_rating::BIGINT AS max_rating, mean_rating,
 round(100.0::DOUBLE * members / sum(members) OVER (), 3)::DOUBLE AS share_pct
 FROM (SELECT {_BANDS} AS rating_band, {_ORDER} AS band_order, count(*)::BIGINT AS members, min(rating) AS min_rating, max(rating) AS max_rating, round(avg(rating), 1) AS mean_rating
 FROM {_CUSTOMERS} GROUP BY 1, 2)""")
def rating_distribution(spark, sf_dir):
    out = observatory.rating_distribution(T.people(spark, sf_dir, "customer"))
    return out.withColumns({c: F.col(c).cast("long") for c in ("band_order", "min_rating", "max_rating")})


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS balance, coalesce(c_acctbal < 0, false) AS corrupt FROM customer""")
def corrupt_flag(spark, sf_dir):
    value, bad = corrupt_below(F.col("c_acctbal"), 0)
    return T.read(spark, sf_dir, "customer").select("c_custkey", value.alias("balance"), bad.alias("corrupt"))


@query("""SELECT o_orderkey, try_cast(split_part(o_orderpriority, '-', 1) AS INT)::BIGINT AS first, try_cast(split_part(o_orderpriority, '-', 2) AS INT)::DOUBLE AS second FROM orders""")
def fraction_split(spark, sf_dir):
    a, b = fraction(F.col("o_orderpriority"), "-")
    return T.read(spark, sf_dir, "orders").select("o_orderkey", a.cast("long").alias("first"), b.cast("double").alias("second"))


@query("""SELECT p_partkey, CASE WHEN nullif(p_size, 1) IS NOT NULL AND p_brand IS NOT NULL THEN nullif(p_size, 1)::VARCHAR || p_brand
 WHEN nullif(p_type, 'COPPER') IS NOT NULL AND p_brand IS NOT NULL THEN nullif(p_type, 'COPPER') || p_brand END AS key,
 coalesce(nullif(p_type, 'COPPER'), 'none') AS type FROM part""")
def composite_key(spark, sf_dir):
    size, kind, brand = F.nullif(F.col("p_size"), F.lit(1)), F.nullif(F.col("p_type"), F.lit("COPPER")), F.col("p_brand")
    return T.read(spark, sf_dir, "part").select("p_partkey", first_complete_key((size, brand), (kind, brand)).alias("key"), F.coalesce(kind, F.lit("none")).alias("type"))


_RAW = """raw AS (SELECT event_id AS id, user_id, ts, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k,
 CASE event_type WHEN 'purchase' THEN 'OK' WHEN 'view' THEN 'PARTIAL' WHEN 'error' THEN 'WRONG_ANSWER' WHEN 'click' THEN 'SKIPPED' END AS verdict,
 CASE WHEN event_id % 7 = 0 THEN true WHEN event_id % 5 = 0 THEN NULL ELSE false END AS ghost, CASE WHEN event_id % 11 = 0 THEN 0 WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS team,
 CASE WHEN event_id % 2 = 0 THEN 'CONTESTANT' WHEN event_id % 13 <> 0 THEN 'PRACTICE' END AS kind FROM events)"""


@query(f"""WITH {_RAW}
SELECT id AS submission_id, CASE WHEN k % 4 <> 0 THEN k::VARCHAR || 'A' WHEN k % 8 = 0 THEN 'old' || 'A' END AS problem_id, coalesce(verdict = 'OK', false) AS is_accepted, coalesce(kind = 'CONTESTANT', false) AS is_contest,
 coalesce(ghost, false) AS is_ghost, team::BIGINT AS team_size, team = 1 AND NOT coalesce(ghost, false) AS is_person_level, CASE WHEN team = 1 AND NOT coalesce(ghost, false) THEN 'u' || user_id::VARCHAR END AS handle,
 year(ts)::BIGINT AS submitted_year, verdict, kind AS participant_type,
 CASE verdict WHEN 'OK' THEN 'accepted' WHEN 'PARTIAL' THEN 'partial' WHEN 'WRONG_ANSWER' THEN 'rejected' ELSE 'unjudged' END AS verdict_class,
 coalesce(verdict, '') IN ('OK', 'PARTIAL', 'WRONG_ANSWER') AS is_evidence FROM raw""")
def json_stage(spark, sf_dir):
    """Events as the judge's JSON, parsed under its schema and made flat."""
    flat = normalize.classify_attempts(normalize.stage_attempts(T.raw_attempts(spark, sf_dir)))
    return flat.select(
        "submission_id", "problem_id", "is_accepted", "is_contest", "is_ghost", F.col("team_size").cast("long").alias("team_size"), "is_person_level", "handle",
        F.col("submitted_year").cast("long").alias("submitted_year"), "verdict", "participant_type", "verdict_class", "is_evidence",
    )


@query("""WITH r AS (SELECT event_id, user_id, ts, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k,
 CASE event_type WHEN 'purchase' THEN 'Accepted' WHEN 'view' THEN 'Wrong Answer' WHEN 'error' THEN 'Judge Not Available' WHEN 'click' THEN 'odd' END AS status,
 CASE WHEN event_id % 9 = 0 THEN -1 ELSE event_id % 1000 END AS cpu, CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 4 = 1 THEN '3/4' WHEN event_id % 4 = 2 THEN 'bad' END AS accuracy FROM events)
SELECT event_id::VARCHAR AS submission_id, p_brand AS judge, p_name AS problem_name, p_size::BIGINT AS time_limit_ms,
 CASE status WHEN 'Accepted' THEN 'accepted' WHEN 'Wrong Answer' THEN 'rejected' WHEN 'Judge Not Available' THEN 'unjudged' ELSE 'unknown' END AS verdict_class,
 coalesce(status, '') IN ('Accepted', 'Wrong Answer') AS is_evidence, status = 'Accepted' AS is_accepted, CASE WHEN cpu >= 0 THEN cpu END::BIGINT AS cpu_time_ms, cpu < 0 AS has_corrupt_timing,
 CASE WHEN accuracy = '3/4' THEN 3 END::BIGINT AS tests_passed, CASE WHEN accuracy = '3/4' THEN 4 END::BIGINT AS tests_total, year(ts)::BIGINT AS submitted_year
FROM r LEFT JOIN part ON p_partkey = k AND p_partkey % 3 <> 0""")
def metadata_stage(spark, sf_dir):
    """Events as the second source's files, with two parts in three in its index."""
    return normalize.normalize_metadata(*T.metadata(spark, sf_dir)).select(
        "submission_id", "judge", "problem_name", F.col("time_limit_ms").cast("long").alias("time_limit_ms"), "verdict_class", "is_evidence", "is_accepted", F.col("cpu_time_ms").cast("long").alias("cpu_time_ms"),
        "has_corrupt_timing", F.col("tests_passed").cast("long").alias("tests_passed"), F.col("tests_total").cast("long").alias("tests_total"), F.col("submitted_year").cast("long").alias("submitted_year"),
    )


@query(f"""WITH {_RAW} SELECT 'verdict' AS "column", verdict AS value, count(*)::BIGINT AS n FROM raw GROUP BY 2 UNION ALL SELECT 'participant_type', kind, count(*)::BIGINT FROM raw GROUP BY 2""")
def census_values(spark, sf_dir):
    return normalize.census_by(normalize.stage_attempts(T.raw_attempts(spark, sf_dir)), ("verdict", "participant_type"))


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity FROM (
 SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe_first(spark, sf_dir):
    l = T.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
    out = rows.first_per_key(l, ["l_orderkey", "l_linenumber"], [F.col(c).asc_nulls_last() for c in ("l_partkey", "l_suppkey", "l_shipdate", "l_quantity")])
    return out.withColumn("l_linenumber", F.col("l_linenumber").cast("long"))


@query("""SELECT p_brand, p_partkey, array_to_string(tags, ' ') AS tags FROM (
 SELECT p_brand, p_partkey, string_split(p_name, ' ') AS tags, row_number() OVER (PARTITION BY p_brand ORDER BY len(string_split(p_name, ' ')) DESC, '[' || array_to_string(string_split(p_name, ' '), ', ') || ']', p_partkey) AS rn FROM part) WHERE rn = 1""")
def richest_tiebreak(spark, sf_dir):
    p = T.read(spark, sf_dir, "part").select("p_brand", "p_partkey", F.split("p_name", " ").alias("tags"))
    out = rows.richest_per_key(p, ["p_brand"], "tags", ["p_partkey"])
    return out.select("p_brand", "p_partkey", F.array_join("tags", " ").alias("tags"))


@query("""SELECT documents.doc_id, source, labels.doc_id IS NOT NULL AS labelled, quality::DOUBLE AS quality, toxic::DOUBLE AS toxic FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id""")
def left_enrich_flag(spark, sf_dir):
    out = rows.enrich(T.read(spark, sf_dir, "documents").select("doc_id", "source"), T.read(spark, sf_dir, "labels"), "doc_id", "labelled")
    return out.select("doc_id", "source", "labelled", F.col("quality").cast("double").alias("quality"), F.col("toxic").cast("double").alias("toxic"))


@query("""WITH seen AS (SELECT l_partkey, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, min(l_shipdate) AS first_at, max(l_shipdate) AS last_at FROM lineitem
 WHERE l_returnflag = 'A' AND year(l_shipdate) = 1995 GROUP BY 1),
 big AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity >= 50)
SELECT p_partkey, md5('archive|1.0|' || p_partkey::VARCHAR) AS sk, coalesce(n, 0)::BIGINT AS n, coalesce(suppliers, 0)::BIGINT AS suppliers, first_at, last_at,
 seen.l_partkey IS NULL AS has_none, big.l_partkey IS NOT NULL AS has_big, 'archive-1.0' AS snapshot_version
FROM part LEFT JOIN seen ON seen.l_partkey = p_partkey LEFT JOIN big ON big.l_partkey = p_partkey""")
def two_left_joins(spark, sf_dir):
    l = T.read(spark, sf_dir, "lineitem")
    seen = l.where((F.col("l_returnflag") == "A") & (F.year("l_shipdate") == 1995)).groupBy(F.col("l_partkey").alias("p_partkey"))
    seen = seen.agg(F.count("*").alias("n"), F.countDistinct("l_suppkey").alias("suppliers"), F.min("l_shipdate").alias("first_at"), F.max("l_shipdate").alias("last_at"))
    big = l.where("l_quantity >= 50").select(F.col("l_partkey").alias("p_partkey")).distinct()
    met = rows.enrich(rows.enrich(T.read(spark, sf_dir, "part").select("p_partkey"), seen, "p_partkey", "seen"), big, "p_partkey", "has_big")
    zero = F.lit(0).cast("long")
    return met.select(
        "p_partkey", surrogate_key("archive", "1.0", F.col("p_partkey")).alias("sk"), F.coalesce("n", zero).alias("n"), F.coalesce("suppliers", zero).alias("suppliers"), "first_at", "last_at",
        (~F.col("seen")).alias("has_none"), "has_big", F.lit("archive-1.0").alias("snapshot_version"),
    )


_VERSIONS = """states AS (SELECT o_custkey AS customer, date_trunc('day', o_orderdate)::TIMESTAMP AS since, max_by(o_orderpriority, o_orderkey) AS priority, max_by(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1, 2),
versions AS (SELECT customer, priority, status, CASE WHEN lag(since) OVER w IS NULL THEN TIMESTAMP '1970-01-01' ELSE since END AS valid_from, lead(since) OVER w AS valid_to FROM states WINDOW w AS (PARTITION BY customer ORDER BY since)),
dim AS (SELECT md5(customer::VARCHAR || '|' || strftime(valid_from, '%Y-%m-%d')) AS sk, *, valid_to IS NULL AS is_current FROM versions)"""
_LINES = "lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate, o_custkey AS customer FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
_ASOF = "facts AS (SELECT lines.*, sk, priority FROM lines JOIN dim ON lines.customer = dim.customer AND l_shipdate >= valid_from AND (valid_to IS NULL OR l_shipdate < valid_to))"


@query(f"WITH {_VERSIONS} SELECT * FROM dim")
def scd2_build(spark, sf_dir):
    return T.customer_versions(spark, sf_dir)


def _facts(spark, sf_dir, many=None):
    return rows.as_of(T.line_facts(spark, sf_dir), T.customer_versions(spark, sf_dir), key="customer", version_key="customer", at="l_shipdate", keep=["sk", "priority"], many=many)


@query(f"""WITH {_VERSIONS}, {_LINES}, {_ASOF}
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate, customer, sk, priority FROM facts""")
def asof_fact(spark, sf_dir):
    return _facts(spark, sf_dir).withColumn("l_linenumber", F.col("l_linenumber").cast("long"))


@query(f"""WITH {_VERSIONS},
bad AS (SELECT customer, CASE WHEN customer % 11 = 0 AND valid_to IS NOT NULL THEN valid_to + INTERVAL 400 DAY ELSE valid_to END AS valid_to, valid_from,
 CASE WHEN customer % 13 = 0 THEN true ELSE is_current END AS is_current FROM dim),
every AS (SELECT 'customer:' || customer::VARCHAR AS key, valid_from, valid_to, is_current FROM dim UNION ALL SELECT 'broken:' || customer::VARCHAR, valid_from, valid_to, is_current FROM bad),
numbered AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY valid_from) AS rn FROM every)
SELECT 'single_current' AS "check", key, sum(is_current::INT)::BIGINT AS n FROM every GROUP BY key HAVING sum(is_current::INT) <> 1
UNION ALL SELECT 'overlap', a.key, count(*)::BIGINT FROM numbered a JOIN numbered b ON a.key = b.key AND (a.valid_from < b.valid_from OR (a.valid_from = b.valid_from AND a.rn < b.rn))
 AND b.valid_from < coalesce(a.valid_to, TIMESTAMP '9999-12-31') GROUP BY a.key""")
def scd2_violations(spark, sf_dir):
    good = T.customer_versions(spark, sf_dir)
    late = F.when((F.col("customer") % 11 == 0) & F.col("valid_to").isNotNull(), F.col("valid_to") + F.expr("INTERVAL 400 DAYS")).otherwise(F.col("valid_to"))
    bad = good.withColumn("valid_to", late).withColumn("is_current", F.when(F.col("customer") % 13 == 0, True).otherwise(F.col("is_current")))
    return history.violations({"customer": (good, "customer"), "broken": (bad, "customer")})


@query(f"""WITH {_VERSIONS}, {_LINES}, {_ASOF},
late AS (SELECT sk, valid_from + INTERVAL 30 DAY AS valid_from, coalesce(valid_to, TIMESTAMP '9999-12-31') AS valid_to FROM dim)
SELECT (SELECT count(*) FROM facts JOIN dim USING (sk) WHERE l_shipdate < dim.valid_from OR l_shipdate >= coalesce(dim.valid_to, TIMESTAMP '9999-12-31'))::BIGINT AS outside_own,
 (SELECT count(*) FROM facts JOIN late USING (sk) WHERE l_shipdate < late.valid_from OR l_shipdate >= late.valid_to)::BIGINT AS outside_late""")
def asof_violations(spark, sf_dir):
    dim = T.customer_versions(spark, sf_dir)
    many = rows.keys_of_many(dim, "customer")
    facts, begun = _facts(spark, sf_dir, many).select("customer", "sk", "l_shipdate"), F.col("valid_from")
    return history.count_outside(facts, dim, "l_shipdate", key="customer", many=many, opens={"outside_own": begun, "outside_late": begun + F.expr("INTERVAL 30 DAYS")})


@query("""WITH facts AS (SELECT year(o_orderdate) AS year, o_custkey, o_orderpriority, o_orderstatus FROM orders),
registered AS (SELECT year, count(*) AS joined FROM (SELECT min(year(o_orderdate)) AS year FROM orders GROUP BY o_custkey) GROUP BY year),
by_then AS (SELECT y.year, coalesce(sum(joined), 0) AS registered_by_then FROM (SELECT DISTINCT year FROM facts) y LEFT JOIN registered r ON r.year <= y.year GROUP BY y.year)
SELECT facts.year::BIGINT AS year, count(*)::BIGINT AS attempts, count(*) FILTER (WHERE o_orderpriority <> '5-LOW')::BIGINT AS person_attempts, count(DISTINCT o_custkey)::BIGINT AS active_users,
 count(DISTINCT o_orderpriority)::BIGINT AS items, count(*) FILTER (WHERE o_orderstatus = 'F')::BIGINT AS accepted,
 round(100.0::DOUBLE * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 2)::DOUBLE AS accepted_pct, count(*) FILTER (WHERE o_orderpriority = '1-URGENT')::BIGINT AS in_contest,
 facts.year = (SELECT max(year) FROM facts) AS is_partial_year, max(registered_by_then)::BIGINT AS registered_by_then,
 round(100.0::DOUBLE * count(DISTINCT o_custkey) / nullif(max(registered_by_then), 0), 2)::DOUBLE AS active_share_pct
FROM facts LEFT JOIN by_then ON by_then.year = facts.year GROUP BY facts.year""")
def activity_by_year(spark, sf_dir):
    o = T.read(spark, sf_dir, "orders")
    own = o.select(
        F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("user"), F.col("o_orderpriority").alias("item"), (F.col("o_orderstatus") == "F").alias("accepted"),
        (F.col("o_orderpriority") != "5-LOW").alias("person"), (F.col("o_orderpriority") == "1-URGENT").alias("contest"),
    )
    registered = o.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("year"))
    return observatory.activity_by_year(own, registered).withColumn("year", F.col("year").cast("long"))


_STATS = "count(*)::BIGINT AS members, round(avg(rating), 1) AS mean_rating, median(rating)::DOUBLE AS median_rating, max(rating)::DOUBLE AS max_rating, (count(*) FILTER (WHERE rating >= 5000))::DOUBLE AS strong"


@query(f"""SELECT country, is_undeclared, members, round(100.0::DOUBLE * members / sum(members) OVER (), 3)::DOUBLE AS share_pct, CASE WHEN members >= 4 THEN mean_rating END AS mean_rating,
 CASE WHEN members >= 4 THEN median_rating END AS median_rating, CASE WHEN members >= 4 THEN max_rating END AS max_rating, CASE WHEN members >= 4 THEN strong END AS strong, members >= 4 AS is_reportable
FROM (SELECT coalesce(nullif(country, ''), '(undeclared)') AS country, nullif(country, '') IS NULL AS is_undeclared, {_STATS} FROM {_SUPPLIERS} GROUP BY 1, 2)""")
def country_participation(spark, sf_dir):
    out = observatory.country_participation(T.people(spark, sf_dir), least=4, strong=5000)
    return out.withColumns({c: F.col(c).cast("double") for c in ("max_rating", "strong")})


@query(f"""WITH p AS (SELECT trim(regexp_replace(organization, '\\s+', ' ', 'g')) AS organization, country, rating FROM {_SUPPLIERS}),
g AS (SELECT organization, {_STATS} FROM p WHERE organization <> '' GROUP BY 1),
u AS (SELECT organization, country AS most_common_country FROM (SELECT organization, country, row_number() OVER (PARTITION BY organization ORDER BY count(*) DESC, country) AS rn FROM p WHERE country IS NOT NULL GROUP BY 1, 2) WHERE rn = 1)
SELECT organization, members, mean_rating, median_rating, max_rating, strong, most_common_country, true AS is_reportable FROM g LEFT JOIN u USING (organization) WHERE members >= 5
UNION ALL SELECT '(below reporting threshold)', members::BIGINT, NULL, NULL, NULL, NULL, NULL, false FROM (SELECT sum(members) AS members FROM g WHERE members < 5) WHERE members > 0""")
def organization_suppressed(spark, sf_dir):
    out = observatory.organization_participation(T.people(spark, sf_dir), least=5, strong=5000)
    return out.withColumns({c: F.col(c).cast("double") for c in ("max_rating", "strong")})


@query("""SELECT md5(nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '')) AS clean, nullif(trim(lang), '') AS lang, count(*)::BIGINT AS n FROM documents GROUP BY 1, 2""")
def clean_text_group(spark, sf_dir):
    """Whole texts, cleaned and grouped; a digest stands for the text."""
    d = T.read(spark, sf_dir, "documents")
    clean = F.md5(F.nullif(clean_text(F.col("text")), F.lit("")))
    return d.groupBy(clean.alias("clean"), blank_to_null(F.col("lang")).alias("lang")).agg(F.count("*").alias("n"))


@query("""WITH x AS (SELECT unnest(string_split(p_name, ' ')) AS tag, CASE WHEN p_size > 25 THEN p_size END AS rating, p_retailprice AS solved, p_partkey % 3 <> 0 AS published FROM part)
SELECT tag, count(*)::BIGINT AS items, count(rating)::BIGINT AS rated_items, round(avg(rating), 1) AS mean_rating, median(rating)::DOUBLE AS median_rating, min(rating)::DOUBLE AS min_rating, max(rating)::DOUBLE AS max_rating,
 round(median(solved), 3)::DOUBLE AS median_solved, count(*) FILTER (WHERE published)::BIGINT AS published_items, count(*) FILTER (WHERE NOT published)::BIGINT AS other_items FROM x GROUP BY tag""")
def tag_landscape(spark, sf_dir):
    p = T.read(spark, sf_dir, "part")
    own = p.select(F.split("p_name", " ").alias("tags"), F.when(F.col("p_size") > 25, F.col("p_size")).alias("rating"), F.col("p_retailprice").alias("solved"), (F.col("p_partkey") % 3 != 0).alias("published"))
    return observatory.tag_landscape(own).withColumns({"min_rating": F.col("min_rating").cast("double"), "max_rating": F.col("max_rating").cast("double"), "median_solved": F.round("median_solved", 3)})


_ITEMS = "items AS (SELECT p_partkey AS item, split_part(p_name, ' ', 1) AS name, p_partkey AS contest, CASE WHEN p_size > 25 THEN p_size // 5 END AS rating, p_partkey % 3 <> 0 AS published FROM part)"
_CLASS = "CASE WHEN a.rating IS NULL AND b.rating IS NULL THEN 'both_unrated' WHEN a.rating IS NULL OR b.rating IS NULL THEN 'exactly_one_unrated' WHEN a.rating = b.rating THEN 'agree' ELSE 'differs' END"
_TWINS = f"twins AS (SELECT * FROM (SELECT a.item AS absent, b.item AS present, {_CLASS} AS kind FROM items a JOIN items b ON a.name = b.name AND b.contest = a.contest - 1 WHERE NOT a.published AND b.published) WHERE kind <> 'differs')"


@query(f"WITH {_ITEMS}, {_TWINS} SELECT * FROM twins")
def twin_map(spark, sf_dir):
    return T.twins(spark, sf_dir)


@query(f"""WITH {_ITEMS}, line AS (SELECT * FROM items WHERE contest < 1500), gym AS (SELECT * FROM items WHERE contest >= 1500)
SELECT 'reversed' AS population, {_CLASS} AS kind, count(*)::BIGINT AS n FROM line a JOIN line b ON a.name = b.name AND b.contest = a.contest + 1 WHERE NOT a.published AND b.published GROUP BY 2
UNION ALL SELECT 'both_published', {_CLASS}, count(*)::BIGINT FROM line a JOIN line b ON a.name = b.name AND b.contest = a.contest + 1 WHERE a.published AND b.published GROUP BY 2
UNION ALL SELECT 'from_floor', {_CLASS}, count(*)::BIGINT FROM gym a JOIN gym b ON a.name = b.name AND b.contest = a.contest + 1 GROUP BY 2""")
def twin_audit(spark, sf_dir):
    return responses.twin_audit(T.items(spark, sf_dir), T.FLOOR)


_MATRIX = f"""{_ITEMS}, {_TWINS},
att AS (SELECT user_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id, event_type = 'purchase' AS ok, ts FROM events WHERE event_type IN ('purchase', 'view', 'error')),
re AS (SELECT att.*, coalesce(present, k) AS item FROM att LEFT JOIN twins ON absent = k),
rk AS (SELECT *, row_number() OVER (PARTITION BY user_id, item ORDER BY event_id) AS rn, count(*) OVER (PARTITION BY user_id, item) AS attempts, max(ok::INT) OVER (PARTITION BY user_id, item) AS ever FROM re),
matrix AS (SELECT user_id AS "user", items.item, k AS source_item, event_id AS attempt, ok AS accepted, ts AS at_, attempts, ever = 1 AS ever_accepted, published, rating, contest FROM rk JOIN items ON items.item = rk.item WHERE rn = 1)"""


@query(f"""WITH {_MATRIX} SELECT "user", item, source_item, attempt, accepted, at_ AS "at", attempts::BIGINT AS attempts, ever_accepted, published, rating::DOUBLE AS rating, contest FROM matrix""")
def response_matrix(spark, sf_dir):
    return T.matrix(spark, sf_dir).withColumn("rating", F.col("rating").cast("double"))


@query(f"""WITH {_MATRIX}, bank AS (SELECT * FROM matrix WHERE published), tr AS (SELECT * FROM bank WHERE at_ < TIMESTAMP '2024-01-02'),
te AS (SELECT accepted, "user" IN (SELECT "user" FROM tr) AS ku, item IN (SELECT item FROM tr) AS ki FROM bank WHERE at_ >= TIMESTAMP '2024-01-02')
SELECT (SELECT count(*) FROM tr)::BIGINT AS train, count(*)::BIGINT AS test, count(*) FILTER (WHERE ku AND ki)::BIGINT AS known_both, count(*) FILTER (WHERE ku AND NOT ki)::BIGINT AS new_item_only,
 count(*) FILTER (WHERE NOT ku AND ki)::BIGINT AS new_user_only, count(*) FILTER (WHERE NOT ku AND NOT ki)::BIGINT AS both_new, count(*) FILTER (WHERE ku AND ki AND accepted)::BIGINT AS known_both_accepted FROM te""")
def temporal_split(spark, sf_dir):
    # The bank is read three times, so it is made once.
    bank = settled(T.matrix(spark, sf_dir).where("published").select("user", "item", "accepted", "at"))
    return responses.temporal_split(bank, F.lit("2024-01-02").cast("timestamp_ntz"))


@query(f"""WITH {_MATRIX} SELECT count(*)::BIGINT AS bank, count(*) FILTER (WHERE accepted)::BIGINT AS accepted, round(count(*) FILTER (WHERE accepted) / nullif(count(*), 0)::DOUBLE, 6) AS base_rate,
 round((count(*) FILTER (WHERE accepted) / nullif(count(*), 0)::DOUBLE) * (1 - count(*) FILTER (WHERE accepted) / nullif(count(*), 0)::DOUBLE), 6) AS constant_brier FROM matrix WHERE published""")
def base_rate_brier(spark, sf_dir):
    n = T.matrix(spark, sf_dir).where("published").agg(F.count("*").alias("bank"), F.count_if("accepted").alias("accepted"))
    p = F.col("accepted").cast("double") / F.nullif(F.col("bank").cast("double"), F.lit(0.0))
    return n.select("bank", "accepted", F.round(p, 6).alias("base_rate"), F.round(p * (1 - p), 6).alias("constant_brier"))


@query("""SELECT event_id, dense_rank() OVER (ORDER BY user_id)::BIGINT AS number FROM events WHERE user_id IS NOT NULL""")
def distinct_surrogate(spark, sf_dir):
    return rows.number_keys(T.read(spark, sf_dir, "events").select("event_id", "user_id"), "user_id", "number").select("event_id", "number")


@query("""SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND year(l_shipdate) = 1995""")
def except_keys(spark, sf_dir):
    l = T.read(spark, sf_dir, "lineitem").where((F.col("l_returnflag") == "A") & (F.year("l_shipdate") == 1995)).select(F.col("l_partkey").alias("p_partkey"))
    return rows.missing_keys(T.read(spark, sf_dir, "part"), l, "p_partkey")


@query("""SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey IS NOT NULL) AS urgent FROM customer""")
def existence_flag(spark, sf_dir):
    urgent = T.read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return rows.exists_flag(T.read(spark, sf_dir, "customer").select("c_custkey"), urgent, "c_custkey", "urgent")


@query("""SELECT 'not_null:quality' AS "check", 'error' AS severity, count(*) FILTER (WHERE quality IS NULL)::BIGINT AS failing FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'accepted:lang', 'error', count(*) FILTER (WHERE lang NOT IN ('en', 'de'))::BIGINT FROM documents
UNION ALL SELECT 'range:n_chars', 'warn', count(*) FILTER (WHERE n_chars < 100 OR n_chars > 5000)::BIGINT FROM documents
UNION ALL SELECT 'unique:text', 'error', count(*)::BIGINT FROM (SELECT text FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1)
UNION ALL SELECT 'unique:doc_id', 'error', count(*)::BIGINT FROM (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING count(*) > 1)
UNION ALL SELECT 'references:doc_id', 'error', count(*)::BIGINT FROM documents WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)""")
def data_checks(spark, sf_dir):
    docs, labels = T.read(spark, sf_dir, "documents"), T.read(spark, sf_dir, "labels")
    met = docs.join(labels, "doc_id", "left")
    checks = [quality.not_null("quality"), quality.accepted("lang", ["en", "de"]), quality.in_range("n_chars", 100, 5000, severity="warn")]
    # A second label would count its document twice, so that is a check by itself.
    return quality.row_checks(met, checks).unionByName(quality.unique(labels, "doc_id")).unionByName(quality.unique(docs, "text")).unionByName(quality.references(docs, "doc_id", labels, "doc_id"))


@query("""SELECT 'lineitem_rows' AS "check", count(*)::BIGINT AS n FROM lineitem HAVING count(*) <> 13
UNION ALL SELECT 'nation_rows', count(*)::BIGINT FROM nation HAVING count(*) <> 25""")
def having_global(spark, sf_dir):
    return quality.exact_count(T.read(spark, sf_dir, "lineitem"), "lineitem_rows", 13).unionByName(quality.exact_count(T.read(spark, sf_dir, "nation"), "nation_rows", 25))


@query("""SELECT count(*)::BIGINT AS orders, count(*) FILTER (WHERE least_q < 10)::BIGINT AS small, count(*) FILTER (WHERE n = 1)::BIGINT AS single FROM (SELECT l_orderkey, min(l_quantity) AS least_q, count(*) AS n FROM lineitem GROUP BY 1)""")
def two_level_agg(spark, sf_dir):
    per = T.read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_quantity").alias("least"), F.count("*").alias("n"))
    return per.agg(F.count("*").alias("orders"), F.count_if(F.col("least") < 10).alias("small"), F.count_if(F.col("n") == 1).alias("single"))


@query("""SELECT page_id, regexp_full_match(url, 'https?://[a-z.]+/(en|de)/[0-9]+') AS plain, CASE WHEN url LIKE 'https://m.%' THEN 'mobile' WHEN url LIKE 'https://%' THEN 'secure' ELSE 'other' END AS kind FROM pages""")
def regex_partition(spark, sf_dir):
    url = F.col("url")
    kind = F.when(url.like("https://m.%"), "mobile").when(url.like("https://%"), "secure").otherwise("other")
    return T.read(spark, sf_dir, "pages").select("page_id", full_match(url, "https?://[a-z.]+/(en|de)/[0-9]+").alias("plain"), kind.alias("kind"))


@query("""SELECT c_custkey, md5(c_custkey::VARCHAR || '|1970-01-01') AS sk, md5('source|1.0|' || c_name) AS frozen_sk, substr(sha1(c_name), 1, 2) AS shard FROM customer""")
def hash_keys(spark, sf_dir):
    return T.read(spark, sf_dir, "customer").select("c_custkey", surrogate_key(F.col("c_custkey"), "1970-01-01").alias("sk"), surrogate_key("source", "1.0", F.col("c_name")).alias("frozen_sk"), shard(F.col("c_name")).alias("shard"))


@query("""WITH a AS (SELECT l_returnflag AS k, count(*) AS n, round(avg(l_quantity), 2) AS q FROM lineitem GROUP BY 1),
b AS (SELECT l_returnflag AS k, count(*) AS n, round(avg(l_quantity), 2) + CASE WHEN l_returnflag = 'N' THEN 0.25 ELSE 0.005 END AS q FROM lineitem WHERE l_returnflag <> 'R' AND (l_returnflag <> 'A' OR l_linenumber > 1) GROUP BY 1),
f AS (SELECT coalesce(a.k, b.k) AS l_returnflag, a.k IS NOT NULL AS l, b.k IS NOT NULL AS r, a.n AS an, b.n AS bn, a.q AS aq, b.q AS bq FROM a FULL JOIN b ON a.k = b.k)
SELECT l_returnflag, '(row)' AS "column", CASE WHEN l THEN 'present' END AS left_value, CASE WHEN r THEN 'present' END AS right_value FROM f WHERE l <> r
UNION ALL SELECT l_returnflag, 'n', an::VARCHAR, bn::VARCHAR FROM f WHERE l AND r AND an <> bn
UNION ALL SELECT l_returnflag, 'q', aq::VARCHAR, bq::VARCHAR FROM f WHERE l AND r AND abs(aq - bq) > 0.011""")
def compare_full_outer(spark, sf_dir):
    l = T.read(spark, sf_dir, "lineitem")
    own = lambda df, plus: df.groupBy("l_returnflag").agg(F.count("*").alias("n"), (F.round(F.avg("l_quantity"), 2) + plus).alias("q"))
    other = l.where("l_returnflag <> 'R' and (l_returnflag <> 'A' or l_linenumber > 1)")
    return rows.difference(own(l, F.lit(0.0)), own(other, F.when(F.col("l_returnflag") == "N", 0.25).otherwise(0.005)), "l_returnflag", ["n"], ["q"])


@query("""SELECT tag, count(*)::BIGINT AS items FROM (SELECT unnest(string_split(p_name, ' ')) AS tag FROM part) GROUP BY tag ORDER BY items DESC, tag LIMIT 5""")
def topk(spark, sf_dir):
    tags = T.read(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("tag"))
    return tags.groupBy("tag").agg(F.count("*").alias("items")).orderBy(F.desc("items"), "tag").limit(5)


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder for a round trip, deleted at the session's end."""
    path = f"{shared_dir(spark)}/trips/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


@query("""SELECT year(o_orderdate)::BIGINT AS year, o_orderstatus, count(*)::BIGINT AS n, round(sum(o_totalprice), 1) AS total FROM orders WHERE year(o_orderdate) >= 1997 GROUP BY 1, 2""")
def roundtrip_partitioned(spark, sf_dir):
    """Written as Parquet in folders by year, read again with the year pruned."""
    path = _folder(spark, "lake")
    sinks.lake(T.read(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate")), path, "year")
    back = readers.parquet(spark, path).where("year >= 1997")
    return back.groupBy(F.col("year").cast("long").alias("year"), "o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 1).alias("total"))


@query("""SELECT count(*)::BIGINT AS rows, 2::BIGINT AS columns, 0::BIGINT AS falls, sum(c_custkey)::BIGINT AS keys FROM customer""")
def roundtrip_sorted(spark, sf_dir):
    """A slice under a total order: rows and columns from its footers, and no file
    holds a row that is less than the one before it."""
    path = _folder(spark, "slice")
    sinks.sorted_slice(T.read(spark, sf_dir, "customer").select("c_custkey", "c_name"), path, ["c_custkey"])
    found = sinks.artefact(spark, path)
    back = readers.parquet(spark, path).select("c_custkey", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag("c_custkey").over(Window.partitionBy("file").orderBy("at"))
    fell = back.withColumn("fell", F.coalesce(F.col("c_custkey") < before, F.lit(False)))
    return fell.agg(F.lit(found["rows"]).cast("long").alias("rows"), F.lit(len(found["schema"])).cast("long").alias("columns"), F.count_if("fell").alias("falls"), F.sum("c_custkey").alias("keys"))


@query("""SELECT 'json' AS format, n_name AS name, count(*)::BIGINT AS n, sum(s_suppkey)::BIGINT AS keys FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 2
UNION ALL SELECT 'csv', n_name, count(*)::BIGINT, sum(s_suppkey)::BIGINT FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 2""")
def roundtrip_text(spark, sf_dir):
    """Written as compressed JSON lines and as CSV with a header, read again under
    declared schemas, one of which names fewer fields than the files hold."""
    lines, table = _folder(spark, "lines"), _folder(spark, "csv")
    s, n = T.read(spark, sf_dir, "supplier"), T.read(spark, sf_dir, "nation")
    own = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(F.col("n_name").alias("name"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    sinks.json_lines(own, lines)
    own.select("name", "key").write.option("header", True).csv(table)
    back = readers.json_lines(spark, [lines], "key long, name string").select(F.lit("json").alias("format"), "name", "key")
    back = back.union(readers.csv_files(spark, [table], "name string, key long").select(F.lit("csv"), "name", "key"))
    return back.groupBy("format", "name").agg(F.count("*").alias("n"), F.sum("key").alias("keys"))


@query("""SELECT 'orders_by_status' AS "table", o_orderstatus AS name, count(*)::BIGINT AS n FROM orders GROUP BY 2
UNION ALL SELECT 'columns', 'o_orderstatus', 1 UNION ALL SELECT 'columns', 'n', 1""")
def view_scan(spark, sf_dir):
    """A view of the session by name, and its columns from the catalogue."""
    name = f"orders_by_status_{uuid.uuid4().hex}"
    sinks.materialise(T.read(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n")), name, "staging")
    columns = quality.catalogue(spark).where(F.col("table") == name).select(F.lit("columns").alias("table"), F.col("column").alias("name"), F.lit(1).cast("long").alias("n"))
    out = settled(spark.table(name).select(F.lit("orders_by_status").alias("table"), F.col("o_orderstatus").alias("name"), "n").unionByName(columns))
    spark.catalog.dropTempView(name)
    return out


@query("""SELECT label, count(*)::BIGINT AS n FROM (VALUES ('F', 'finished'), ('O', 'open'), ('X', 'none')) AS t(status, label) JOIN orders ON o_orderstatus = status GROUP BY label""")
def inline_values(spark, sf_dir):
    named = quality.inline(spark, [("F", "finished"), ("O", "open"), ("X", "none")], "o_orderstatus string, label string")
    return T.read(spark, sf_dir, "orders").join(named, "o_orderstatus").groupBy("label").agg(F.count("*").alias("n"))


_SETS = """sets AS (SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN p_partkey::VARCHAR || left(p_type, 1) ELSE 'archive' || p_partkey::VARCHAR END AS problem_id, p_partkey % 5 = 0 AS named, p_name, p_size FROM part),
seen AS (SELECT l_partkey, count(*) AS solved FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)"""


@query(f"""WITH {_SETS} SELECT problem_id, CASE WHEN named THEN 'archive' ELSE 'main' END AS problemset_source, p_name AS problem_name, CASE WHEN p_size > 25 THEN p_size END::BIGINT AS problem_rating,
 CASE WHEN p_partkey % 2 = 0 THEN len(string_split(p_name, ' ')) ELSE 0 END::BIGINT AS tags, solved::BIGINT AS solved_count FROM sets LEFT JOIN seen ON l_partkey = p_partkey""")
def problemset_snapshot(spark, sf_dir):
    """Parts as a main set and a named one, whose statistics carry no name."""
    problems, statistics = T.problemsets(spark, sf_dir)
    main = snapshot.problemset(problems.where("not named"), statistics.where("not named"), "2024-01-01")
    named = snapshot.problemset(problems.where("named"), statistics.where("named"), "2024-01-01", name="archive")
    out = snapshot.together([main, named])
    return out.select("problem_id", "problemset_source", "problem_name", F.col("problem_rating").cast("long").alias("problem_rating"), F.size("problem_tags").cast("long").alias("tags"), "solved_count")


@query(f"""WITH {_MATRIX} SELECT (SELECT count(*) FROM att)::BIGINT AS attempts, (SELECT count(DISTINCT event_id) FROM att)::BIGINT AS distinct_attempts, (SELECT count(*) FROM (SELECT DISTINCT user_id, k FROM att))::BIGINT AS unmerged_responses,
 (SELECT count(DISTINCT k) FROM att WHERE k IN (SELECT absent FROM twins))::BIGINT AS merged_items, count(*)::BIGINT AS responses, coalesce(sum(attempts), 0)::BIGINT AS merged_attempts, count(*) FILTER (WHERE published)::BIGINT AS bank,
 count(*) FILTER (WHERE published AND accepted)::BIGINT AS bank_accepted, (SELECT count(*) FROM twins)::BIGINT AS twins FROM matrix""")
def matrix_counts(spark, sf_dir):
    tries = T.attempts(spark, sf_dir).where("evidence").select("user", "item", "attempt", "accepted", "at")
    return responses.matrix_counts(tries, T.twins(spark, sf_dir), T.matrix(spark, sf_dir))


_PAIRS = "SELECT {name} AS name, {kind} AS kind FROM items a JOIN items b ON a.name = b.name AND b.contest = a.contest {gap} 1 WHERE NOT a.published AND b.published"


@query(f"""WITH {_ITEMS}, p AS ({_PAIRS.format(name="'gap'", kind=_CLASS, gap='-')} UNION ALL {_PAIRS.format(name="'reversed'", kind=_CLASS, gap='+')})
SELECT name || '_' || k AS count, coalesce(n, 0)::BIGINT AS n FROM (SELECT * FROM (VALUES ('gap'), ('reversed')) a(name), (VALUES ('both_unrated'), ('exactly_one_unrated'), ('agree'), ('differs')) b(k)) g
 LEFT JOIN (SELECT name AS pn, kind, count(*) AS n FROM p GROUP BY 1, 2) c ON pn = name AND kind = k
UNION ALL SELECT name || '_matches', count(*)::BIGINT FROM p GROUP BY name UNION ALL SELECT name || '_passing', count(*) FILTER (WHERE kind <> 'differs')::BIGINT FROM p GROUP BY name
UNION ALL SELECT 'qualifying', count(*) FILTER (WHERE kind <> 'differs')::BIGINT FROM p WHERE name = 'gap'""")
def twin_counts(spark, sf_dir):
    found = responses.twin_counts(T.items(spark, sf_dir), 1_000_000_000)
    return quality.inline(spark, list(found.items()), "count string, n long")


@query(f"""WITH {_RAW.replace("'SKIPPED'", "'SKIPPED' ELSE 'NEW'")}, f AS (SELECT *, CASE WHEN verdict IN ('OK', 'PARTIAL', 'WRONG_ANSWER', 'SKIPPED') THEN 'known' ELSE 'unknown' END AS class FROM raw)
SELECT 'unknown_classes' AS rule, count(*)::BIGINT AS n FROM (SELECT verdict FROM f WHERE class = 'unknown' GROUP BY 1)
UNION ALL SELECT 'unresolved_ids', count(*)::BIGINT FROM (SELECT k AS p_partkey FROM f EXCEPT SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0)
UNION ALL SELECT 'outside_partition', count(*)::BIGINT FROM part WHERE p_brand NOT IN ('Brand#11', 'Brand#12') OR NOT regexp_full_match(p_partkey::VARCHAR, '[0-9]{{1,2}}')
UNION ALL SELECT 'uncovered', 1 WHERE (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_quantity >= 50) <> (SELECT count(*) FROM part)
UNION ALL SELECT 'ambiguous_keys', count(*)::BIGINT FROM (SELECT p_brand FROM part GROUP BY 1 HAVING count(DISTINCT (p_type, p_size)) > 1)
UNION ALL SELECT 'disagreeing', count(*)::BIGINT FROM (SELECT p_partkey, CASE WHEN p_size > 25 THEN p_size END AS r, CASE WHEN p_size > 20 THEN p_size END AS s FROM part) WHERE r IS DISTINCT FROM s
UNION ALL SELECT 'small_cells', count(*)::BIGINT FROM (SELECT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1 HAVING count(*) < 5)""")
def table_rules(spark, sf_dir):
    """How many rows break each rule over whole tables."""
    p, l = T.read(spark, sf_dir, "part"), T.read(spark, sf_dir, "lineitem")
    facts = normalize.classify_attempts(normalize.stage_attempts(T.raw_attempts(spark, sf_dir, other="NEW")))
    keys = T.attempts(spark, sf_dir).select(F.col("item").alias("p_partkey"))
    rated = lambda least: p.select("p_partkey", F.when(F.col("p_size") > least, F.col("p_size")).alias("r"))
    people = T.people(spark, sf_dir).select("nation")
    shown = people.distinct().withColumn("mean", F.lit(1.0))
    found = {
        "unknown_classes": rules.unknown_classes(facts, "verdict_class", "verdict"),
        "unresolved_ids": rules.unresolved_ids(keys, p.where("p_partkey % 3 <> 0"), "p_partkey"),
        "outside_partition": rules.outside_partition(p.withColumn("id", F.col("p_partkey").cast("string")), "p_brand", ["Brand#11", "Brand#12"], "id", "[0-9]{1,2}"),
        "uncovered": rules.uncovered(l.where("l_quantity >= 50"), p, "l_partkey", "p_partkey"),
        "ambiguous_keys": rules.ambiguous_keys(p, "p_brand", ["p_type", "p_size"]),
        "disagreeing": rules.disagreeing(rated(25), rated(20), "p_partkey", "r"),
        "small_cells": rules.small_cells(shown, people, "nation", ["mean"], 5),
    }
    out = None
    for name, df in found.items():
        part = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("rule"), "n").where("rule <> 'uncovered' or n > 0")
        out = part if out is None else out.unionByName(part)
    return out


@query("""SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'low' ELSE 'high' END AS band, count(*)::BIGINT AS total, count(*) FILTER (WHERE c_custkey % 4 = 1)::BIGINT AS done, count(*) FILTER (WHERE c_custkey % 4 = 2)::BIGINT AS skipped,
 count(*) FILTER (WHERE c_custkey % 4 = 3)::BIGINT AS errors, sum(c_custkey)::BIGINT AS rows, sum(c_custkey % 10)::BIGINT AS person_rows, count(*)::BIGINT AS pages FROM customer GROUP BY 1""")
def progress_by_band(spark, sf_dir):
    c = T.read(spark, sf_dir, "customer")
    state = F.element_at(F.array(*[F.lit(s) for s in (progress.PENDING, progress.DONE, progress.SKIPPED, progress.ERROR)]), (F.col("c_custkey") % 4 + 1).cast("int"))
    own = c.select(F.when(F.col("c_nationkey") % 2 == 0, "low").otherwise("high").alias("band"), state.alias("state"), F.col("c_custkey").alias("rows"), (F.col("c_custkey") % 10).alias("person_rows"), F.lit(1).cast("long").alias("pages"))
    return progress.by_band(own)


@query("""SELECT count(*)::BIGINT AS rows, count(DISTINCT l_orderkey)::BIGINT AS distinct_l_orderkey, count(DISTINCT l_partkey)::BIGINT AS distinct_l_partkey, count(DISTINCT l_suppkey)::BIGINT AS distinct_l_suppkey,
 count(*) FILTER (WHERE returned)::BIGINT AS true_returned, count(*) FILTER (WHERE small IS NULL)::BIGINT AS null_small, min(year)::BIGINT AS first_year, max(year)::BIGINT AS last_year
FROM (SELECT *, l_returnflag = 'R' AS returned, CASE WHEN l_quantity < 10 THEN l_quantity END AS small, year(l_shipdate) AS year FROM lineitem)""")
def census_report(spark, sf_dir):
    l = T.read(spark, sf_dir, "lineitem").withColumns({"returned": F.col("l_returnflag") == "R", "small": F.when(F.col("l_quantity") < 10, F.col("l_quantity")), "year": F.year("l_shipdate").cast("long")})
    return normalize.census(l, distinct=("l_orderkey", "l_partkey", "l_suppkey"), true=("returned",), null=("small",), extent=("year",))


@query(f"""WITH b AS (SELECT c_custkey, rating, {_BANDS} AS band FROM (SELECT c_custkey, round(c_acctbal)::INT AS rating FROM customer)),
r AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY md5('7|' || c_custkey::VARCHAR), c_custkey) AS rn FROM b)
SELECT c_custkey, band FROM r WHERE rn <= CASE band WHEN 'newbie' THEN 10 WHEN 'legendary grandmaster' THEN 20 WHEN 'expert' THEN 0 ELSE 0 END OR band NOT IN ('newbie', 'legendary grandmaster')""")
def cohort_sample(spark, sf_dir):
    from tallyspan.functions.columns import band

    name, _ = band(F.round("c_acctbal").cast("int"), observatory.BAND_EDGES, observatory.BAND_NAMES)
    people = T.read(spark, sf_dir, "customer").select("c_custkey", name.alias("band"))
    return rows.sample_per_group(people, "band", "c_custkey", {"newbie": 10, "legendary grandmaster": 20, "expert": 0}, seed=7)


@query("""SELECT o_orderkey, o_orderstatus, round(100.0::DOUBLE * o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey), 2)::DOUBLE AS share_pct, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::BIGINT AS nth FROM orders""")
def share_of_group(spark, sf_dir):
    own = Window.partitionBy("o_custkey")
    nth = F.row_number().over(own.orderBy("o_orderdate", "o_orderkey")).cast("long")
    return T.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", percent(F.col("o_totalprice"), F.sum("o_totalprice").over(own)).alias("share_pct"), nth.alias("nth"))


@query("""SELECT a.c_custkey FROM (SELECT c_custkey, nullif(floor(c_acctbal)::INT % 7, 0) AS x, nullif(c_nationkey % 7, 0) AS y FROM customer) a WHERE x IS DISTINCT FROM y""")
def null_safe_disagreement(spark, sf_dir):
    c = T.read(spark, sf_dir, "customer")
    x = F.nullif(F.floor("c_acctbal").cast("int") % 7, F.lit(0))
    return c.where(~x.eqNullSafe(F.nullif(F.col("c_nationkey") % 7, F.lit(0)))).select("c_custkey")


@query("""SELECT l_returnflag, round(median(l_extendedprice), 3)::DOUBLE AS median_price FROM lineitem GROUP BY l_returnflag""")
def median_of_hot_groups(spark, sf_dir):
    """Three groups that hold all rows, with nearly as many values as rows."""
    lines = T.read(spark, sf_dir, "lineitem")
    return rows.group_median(lines, "l_returnflag", "l_extendedprice", "median_price").withColumn("median_price", F.round("median_price", 3))


_DIGEST = "sum(('0x' || substr(md5({x}), 1, 15))::BIGINT)::VARCHAR"
_TWO = "SELECT {layout} AS layout, count(*)::BIGINT AS rows, {keys} AS keys, {state} AS state FROM orders"
_SUMS = {"keys": _DIGEST.format(x="o_orderkey::VARCHAR || chr(31) || o_custkey::VARCHAR"), "state": _DIGEST.format(x="o_orderkey::VARCHAR || chr(31) || o_orderstatus || chr(31) || o_orderpriority")}


@query(_TWO.format(layout="'sorted'", **_SUMS) + " UNION ALL " + _TWO.format(layout="'by year'", **_SUMS))
def content_digest(spark, sf_dir):
    """One table in two layouts: the same digests, whatever the files."""
    o = T.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("year"))
    sliced, by_year = _folder(spark, "sorted"), _folder(spark, "by-year")
    sinks.sorted_slice(o, sliced, ["o_custkey", "o_orderkey"])
    sinks.lake(o, by_year, "year")
    groups = {"keys": ["o_orderkey", "o_custkey"], "state": ["o_orderkey", "o_orderstatus", "o_orderpriority"]}
    of = lambda layout, path: sinks.content_digest(readers.parquet(spark, path), groups).withColumn("layout", F.lit(layout))
    return of("sorted", sliced).unionByName(of("by year", by_year))


@query("""WITH a AS (SELECT o_orderkey AS k, floor(o_totalprice)::BIGINT AS n, o_orderdate AS t FROM orders WHERE o_orderkey % 5 <> 0),
b AS (SELECT o_orderkey AS k, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE floor(o_totalprice)::BIGINT END AS n, o_orderdate AS t FROM orders WHERE o_orderkey % 7 <> 0)
SELECT coalesce(a.k, b.k)::VARCHAR AS path, CASE WHEN b.k IS NULL THEN 'new' WHEN a.k IS NULL THEN 'gone' ELSE 'changed' END AS state
FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.n <> b.n OR a.t <> b.t""")
def ledger_changes(spark, sf_dir):
    """Orders as a zone's files, some of which a ledger lacks or has otherwise."""
    o = T.read(spark, sf_dir, "orders")
    size = F.floor("o_totalprice").cast("long")
    files = lambda df, n: df.select(F.col("o_orderkey").cast("string").alias("path"), n.alias("length"), F.col("o_orderdate").alias("changed_at"))
    return ledger.compare(files(o.where("o_orderkey % 5 <> 0"), size), files(o.where("o_orderkey % 7 <> 0"), F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(size)))


@query("""SELECT year, part, count(*)::BIGINT AS n, sum(k)::BIGINT AS keys FROM (
 SELECT year(o_orderdate)::BIGINT AS year, o_orderkey AS k, CASE WHEN year(o_orderdate) = 1996 THEN 'replaced' WHEN year(o_orderdate) >= 1998 THEN 'added' ELSE 'first' END AS part, o_orderstatus FROM orders)
WHERE part <> 'replaced' OR o_orderstatus = 'F' OR o_orderstatus = 'O' GROUP BY 1, 2""")
def lake_by_parts(spark, sf_dir):
    """Years written first; then one replaced by itself, then the missing added."""
    path = _folder(spark, "parts")
    o = T.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus", F.year("o_orderdate").alias("year"))
    sinks.lake(o.where("year < 1998").withColumn("part", F.lit("first")), path, "year")
    sinks.lake_parts(o.where("year = 1996 and o_orderstatus in ('F', 'O')").withColumn("part", F.lit("replaced")), path, "year")
    sinks.missing_parts(o.withColumn("part", F.lit("added")), path, "year")
    return readers.parquet(spark, path).groupBy(F.col("year").cast("long").alias("year"), "part").agg(F.count("*").alias("n"), F.sum("k").alias("keys"))


@query("""SELECT '_' || n_name AS name, count(*)::BIGINT AS n, sum(s_suppkey)::BIGINT AS keys FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey IN (1, 2) GROUP BY 1""")
def key_from_path(spark, sf_dir):
    """Suppliers as compressed JSON lines, a file for each nation in its region's
    folder; nations come from the files' names, regions from the folders read."""
    staged, zone = _folder(spark, "staged"), _folder(spark, "zone")
    s, n = T.read(spark, sf_dir, "supplier"), T.read(spark, sf_dir, "nation")
    own = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select("n_regionkey", "n_nationkey", F.col("s_suppkey").alias("key"))
    own.repartition("n_regionkey", "n_nationkey").write.option("compression", "gzip").partitionBy("n_regionkey", "n_nationkey").json(staged)
    names = {r.n_nationkey: r.n_name for r in n.collect()}
    for path in landing.listed(staged, spark):
        if path.endswith(".json.gz"):
            region, nation = (int(x.split("=")[1]) for x in path.split("/")[-3:-1])
            store.move(path, f"{zone}/{region}/{landing.safe_name('_' + names[nation])}.jsonl.gz", spark)
    back = readers.json_lines(spark, landing.shard_globs(zone, ["1", "2"]), "key long", name_as="name")
    return back.groupBy("name").agg(F.count("*").alias("n"), F.sum("key").alias("keys"))


_SHOWN = "SELECT CASE WHEN c_custkey % 7 = 0 THEN '(undeclared)' ELSE n_name END AS country, count(*)::BIGINT AS members, CASE WHEN count(*) >= 20 THEN round(avg(round(c_acctbal)), 1) END AS mean FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"


@query(f"""SELECT (row_number() OVER (ORDER BY members DESC, country) - 1)::BIGINT AS place, country, members, mean, (SELECT count(*) FROM ({_SHOWN}))::BIGINT AS row_count, 0::BIGINT AS faults, (CASE WHEN (SELECT count(*) FROM ({_SHOWN}) WHERE mean IS NOT NULL AND members < 1000000) > 0 THEN 1 ELSE 0 END)::BIGINT AS stricter FROM ({_SHOWN})""")
def published_order(spark, sf_dir):
    """A table of people exported behind its rule: places of its rows in the file,
    and what the gate that reads only files finds, by this rule and a stricter one."""
    folder, name = _folder(spark, "published"), "obs_country"
    people = T.people(spark, sf_dir, "customer").select(F.when(F.col("country") == "", "(undeclared)").otherwise(F.col("country")).alias("country"), "rating")
    mean = F.when(F.count("*") >= 20, F.round(F.avg("rating"), 1))
    rule = publish.Publication(("country", "members", "mean"), ("-members", "country"), "As declared.", count="members", statistics=("mean",), least=20)
    publish.export(people.groupBy("country").agg(F.count("*").alias("members"), mean.alias("mean")), name, folder, rule)
    faults = publish.verify(folder, {name: rule}, denied=jobs.DENIED, spark=spark)
    stricter = publish.verify(folder, {name: publish.Publication(rule.columns, rule.order, count="members", statistics=("mean",), least=1_000_000)}, spark=spark)
    table = readers.json_array(spark, f"{folder}/{name}.json", "row_count long, rows array<struct<country: string, members: long, mean: double>>")
    out = table.select("row_count", F.posexplode("rows").alias("place", "r")).select(F.col("place").cast("long").alias("place"), "r.*", "row_count")
    return out.withColumns({"faults": F.lit(len(faults)).cast("long"), "stricter": F.lit(int(any("has statistics" in x for x in stricter))).cast("long")})


_FACTS = "f AS (SELECT o_custkey AS u, l_partkey AS p, year(o_orderdate)::BIGINT AS y, l_returnflag = 'A' AS a FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey WHERE year(o_orderdate) BETWEEN 1996 AND 1997)"


@query(f"""WITH {_FACTS}, u AS (SELECT c_custkey AS u, dense_rank() OVER (ORDER BY c_custkey::VARCHAR) AS uid FROM customer), p AS (SELECT p, dense_rank() OVER (ORDER BY p) AS pid FROM (SELECT DISTINCT p FROM f))
SELECT uid::BIGINT AS user_id, pid::BIGINT AS problem_id, y AS submitted_year, a AS is_accepted, count(*)::BIGINT AS n FROM f JOIN u USING (u) JOIN p USING (p) GROUP BY 1, 2, 3, 4""")
def slices_of_whole_years(spark, sf_dir):
    """Users and facts under numbers in place of names, of two whole years."""
    folder = _folder(spark, "slices")
    o, c = T.read(spark, sf_dir, "orders"), T.read(spark, sf_dir, "customer")
    l = T.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("problem_key"), (F.col("l_returnflag") == "A").alias("is_accepted"))
    own = l.join(o, "o_orderkey").select(F.col("o_custkey").cast("string").alias("user_key"), "problem_key", F.year("o_orderdate").alias("submitted_year"), "is_accepted", F.lit(True).alias("is_person_level"), F.lit(False).alias("is_contest"))
    users = c.select(F.col("c_custkey").cast("string").alias("user_key"), F.col("c_acctbal").alias("rating"), F.lit("X").alias("country"), F.lit("2020-01-01").cast("date").alias("registered_at"), F.lit(True).alias("is_current"))
    jobs.slices_without_identities(own, users, folder, (1996, 1997))
    back = readers.parquet(spark, f"{folder}/facts")
    return back.groupBy("user_id", "problem_id", F.col("submitted_year").cast("long").alias("submitted_year"), "is_accepted").agg(F.count("*").alias("n"))


@query("""SELECT difference FROM (VALUES ('balance: ' || (SELECT count(*) FROM customer WHERE c_acctbal < 0)::VARCHAR || ' to ' || (SELECT count(*) FROM customer WHERE c_acctbal >= 0)::VARCHAR), ('rows: ' || (SELECT count(*) + 1 FROM customer)::VARCHAR || ' to ' || (SELECT count(*) FROM customer)::VARCHAR),
 ('missing c_name'), ('extra c_nationkey'), ('retyped c_custkey: int to bigint')) t(difference)""")
def manifest_compare(spark, sf_dir):
    """A written slice's manifest against one that promises other pins, another
    number of rows and another schema."""
    path = _folder(spark, "pinned")
    c = T.read(spark, sf_dir, "customer")
    sinks.sorted_slice(c.select("c_custkey", "c_nationkey"), path, ["c_custkey"])
    n = c.agg(F.count_if(F.col("c_acctbal") < 0).alias("bad"), F.count_if(F.col("c_acctbal") >= 0).alias("good"), F.count("*").alias("rows")).first()
    sinks.write_manifest(path, sinks.artefact(spark, path) | {"balance": n["good"]}, spark)
    found = sinks.artefact(spark, path) | {"balance": n["good"]}
    found["schema"] = [x for x in found["schema"] if x[0] != "c_nationkey"] + [["c_nationkey", "x"]]
    out = sinks.manifest_differences({"rows": n["rows"] + 1, "balance": n["bad"], "schema": [["c_custkey", "int"], ["c_name", "string"]]}, found) + sinks.verify_artefact(spark, path)
    return quality.inline(spark, [(x,) for x in out], "difference string")
