"""The engine's vocabulary on the star-schema tables: who attempts what, when,
with which verdict. Every query is built on these."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.columns import mapped, member
from tallyspan.operators import history, responses
from tallyspan.sources.readers import ATTEMPT_JSON

EVENT_CLASS = {"purchase": "accepted", "view": "partial", "error": "rejected", "click": "unjudged", "signup": "unjudged"}
VERDICTS = {"purchase": "OK", "view": "PARTIAL", "error": "WRONG_ANSWER", "click": "SKIPPED"}
EVIDENCE = ("accepted", "partial", "rejected")
#: Contest numbers from here on are outside the main line.
FLOOR = 1500


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as items: name the first word, contest the key, two in three
    published, rated from a size of 26 on."""
    p = read(spark, sf_dir, "part")
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").alias("item"), F.split("p_name", " ")[0].alias("name"), F.col("p_partkey").alias("contest"),
        F.when(size > 25, F.floor(size / 5).cast("int")).alias("rating"), (F.col("p_partkey") % 3 != 0).alias("published"),
    )


def twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.twin_map(items(spark, sf_dir), floor=1_000_000_000)


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as attempts, with class and evidence flag."""
    e = read(spark, sf_dir, "events")
    kind = mapped(F.col("event_type"), EVENT_CLASS, "unknown", on_null="unjudged")
    item = F.get_json_object("props", "$.k").try_cast("bigint")
    return e.select(F.col("user_id").alias("user"), item.alias("item"), F.col("event_id").alias("attempt"), (kind == "accepted").alias("accepted"), F.col("ts").alias("at"), kind.alias("kind"), member(kind, EVIDENCE).alias("evidence"))


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = attempts(spark, sf_dir).where("evidence").select("user", "item", "attempt", "accepted", "at")
    return responses.response_matrix(own, twins(spark, sf_dir), items(spark, sf_dir))


def customer_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's state by day: priority and status of the day's last order."""
    o = read(spark, sf_dir, "orders")
    last = F.max(F.struct("o_orderkey", "o_orderpriority", "o_orderstatus")).alias("s")
    day = o.groupBy(F.col("o_custkey").alias("customer"), F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("since")).agg(last)
    return day.select("customer", "since", F.col("s.o_orderpriority").alias("priority"), F.col("s.o_orderstatus").alias("status"))


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.versions(customer_states(spark, sf_dir), "customer", "since", ["priority", "status"])


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order's customer."""
    l = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer"))
    return l.join(o, "l_orderkey")


def people(spark: SparkSession, sf_dir: str, table: str = "supplier") -> DataFrame:
    """Suppliers or customers as rated people of countries and organisations."""
    c = table[0]
    t, n = read(spark, sf_dir, table), read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    met = t.join(n, t[f"{c}_nationkey"] == n["n_nationkey"])
    country = F.when(F.col(f"{c}_{'supp' if c == 's' else 'cust'}key") % 7 == 0, F.lit("")).otherwise(F.col("n_name"))
    team = F.concat(F.lit(" team  "), F.substring("n_name", 1, 2), F.lit(" "))
    return met.select(F.col("n_name").alias("nation"), country.alias("country"), team.alias("organization"), F.round(F.col(f"{c}_acctbal")).cast("int").alias("rating"))


def raw_attempts(spark: SparkSession, sf_dir: str, other: str | None = None) -> DataFrame:
    """Events as the first source's JSON, parsed under its declared schema: ghosts,
    teams of none, one and two, and keys by contest, by set or lacking."""
    i = F.col("event_id")
    k = F.get_json_object("props", "$.k").try_cast("int")
    verdict = mapped(F.col("event_type"), VERDICTS, other)
    handle = F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("handle"))
    members = F.when(i % 11 == 0, F.array().cast("array<struct<handle:string>>")).when(i % 3 == 0, F.array(handle, handle)).otherwise(F.array(handle))
    kind = F.when(i % 2 == 0, "CONTESTANT").when(i % 13 != 0, "PRACTICE")
    author = F.struct(F.when(i % 7 == 0, True).when(i % 5 == 0, None).otherwise(False).alias("ghost"), kind.alias("participantType"), members.alias("members"))
    problem = F.struct(F.when(k % 4 != 0, k).alias("contestId"), F.lit("A").alias("index"), F.when(k % 8 == 0, "old").alias("problemsetName"))
    whole = F.struct(i.alias("id"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("creationTimeSeconds"), verdict.alias("verdict"), author.alias("author"), problem.alias("problem"), F.lit(1).alias("unknown"))
    parsed = read(spark, sf_dir, "events").select(F.from_json(F.to_json(whole), ATTEMPT_JSON).alias("r"), F.col("user_id").cast("string").alias("collected_via_handle"))
    return parsed.select("r.*", "collected_via_handle")



def metadata(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events and parts as the second source's rows and index."""
    i = F.col("event_id")
    status = mapped(F.col("event_type"), {"purchase": "Accepted", "view": "Wrong Answer", "error": "Judge Not Available", "click": "odd"}, None)
    accuracy = F.when(i % 4 == 0, "").when(i % 4 == 1, "3/4").when(i % 4 == 2, "bad")
    rows = read(spark, sf_dir, "events").select(
        i.cast("string").alias("submission_id"), F.get_json_object("props", "$.k").alias("problem_id"), F.col("user_id").cast("string").alias("user_id"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("date"),
        F.lit("C").alias("language"), F.lit("C").alias("original_language"), F.lit("c").alias("filename_ext"), status.alias("status"), F.when(i % 9 == 0, -1).otherwise(i % 1000).alias("cpu_time"),
        F.lit(1).alias("memory"), F.lit(2).alias("code_size"), accuracy.alias("accuracy"),
    )
    p = read(spark, sf_dir, "part").where("p_partkey % 3 <> 0")
    index = p.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_brand").alias("dataset"), F.col("p_name").alias("name"), F.col("p_size").alias("time_limit"), F.lit(0).alias("memory_limit"))
    return rows, index


def problemsets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts as problems, one in five of a named set, and what lineitem says of
    them as statistics, which come twice; the smaller count comes first."""
    p, l = read(spark, sf_dir, "part"), read(spark, sf_dir, "lineitem")
    k, named = F.col("p_partkey"), F.col("p_partkey") % 5 == 0
    index = F.when(named, k.cast("string")).otherwise(F.substring("p_type", 1, 1))
    keys = [F.when(~named, k).alias("contestId"), index.alias("index"), named.alias("named")]
    problems = p.select(
        *keys, F.col("p_name").alias("name"), F.lit("P").alias("type"), F.lit(None).cast("double").alias("points"), F.when(F.col("p_size") > 25, F.col("p_size")).alias("rating"),
        F.when(k % 2 == 0, F.split("p_name", " ")).alias("tags"), F.when(named, "archive").alias("problemsetName"),
    )
    seen = l.where("l_returnflag = 'A'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    counts = F.explode(F.array(F.col("n") - 1, F.col("n"), F.lit(None).cast("long"))).alias("solvedCount")
    statistics = p.join(seen, "p_partkey").select(*keys, F.lit(None).cast("string").alias("problemsetName"), counts)
    return problems, statistics
