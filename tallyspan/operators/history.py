"""Slowly changing dimensions: building versions, and the rules they must keep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.columns import OPENING, surrogate_key


def versions(states: DataFrame, key: str, since: str, attributes: Sequence[str]) -> DataFrame:
    """(sk, key, attributes, valid_from, valid_to, is_current) from one row per
    key and time. The first version opens at the sentinel, each ends where the
    next begins, the last is open. Each state is a version, also one that changed
    nothing."""
    order = Window.partitionBy(key).orderBy(since)
    opening = F.lit(OPENING).cast("timestamp_ntz")
    start = F.when(F.lag(since).over(order).isNull(), opening).otherwise(F.col(since))
    out = states.select(key, *attributes, since, start.alias("valid_from"), F.lead(since).over(order).alias("valid_to"))
    sk = surrogate_key(F.col(key), F.date_format("valid_from", "yyyy-MM-dd"))
    return out.select(sk.alias("sk"), key, *attributes, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def violations(dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(check, key, n) of broken version rules over several dimensions, keys
    prefixed by their dimension's name so that key spaces cannot collide.

    single_current: a key without exactly one current version. overlap: pairs of
    versions of which the later begins before the earlier ends, two that begin
    together included (an open end is never reached). Pairs are counted in one
    ordered pass over begins and ends of a key: at its begin, a version overlaps
    with as many as are open. A self join would make each pair a row.
    """
    parts = None
    for name, (df, key) in dims.items():
        part = df.select(F.concat(F.lit(f"{name}:"), F.col(key).cast("string")).alias("key"), "valid_from", "valid_to", "is_current")
        parts = part if parts is None else parts.unionByName(part)
    single = parts.groupBy("key").agg(F.sum(F.col("is_current").cast("long")).alias("n")).where("n <> 1").select(F.lit("single_current").alias("check"), "key", "n")
    lasting = F.coalesce(F.col("valid_from") < F.col("valid_to"), F.col("valid_to").isNull())
    begin = F.struct(F.col("valid_from").alias("at"), F.lit(1).alias("kind"), lasting.cast("long").alias("step"))
    end = F.when(lasting & F.col("valid_to").isNotNull(), F.struct(F.col("valid_to").alias("at"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("step")))
    events = parts.select("key", F.explode(F.array_compact(F.array(begin, end))).alias("e")).select("key", "e.*")
    earlier = Window.partitionBy("key").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, -1)
    opened = events.withColumn("open", F.coalesce(F.sum("step").over(earlier), F.lit(0))).where("kind = 1 and open > 0")
    overlap = opened.groupBy("key").agg(F.sum("open").alias("n")).select(F.lit("overlap").alias("check"), "key", "n")
    return single.unionByName(overlap)


def outside(facts: DataFrame, dim: DataFrame, at: str) -> DataFrame:
    """Facts whose time lies outside the version their sk names."""
    v = dim.select("sk", F.col("valid_from").alias("_from"), F.coalesce("valid_to", F.lit("9999-12-31").cast("timestamp_ntz")).alias("_to"))
    return facts.join(v, "sk").where((F.col(at) < F.col("_from")) | (F.col(at) >= F.col("_to"))).drop("_from", "_to")


def count_outside(facts: DataFrame, dim: DataFrame, at: str, *, key: str, many: DataFrame, opens: Mapping[str, Column]) -> DataFrame:
    """One row with a count for each name of ``opens``: facts whose time lies outside
    the version their sk names, if that began at this column of dim. One join serves
    all of them.

    facts are as as_of() gives them, with the dimension's key: their sk names a version
    of that key. Where no key has more than a few versions (``many``, as of
    rows.keys_of_many(), is empty), facts meet all versions of their key; as_of() and
    versions() have dealt both sides by key, and none is dealt again by its sk, of
    which a row is twice as wide. Else they meet by sk."""
    end = F.coalesce("valid_to", F.lit("9999-12-31").cast("timestamp_ntz"))
    v = dim.select(F.col(key).alias("_key"), F.col("sk").alias("_sk"), end.alias("_to"), *[c.alias(f"_{name}") for name, c in opens.items()])
    own, named = F.col(key) == F.col("_key"), F.col("sk") == F.col("_sk")
    met = facts.join(v, own if many.isEmpty() else named)
    return met.agg(*[F.count_if(named & ((F.col(at) < F.col(f"_{name}")) | (F.col(at) >= F.col("_to")))).alias(name) for name in opens])
