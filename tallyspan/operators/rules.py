"""Rules over whole tables. Each returns the rows that break it; none is good.

They derive what they check anew from its sources, so that a wrong flag can not
vouch for itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.columns import full_match
from tallyspan.operators.rows import missing_keys


def unknown_classes(facts: DataFrame, kind: str, raw: str) -> DataFrame:
    """Raw values that no class is known for, with their counts."""
    return facts.where(F.col(kind) == "unknown").groupBy(raw).agg(F.count("*").alias("n"))


def unresolved_ids(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Ids that the dimension lacks; EXCEPT, as NOT IN says nothing once a null
    is on the right."""
    return missing_keys(child, parent, key)


def outside_partition(df: DataFrame, column: str, allowed: Sequence[str], key: str, pattern: str) -> DataFrame:
    """Rows whose column is not allowed, or whose key is not of the pattern."""
    return df.where(~F.col(column).isin(*allowed) | ~full_match(F.col(key), pattern))


def uncovered(corpus: DataFrame, dimension: DataFrame, key: str, dimension_key: str) -> DataFrame:
    """One row of both counts, if the corpus has another number of distinct keys
    than the dimension has rows."""
    a = corpus.agg(F.countDistinct(key).alias("corpus"))
    return a.join(dimension.agg(F.count(dimension_key).alias("dimension"))).where("corpus <> dimension")


def ambiguous_keys(df: DataFrame, key: str, identity: Sequence[str]) -> DataFrame:
    """Keys that stand for several identities (nulls are values here)."""
    return df.groupBy(key).agg(F.countDistinct(F.struct(*identity)).alias("n")).where("n > 1")


def disagreeing(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """Keys of both tables whose column differs; null differs from a value."""
    x, y = a.select(key, F.col(column).alias("left_value")), b.select(key, F.col(column).alias("right_value"))
    return x.join(y, key).where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def small_cells(published: DataFrame, members: DataFrame, group: str, statistics: Sequence[str], least: int, name: Column | None = None) -> DataFrame:
    """Published cells with a statistic although, counted again from the people
    themselves, fewer than ``least`` stand behind them."""
    counted = members.groupBy((F.col(group) if name is None else name).alias(group)).agg(F.count("*").alias("_n"))
    shown = F.lit(False)
    for c in statistics:
        shown = shown | F.col(c).isNotNull()
    return published.join(counted, group).where((F.col("_n") < least) & shown).select(group, F.col("_n").alias("n"))
