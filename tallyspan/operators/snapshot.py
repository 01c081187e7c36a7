"""Snapshots of published problemsets: problems joined with their statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.columns import first_complete_key

#: Fixed value: the source of the set that is asked for without a name.
MAIN = "main"


def problemset(problems: DataFrame, statistics: DataFrame, fetched_at: str, *, name: str | None = None) -> DataFrame:
    """Records of one set. problems: contestId, index, name, type, points, rating,
    tags, problemsetName; statistics: contestId, index, problemsetName,
    solvedCount; name: the set's, if it was asked for by name.

    A problem's key is its contest and index, else its set's name and index. The
    answer to a request by name leaves the name out of its statistics, so these
    take it from the request; problems always carry it. Of repeated statistics
    the last counts, and those without a count say nothing. Errors: a problem or
    a statistic without a key, a repeated problem, and a statistic of a problem
    that is not listed. Null tags are an empty list.
    """
    listed = problems.withColumn("problem_id", first_complete_key((F.col("contestId"), F.col("index")), (F.col("problemsetName"), F.col("index"))))
    named = F.coalesce("problemsetName", F.lit(name))
    keyed = statistics.select(first_complete_key((F.col("contestId"), F.col("index")), (named, F.col("index"))).alias("problem_id"), F.col("solvedCount").cast("long").alias("solved"), F.monotonically_increasing_id().alias("at"))
    if keyed.where("problem_id is null").head(1):
        raise ValueError(f"{name or MAIN}: a statistic has no key")
    counted = keyed.where("solved is not null").groupBy("problem_id").agg(F.max_by("solved", "at").alias("solved_count"))
    twice = listed.groupBy("problem_id").agg(F.count("*").alias("n")).where("n > 1 or problem_id is null").head(1)
    if twice:
        raise ValueError(f"{name or MAIN}: problem {twice[0]['problem_id']} occurs {twice[0]['n']} times")
    stray = counted.join(listed.select("problem_id"), "problem_id", "left_anti").head(1)
    if stray:
        raise ValueError(f"{name or MAIN}: statistics of {stray[0]['problem_id']}, which is not listed")
    # Fixed format: the columns of a snapshot's records.
    return listed.join(counted, "problem_id", "left").select(
        "problem_id", F.col("contestId").alias("contest_id"), F.col("problemsetName").alias("problemset_name"), F.lit(name or MAIN).alias("problemset_source"), F.col("index").alias("problem_index"),
        F.col("name").alias("problem_name"), F.col("type").alias("problem_type"), F.col("points").alias("problem_points"), F.col("rating").alias("problem_rating"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("problem_tags"), "solved_count", F.lit(fetched_at).alias("fetched_at"),
    )


def together(sets: list[DataFrame]) -> DataFrame:
    """Records of several sets; an error if they share a key."""
    out = reduce(DataFrame.unionByName, sets)
    both = out.groupBy("problem_id").agg(F.count("*").alias("n")).where("n > 1").head(1)
    if both:
        raise ValueError(f"problem {both[0]['problem_id']} is in several sets")
    return out
