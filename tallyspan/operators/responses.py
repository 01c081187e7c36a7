"""Twin items, the response matrix and its temporal split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rating_class(a: Column, b: Column) -> Column:
    return F.when(a.isNull() & b.isNull(), "both_unrated").when(a.isNull() | b.isNull(), "exactly_one_unrated").when(a == b, "agree").otherwise("differs")


#: The classes of rating_class.
CLASSES = ("both_unrated", "exactly_one_unrated", "agree", "differs")


def passes(kind: Column) -> Column:
    """Only two known, different ratings tell twins apart."""
    return kind != "differs"


def pairs(left: DataFrame, right: DataFrame, gap: int) -> DataFrame:
    """(left_item, right_item, kind) with equal names and right's contest = left's
    + gap. Both sides: item, name, contest, rating. The sum is a hash key like
    any other, so this is an equi-join."""
    l, r = left.alias("l"), right.alias("r")
    met = l.join(r, (F.col("l.name") == F.col("r.name")) & (F.col("r.contest") == F.col("l.contest") + gap))
    return met.select(F.col("l.item").alias("left_item"), F.col("r.item").alias("right_item"), rating_class(F.col("l.rating"), F.col("r.rating")).alias("kind"))


def in_scope(items: DataFrame, floor: int, above: bool = False) -> DataFrame:
    known = items.where("contest is not null and name is not null")
    return known.where(F.col("contest") >= floor if above else F.col("contest") < floor)


def twin_map(items: DataFrame, floor: int) -> DataFrame:
    """(absent, present, kind) of unpublished items whose twin was published one
    contest earlier. items: item, name, contest, rating, published."""
    own = in_scope(items, floor)
    return pairs(own.where("not published"), own.where("published"), -1).where(passes(F.col("kind"))).select(F.col("left_item").alias("absent"), F.col("right_item").alias("present"), "kind")


def ambiguous(twins: DataFrame) -> DataFrame:
    """Absent items with several partners; a map must have none."""
    return twins.groupBy("absent").agg(F.count("*").alias("n")).where("n > 1")


def checked(twins: DataFrame) -> DataFrame:
    """twins, or an error that names an ambiguous item."""
    bad = ambiguous(twins).head(1)
    if bad:
        raise ValueError(f"item {bad[0]['absent']} has {bad[0]['n']} twins")
    return twins


def twin_audit(items: DataFrame, floor: int) -> DataFrame:
    """(population, kind, n) of pairs that the map leaves out: the twin published
    one contest later, both published, and pairs from the floor up."""
    own = in_scope(items, floor)
    absent, present = own.where("not published"), own.where("published")
    gym = in_scope(items, floor, above=True)
    out = None
    for name, df in (("reversed", pairs(absent, present, 1)), ("both_published", pairs(present, present, 1)), ("from_floor", pairs(gym, gym, 1))):
        part = df.groupBy("kind").agg(F.count("*").alias("n")).select(F.lit(name).alias("population"), "kind", "n")
        out = part if out is None else out.unionByName(part)
    return out


def twin_counts(items: DataFrame, floor: int) -> dict[str, int]:
    """Counts of pairs of an unpublished item and a published one, by class, one
    contest before it (gap_*, of which ``qualifying`` pass the rating clause) and
    one after it (reversed_*). Matches and pairs that pass are counted apart from
    the classes, so that a clause or class that changes shows."""
    own = in_scope(items, floor)
    absent, present = own.where("not published"), own.where("published")
    out: dict[str, int] = {}
    for name, gap in (("gap", -1), ("reversed", 1)):
        met = pairs(absent, present, gap)
        row = met.agg(F.count("*").alias("matches"), F.count_if(passes(F.col("kind"))).alias("passing"), *[F.count_if(F.col("kind") == k).alias(k) for k in CLASSES]).first()
        out |= {f"{name}_{k}": v for k, v in row.asDict().items()}
    out["qualifying"] = out["gap_passing"]
    return out


def response_matrix(attempts: DataFrame, twins: DataFrame, items: DataFrame) -> DataFrame:
    """One row per user and merged item: its first attempt, how many there were,
    and whether one was accepted.

    attempts: user, item, attempt (unique), accepted, at. An aggregate with a
    minimum over structs: partial results combine before the shuffle, where a
    rank with two whole-partition windows would sort every attempt.
    """
    merged = attempts.join(twins.select(F.col("absent").alias("item"), "present"), "item", "left").withColumn("source_item", F.col("item")).withColumn("item", F.coalesce("present", "item"))
    first = F.min(F.struct("attempt", "source_item", "accepted", "at")).alias("f")
    per = merged.groupBy("user", "item").agg(first, F.count("*").alias("attempts"), F.coalesce(F.bool_or("accepted"), F.lit(False)).alias("ever_accepted"))
    rows = per.select("user", "item", "f.source_item", "f.attempt", "f.accepted", "f.at", "attempts", "ever_accepted")
    return rows.join(items.select("item", "published", "rating", "contest"), "item")


def matrix_counts(attempts: DataFrame, twins: DataFrame, matrix: DataFrame) -> DataFrame:
    """One row of what a built matrix must add up to: attempts and their ids,
    responses before and after merging, items that were merged, and the bank."""
    before = attempts.agg(F.count("*").alias("attempts"), F.countDistinct("attempt").alias("distinct_attempts"), F.countDistinct(F.struct("user", "item")).alias("unmerged_responses"))
    merged = attempts.join(twins, attempts["item"] == twins["absent"], "left_semi").select("item").distinct().agg(F.count("*").alias("merged_items"))
    after = matrix.agg(
        F.count("*").alias("responses"), F.coalesce(F.sum("attempts"), F.lit(0)).alias("merged_attempts"), F.count_if("published").alias("bank"),
        F.count_if(F.col("published") & F.col("accepted")).alias("bank_accepted"),
    )
    return before.join(merged).join(after).join(twins.agg(F.count("*").alias("twins")))


def temporal_split(bank: DataFrame, cutoff: Column) -> DataFrame:
    """One row: train and test sizes, and the test's four exclusive classes by
    whether user and item occur before the cutoff.

    First occurrences come from two aggregates of the bank, joined back by key;
    no row is compared with all users or items.
    """
    before = (F.col("at") < cutoff).cast("int")
    users = bank.groupBy("user").agg((F.max(before) == 1).alias("known_user"))
    items = bank.groupBy("item").agg((F.max(before) == 1).alias("known_item"))
    tagged = bank.join(users, "user").join(items, "item")
    test, u, i = F.col("at") >= cutoff, F.col("known_user"), F.col("known_item")
    return tagged.agg(
        F.count_if(~test).alias("train"), F.count_if(test).alias("test"), F.count_if(test & u & i).alias("known_both"), F.count_if(test & u & ~i).alias("new_item_only"),
        F.count_if(test & ~u & i).alias("new_user_only"), F.count_if(test & ~u & ~i).alias("both_new"), F.count_if(test & u & i & F.col("accepted")).alias("known_both_accepted"),
    )


def broken_invariants(n: dict[str, int]) -> list[str]:
    """Rules between the counts of a built matrix; empty if all hold."""
    rules = {
        "attempt ids are unique": n["distinct_attempts"] == n["attempts"],
        "merging keeps every attempt": n["merged_attempts"] == n["attempts"],
        "merging adds no response": n["responses"] <= n["unmerged_responses"],
        "only mapped items are merged": n["merged_items"] <= n["twins"],
        "train and test make up the bank": n["train"] + n["test"] == n["bank"],
        "the test's classes make it up": n["known_both"] + n["new_item_only"] + n["new_user_only"] + n["both_new"] == n["test"],
        "accepted are among known": n["known_both_accepted"] <= n["known_both"],
        "a test has known responses": not n["test"] or n["known_both"] > 0,
        "no twin has one side unrated or another rating": not n["gap_exactly_one_unrated"] and not n["gap_differs"],
        "the rating clause leaves out no pair": n["qualifying"] == n["gap_matches"],
        "every reversed pair is of one class": sum(n[f"reversed_{k}"] for k in CLASSES) == n["reversed_matches"],
        "classes that pass are the pairs that pass": sum(n[f"reversed_{k}"] for k in CLASSES if k != "differs") == n["reversed_passing"],
    }
    return [rule for rule, holds in rules.items() if not holds]
