"""Row-level operators: one row per key, enrichment, as-of joins, surrogates,
differences. All return lazy DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.session import settled


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. With the rank as the only window function,
    Spark cuts groups to one row before the shuffle (WindowGroupLimit)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def richest_per_key(df: DataFrame, keys: Sequence[str], tags: str, tail: Sequence[str]) -> DataFrame:
    """Of the rows of a key the one with the most tags; ties by the tags' text,
    then by the tail columns, which make the order total."""
    return first_per_key(df, keys, [F.size(tags).desc_nulls_last(), F.col(tags).cast("string").asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tail]])


def enrich(df: DataFrame, other: DataFrame, on: str | Sequence[str], flag: str) -> DataFrame:
    """Left join with a flag for rows that found a partner. Sizes decide between
    broadcast and sort-merge; nothing is hinted."""
    return df.join(other.withColumn(flag, F.lit(True)), on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


#: As-of joins: versions that a key may have for its facts to meet them all, and
#: versions that a time bucket may hold for its facts to meet them all.
FEW, CROWD = 32, 16


def as_of(facts: DataFrame, versions: DataFrame, *, key: str, version_key: str, at: str, keep: Sequence[str], few: int = FEW, crowd: int = CROWD, many: DataFrame | None = None) -> DataFrame:
    """Each fact with the version of its key that was valid at its time
    (valid_from <= at < valid_to, open if null); facts without one go.

    No fact meets more than a bounded number of versions. Keys of at most ``few``
    versions are an equi-join with the interval as its residual. The time of a key
    with more is cut into as many buckets as it has versions, so a version is in
    two of them on average, and facts join by key and bucket, which also spreads a
    hot key over tasks. Where a key's versions crowd together in time, so that a
    bucket holds more than ``crowd``, facts and versions are sorted together and
    the last version is carried along, in ranges that may cut a key.

    Versions of a key may overlap (a fact has a row for each), but not in a key
    that crowds, which is an error. Null keys and times find nothing. ``many`` are
    the keys with more than ``few`` versions, if keys_of_many() has looked already."""
    v = _versions(versions, version_key, keep)
    many = keys_of_many(versions, version_key, few) if many is None else many
    inside = (F.col(at) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    if many.isEmpty():
        return facts.join(v, (F.col(key) == F.col("_key")) & inside).drop("_key", "_from", "_to")
    cuts = settled(bucket_cuts(v, few, crowd, many))
    by_bucket = bucketed_facts(facts, cuts, key=key, at=at)
    crowded = not cuts.where("_crowded").isEmpty()
    if crowded:
        by_bucket = settled(by_bucket)
    same = (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("_in"))
    met = by_bucket.where("not _crowded").join(bucketed_versions(v, cuts), same & inside).drop("_key", "_from", "_to", "_in", "_bucket", "_crowded")
    if not crowded:
        return met
    own = by_bucket.where("_crowded").drop("_bucket", "_crowded")
    carried = _carried(own, v.join(cuts.where("_crowded").select("_key"), "_key", "left_semi"), key, at, keep)
    return met.unionByName(carried)


def _micros(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


def _bucket(at: Column) -> Column:
    """0 before the first change of a key, then one after the other, and the last
    one from the last change on."""
    return F.least(F.col("_last"), F.greatest(F.lit(0).cast("long"), F.floor((_micros(at) - F.col("_lo")) / F.col("_width")).cast("long") + 1))


def _versions(versions: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
    return versions.select(F.col(key).alias("_key"), *keep, F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"))


def keys_of_many(versions: DataFrame, version_key: str, few: int = FEW) -> DataFrame:
    """The keys with more than few versions, looked for once for all joins on them."""
    return settled(many_versions(_versions(versions, version_key), few))


def many_versions(v: DataFrame, few: int) -> DataFrame:
    """(_key, _n, _lo, _hi) of the keys with more than few versions, the first of
    which ends at _lo, and the last of which begins at _hi."""
    ends = F.min(_micros(F.col("_to"))).alias("_lo"), F.max(_micros(F.col("_from"))).alias("_hi")
    return v.groupBy("_key").agg(F.count("*").alias("_n"), *ends).where((F.col("_n") > few) & F.col("_key").isNotNull() & F.col("_lo").isNotNull())


def bucket_cuts(v: DataFrame, few: int, crowd: int, many: DataFrame | None = None) -> DataFrame:
    """(_key, _lo, _width, _last, _crowded) of the keys with more than few
    versions: where their buckets begin, how wide they are, the last one's number,
    and whether one of them holds more than crowd versions. A key whose versions
    overlap has wider buckets, so that versions are still in three at most on
    average."""
    n = many if many is not None else many_versions(v, few)
    n = n.select("_key", "_n", "_lo", ((F.greatest("_hi", F.col("_lo") + 1) - F.col("_lo")) / F.col("_n")).alias("_width"), F.col("_n").alias("_last"))
    spread = v.join(n, "_key").groupBy("_key").agg(F.sum(_last_bucket() - _bucket(F.col("_from")) + 1).alias("_cells"))
    wider = F.greatest(F.lit(1.0), F.col("_cells") / (3 * F.col("_n")))
    cuts = n.join(spread, "_key").select("_key", "_lo", (F.col("_width") * wider).alias("_width"), F.ceil(F.col("_last") / wider).alias("_last"))
    held = bucketed_versions(v, cuts).groupBy("_key", "_in").agg(F.count("*").alias("_n")).groupBy("_key").agg((F.max("_n") > crowd).alias("_crowded"))
    return cuts.join(held, "_key")


def _last_bucket() -> Column:
    """The last bucket that a version reaches into; one that ends on a border
    does not reach beyond it."""
    return F.when(F.col("_to").isNull(), F.col("_last")).otherwise(F.greatest(_bucket(F.col("_from")), _bucket(F.timestamp_micros(_micros(F.col("_to")) - 1))))


def bucketed_versions(v: DataFrame, cuts: DataFrame) -> DataFrame:
    """A row of each version for each bucket that it reaches into (_in); all of
    the keys without cuts are in bucket 0."""
    met = v.join(cuts.select("_key", "_lo", "_width", "_last"), "_key", "left")
    reached = F.when(F.col("_width").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(_bucket(F.col("_from")), _last_bucket()))
    return met.withColumn("_in", F.explode(reached)).drop("_lo", "_width", "_last")


def bucketed_facts(facts: DataFrame, cuts: DataFrame, *, key: str, at: str) -> DataFrame:
    """facts with their _bucket, and whether their key crowds."""
    own = cuts.withColumnRenamed("_key", "_cut")
    met = facts.join(own, F.col(key) == F.col("_cut"), "left")
    bucket = F.when(F.col("_width").isNull(), F.lit(0).cast("long")).otherwise(_bucket(F.col(at)))
    return met.select(*[F.col(c) for c in facts.columns], bucket.alias("_bucket"), F.coalesce("_crowded", F.lit(False)).alias("_crowded"))


def in_ranges(df: DataFrame, *order: str) -> DataFrame:
    """df in ranges of an order, settled, with the range's number in _part."""
    return settled(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))


def _carried(facts: DataFrame, v: DataFrame, key: str, at: str, keep: Sequence[str]) -> DataFrame:
    """as_of() by one sort of facts and versions: within a range a window carries
    the last version, and from range to range the last of each key that goes on (a
    row for each key and range)."""
    version = F.struct(*keep, "_from", "_to")
    own = facts.select(F.col(key).alias("_k"), _micros(F.col(at)).alias("_t"), F.lit(1).alias("_kind"), F.struct(*facts.columns).alias("_fact")).where("_t is not null")
    theirs = v.select(F.col("_key").alias("_k"), _micros(F.col("_from")).alias("_t"), F.lit(0).alias("_kind"), version.alias("_version"))
    rows = in_ranges(own.unionByName(theirs, allowMissingColumns=True), "_k", "_t", "_kind")
    tails = rows.groupBy("_k", "_part").agg(F.max_by("_version", F.when(F.col("_version").isNotNull(), F.col("_t"))).alias("_tail"))
    earlier = Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select("_k", "_part", F.last("_tail", ignorenulls=True).over(earlier).alias("_carry")).where("_carry is not null")
    within = Window.partitionBy("_part", "_k").orderBy("_t", "_kind")
    met = rows.join(carry, ["_k", "_part"], "left")
    before = F.coalesce(F.last("_version", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.col("_carry"))
    met = met.withColumn("_before", before)
    if not met.where("_kind = 0 and _before is not null and (_before._to is null or _before._to > _version._from)").isEmpty():
        raise ValueError("versions of one key overlap")
    ends = F.col("_before._to")
    valid = F.col("_before").isNotNull() & (ends.isNull() | (F.col(f"_fact.{at}") < ends))
    return met.where((F.col("_kind") == 1) & valid).select("_fact.*", *[F.col(f"_before.{c}").alias(c) for c in keep])


def number_keys(df: DataFrame, key: str, out: str) -> DataFrame:
    """Dense numbers of a key in its order, from 1; rows with a null key stay and
    have none, apart from the join, where all of them would meet in one task. Only
    distinct keys meet in one place, and of these only the count of each range:
    ranges are numbered apart and shifted by the ranges before. Ranges are drawn by
    a sample, so they are settled before anything counts."""
    keys = in_ranges(df.select(key).where(F.col(key).isNotNull()).distinct(), key)
    sizes = keys.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select("_part", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    numbered = keys.withColumn("_in", inside).join(shifts, "_part").select(F.col(key).alias("_key"), (F.col("_before") + F.col("_in")).cast("long").alias(out))
    met = df.where(F.col(key).isNotNull()).join(numbered, F.col(key) == F.col("_key")).drop("_key")
    return met.unionByName(df.where(F.col(key).isNull()).withColumn(out, F.lit(None).cast("long")))


def group_median(df: DataFrame, key: str, value: str, out: str = "median", accuracy: int = 10_000) -> DataFrame:
    """(key, out): the exact median of each group, in bounded memory for groups of
    any size; F.median holds a count of each distinct value of a group in one buffer.

    A sketch of at most ``accuracy`` values a group brackets the median: of n values
    the bounds are of ranks within 4 n / accuracy of the middle. Values below are
    counted alone, those between by value, and only these are ranked. Values that
    repeat cost a row each once. Nulls are no values; a group without any has a null
    median, and a null key is a group. NaN counts as the greatest value."""
    rows = df.select(F.col(key).alias("_k"), F.col(value).cast("double").alias("_v"))
    off = 3.0 / accuracy
    bounds = F.percentile_approx("_v", [0.5 - off, 0.5 + off], accuracy)
    stats = rows.groupBy("_k").agg(F.count("_v").alias("_n"), bounds.alias("_b")).select(F.col("_k").alias("_key"), "_n", F.col("_b")[0].alias("_low"), F.col("_b")[1].alias("_high"))
    near = rows.join(stats, F.col("_k").eqNullSafe(F.col("_key")))
    near = near.where("_v <= _high").withColumn("_v", F.when(F.col("_v") >= F.col("_low"), F.col("_v")))
    counted = near.groupBy("_key", "_v").agg(F.count("*").alias("_c"), F.max("_n").alias("_n"))
    upto = F.sum("_c").over(Window.partitionBy("_key").orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("_upto", upto)
    at = lambda rank: F.max(F.when((F.col("_upto") - F.col("_c") < rank) & (F.col("_upto") >= rank), F.col("_v")))
    middle = ranked.groupBy("_key").agg(at(F.floor((F.col("_n") + 1) / 2)).alias("_a"), at(F.floor(F.col("_n") / 2) + 1).alias("_b"))
    found = F.when(F.col("_a").isNull() | F.col("_b").isNull(), F.raise_error(F.lit("a median lies outside its bracket"))).otherwise((F.col("_a") + F.col("_b")) / 2)
    medians = middle.select(F.col("_key").alias("_k"), found.alias(out))
    groups = stats.select("_key")
    return groups.join(medians, F.col("_key").eqNullSafe(F.col("_k")), "left").select(F.col("_key").alias(key), out)


def missing_keys(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Distinct keys of df that other lacks (EXCEPT; safe where NOT IN is not)."""
    return df.select(key).subtract(other.select(key))


def exists_flag(df: DataFrame, other: DataFrame, key: str, flag: str) -> DataFrame:
    """df with whether its key occurs in other."""
    return enrich(df, other.select(key).distinct(), key, flag)


def difference(a: DataFrame, b: DataFrame, key: str, exact: Sequence[str], near: Sequence[str], tolerance: float = 0.011) -> DataFrame:
    """Rows where two results by key disagree: (key, column, left_value,
    right_value). exact columns must be equal, near ones within tolerance; null
    agrees with null, and a key on one side only disagrees in column '(row)'."""
    x = a.select(F.col(key).alias("k"), F.struct(*exact, *near).alias("x"))
    y = b.select(F.col(key).alias("k"), F.struct(*exact, *near).alias("y"))
    both = x.join(y, "k", "full_outer")
    found = [F.struct(F.lit("(row)").alias("column"), F.when(F.col("x").isNotNull(), "present").alias("left_value"), F.when(F.col("y").isNotNull(), "present").alias("right_value"), (F.col("x").isNull() != F.col("y").isNull()).alias("bad"))]
    paired = F.col("x").isNotNull() & F.col("y").isNotNull()
    for c in [*exact, *near]:
        p, q = F.col(f"x.{c}"), F.col(f"y.{c}")
        agree = p.eqNullSafe(q) if c in exact else (p.isNull() & q.isNull()) | F.coalesce(F.abs(p - q) <= tolerance, F.lit(False))
        found.append(F.struct(F.lit(c).alias("column"), p.cast("string").alias("left_value"), q.cast("string").alias("right_value"), (paired & ~agree).alias("bad")))
    return both.select(F.col("k").alias(key), F.explode(F.filter(F.array(*found), lambda s: s["bad"])).alias("d")).select(key, "d.column", "d.left_value", "d.right_value")


def sample_per_group(df: DataFrame, group: str, key: str, sizes: dict[str, int], seed: int) -> DataFrame:
    """A fixed sample of each group: the ``sizes[group]`` rows of least seeded
    md5 of the key; the whole group if the size is 0 or less, or not smaller.

    Only counts are shuffled. Rows are counted by group and the md5's first four
    digits; the running count tells the digits where a group's sample ends. Rows
    below them stay where they are, as do whole groups, rows above go, and only the
    rows of these digits, one in 65,536, are ranked. Null groups are kept whole;
    ties in md5 by key, and rows of one key in any order."""
    wanted = F.coalesce(F.try_element_at(F.create_map(*[x for g, n in sizes.items() for x in (F.lit(g), F.lit(n))]), F.col(group)), F.lit(0)) if sizes else F.lit(0)
    hashed = df.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))))
    digits = F.substring("_hash", 1, 4)
    counts = hashed.where(wanted > 0).groupBy(F.col(group).alias("_group"), digits.alias("_digits"), wanted.alias("_wanted")).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_group").orderBy("_digits"))
    ends = counts.withColumn("_upto", upto).where("_upto >= _wanted and _upto - _n < _wanted")
    # One row for each group that sizes names, so its size is the parameter's.
    ends = F.broadcast(ends.select("_group", F.col("_digits").alias("_end"), (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_more")))
    met = hashed.join(ends, F.col(group) == F.col("_group"), "left")
    extra = ("_hash", "_group", "_end", "_more")
    below = met.where(F.col("_end").isNull() | (digits < F.col("_end"))).drop(*extra)
    rank = F.row_number().over(Window.partitionBy("_group").orderBy("_hash", key))
    last = met.where(digits == F.col("_end")).withColumn("_rank", rank).where("_rank <= _more").drop(*extra, "_rank")
    return below.unionByName(last)
