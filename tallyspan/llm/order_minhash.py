"""Order MinHash fingerprints (after Marcais et al., 2019) over letters.

A text is the sequence of its k-mers of code points, each numbered by its
occurrence. A signature takes ``length`` of these with the least hash values,
keeps them in their text order and hashes the tuple, so that two texts agree in
a signature only where they share these k-mers *and* their order: likeness
follows edit distance rather than overlap.

One permutation serves all signatures. A k-mer's hash has a bin (one for each
signature) and an offset; signature j takes the least offsets of bin j, and goes
on to the next bins, round the end, where bin j has too few. A first occurrence
stands at the bin and offset of its k-mer's hash. The c-th further one has a hash
of its own, of the k-mer and c: its bin is of that hash, and its offset is that
hash's or the k-mer's, whichever is larger. So the occurrences of one k-mer are
spread over offsets, and a text that repeats a line is not signed by the one
k-mer of least offset alone.

As no occurrence has a lesser offset than its k-mer, k-mers of large offsets can
be left aside before anything is sorted: in a text of many k-mers only those below
an offset that leaves about ``spare`` to each bin are sorted and numbered. Where
some bin then has too few below that offset, as in a text that repeats itself,
all k-mers of the text are sorted and numbered instead. So the result is that of
all k-mers.

All is done by array functions within a row. A long value holds 33 bits of hash
over 30 bits of place, sorts as a primitive, and a bin's begin is found by binary
search. Only DataFrame functions are used.

Edge cases. Null text: as empty; an empty text has the fingerprint of zeros and
is like another such text (1.0). Fewer letters than k: one k-mer. Repeated rows
(same id and text) are one document in the order of documents and each get its
result; rows of one id with different texts follow by their hash. Null doc_id
comes first. One document: it is its own next. Equal hashes: by place in the
text. Long texts: whole (up to 2^29 letters). Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import written

#: Bits of a packed value's place, and of its hash.
POS, HASH = 30, 33
PLACE = (1 << POS) - 1


def _key(v: Column) -> Column:
    return F.shiftright(v, POS)


def _kmers(text: Column, k: int) -> Column:
    """Packed values of all k-mers in text order; empty for an empty text. The
    array around the encoded text keeps it from being copied at every k-mer."""
    high = F.lit(((1 << HASH) - 1) << POS)

    def of(data: Column) -> Column:
        last = F.greatest(F.octet_length(data) - (4 * k - 1), F.lit(1))
        return F.transform(F.sequence(F.lit(1), last, F.lit(4)), lambda i: F.xxhash64(F.substring(data, i, F.lit(4 * k))).bitwiseAND(high).bitwiseOR(i.cast("long")))

    found = F.get(F.transform(F.array(F.encode(text, "UTF-32")), of), F.lit(0))
    return F.when(F.length(text) > 0, found).otherwise(F.array().cast("array<bigint>"))


def _numbered(df: DataFrame, kmers: Column, out: str, offset: int) -> DataFrame:
    """df with the sorted packed values of occurrence-numbered k-mers."""
    ordered, again = f"{out}_sorted", f"{out}_again"
    df = df.withColumn(ordered, F.sort_array(kmers))
    same = lambda v, t: (t > 0) & (v.bitwiseXOR(F.get(ordered, t - 1)) < F.lit(1 << POS))
    df = df.withColumn(again, F.filter(ordered, same))

    # Further occurrences: a run of equal hashes is numbered from 1.
    last = F.size(again) - 1
    starts = F.filter(F.sequence(F.lit(0), last), lambda t: (t == 0) | (_key(F.get(again, t)) != _key(F.get(again, t - 1))))
    df = df.withColumn(f"{out}_runs", F.when(last >= 0, starts))
    runs = F.col(f"{out}_runs")
    occurrence = F.flatten(F.transform(runs, lambda s, j: F.sequence(F.lit(1), F.coalesce(F.get(runs, j + 1), last + 1) - s)))
    low, high = F.lit((1 << offset) - 1), F.lit((1 << HASH) - (1 << offset))
    own = lambda v, o: F.xxhash64(_key(v), o)
    at = lambda v, o: own(v, o).bitwiseAND(high).bitwiseOR(F.greatest(own(v, o).bitwiseAND(low), _key(v).bitwiseAND(low)))
    moved = F.zip_with(again, occurrence, lambda v, o: F.shiftleft(at(v, o), POS).bitwiseOR(v.bitwiseAND(F.lit(PLACE))))
    first = F.filter(ordered, lambda v, t: ~same(v, t))
    df = df.withColumn(out, F.when(last >= 0, F.sort_array(F.concat(first, moved))).otherwise(F.col(ordered)))
    return df.drop(ordered, again, f"{out}_runs")


def _begins(order: str, points: Column) -> Column:
    """For each point, how many values of a sorted array are below it."""
    n = F.size(order)
    steps = F.transform(F.sequence(F.floor(F.log2(n)).cast("int"), F.lit(0), F.lit(-1)), lambda e: F.pow(F.lit(2), e).cast("int"))
    below = lambda p, ss: F.aggregate(ss, F.lit(0), lambda at, s: F.when((at + s <= n) & (F.get(order, at + s - 1) < p), at + s).otherwise(at))
    return F.when(n > 0, F.get(F.transform(F.array(steps), lambda ss: F.transform(points, lambda p: below(p, ss))), F.lit(0)))


def with_signatures(df: DataFrame, text: str, out: str, *, k: int = 6, length: int = 2, signatures: int = 64, spare: int = 24) -> DataFrame:
    """df with the array of signatures of a text column (not null). signatures
    is a power of two."""
    if signatures & (signatures - 1):
        raise ValueError(f"{signatures} signatures: not a power of two")
    offset = HASH - signatures.bit_length() + 1
    kmers, some, order, begins = (f"_{out}_{x}" for x in ("kmers", "some", "order", "begins"))
    points = F.array(*[F.lit(j << (POS + offset)) for j in range(signatures)])
    df = df.withColumn(kmers, _kmers(F.col(text), k))

    most = F.floor(F.lit(float(spare * signatures << offset)) / F.size(kmers)).cast("long")
    low = F.lit(((1 << offset) - 1) << POS)
    few = F.get(F.transform(F.array(F.shiftleft(most, POS)), lambda m: F.filter(kmers, lambda v: v.bitwiseAND(low) < m)), F.lit(0))
    df = _numbered(df, F.when(F.size(kmers) > spare * signatures, few).otherwise(F.col(kmers)), some, offset)
    df = df.withColumn(begins, _begins(some, points))
    # Above the bound, values of some are not complete.
    ends = F.zip_with(begins, points, lambda b, p: F.coalesce(F.get(some, b + (length - 1)) - p < F.shiftleft(most, POS), F.lit(False)))
    df = df.withColumn("_short", (F.size(kmers) > spare * signatures) & ~F.coalesce(F.forall(ends, lambda x: x), F.lit(False)))
    df = _numbered(df, F.when(F.col("_short"), F.col(kmers)), order, offset)
    df = df.withColumn(order, F.when(F.col("_short"), F.col(order)).otherwise(F.col(some)))
    df = df.withColumn(begins, F.when(F.col("_short"), _begins(order, points)).otherwise(F.col(begins)))

    n = F.size(order)
    turned = lambda v: F.shiftleft(v.bitwiseAND(F.lit(PLACE)), HASH).bitwiseOR(_key(v))
    taken = lambda b: F.array_sort(F.array(*[turned(F.get(order, (b + q) % n)) for q in range(length)]))
    hashed = lambda xs: F.xxhash64(F.transform(xs, lambda x: x.bitwiseAND(F.lit((1 << HASH) - 1)))).bitwiseAND(F.lit(0xFFFFFFFF))
    df = df.withColumn(out, F.when(n > 0, F.transform(begins, lambda b: hashed(taken(b)))).otherwise(F.array_repeat(F.lit(0).cast("long"), signatures)))
    return df.drop(kmers, some, order, begins, "_short")


def fingerprint(signatures: Column) -> Column:
    return F.array_join(F.transform(signatures, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of signatures that agree."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(a)


def next_documents(docs: DataFrame) -> DataFrame:
    """(id, h, n, next_id, next_h): each distinct document (id, h) and the one
    that follows in the order of ids, the first after the last. Only ids and
    hashes are moved: ranges of ids are sorted apart, and the ranges' first
    documents, one row for each partition, close the gaps."""
    nodes = docs.select("id", "h", "n").distinct().repartitionByRange("id", "h").withColumn("part", F.spark_partition_id())
    nodes = written(nodes, "order-nodes")
    heads = nodes.groupBy("part").agg(F.min(F.struct("id", "h")).alias("head"))
    around = Window.orderBy("part")
    following = heads.select("part", F.coalesce(F.lead("head").over(around), F.first("head").over(around)).alias("after"))
    inside = F.lead(F.struct("id", "h")).over(Window.partitionBy("part").orderBy("id", "h"))
    linked = nodes.withColumn("inside", inside).join(following, "part").withColumn("next", F.coalesce("inside", "after"))
    return linked.select("id", "h", "n", F.col("next.id").alias("next_id"), F.col("next.h").alias("next_h"))


def compare_with_edited(docs: DataFrame, **options) -> DataFrame:
    """Each row of docs (doc_id, text) with its fingerprint, that of its edited
    text (the last half replaced by the next document's beginning), and the
    likeness of both, and of its own and the next document's."""
    text = F.coalesce("text", F.lit(""))
    first = F.lit(-(1 << 63)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.coalesce("doc_id", first).alias("id"), F.xxhash64("text").alias("h"), F.length("text").alias("n"), "text")
    links = written(next_documents(rows), "order-links")
    # Both joins below need the same columns of this, so it is shuffled once.
    signed = with_signatures(rows.drop("n"), "text", "own", **options).repartition("id", "h")
    asked = links.select(F.col("id").alias("for_id"), F.col("h").alias("for_h"), F.floor(F.col("n") / 2).cast("int").alias("want"), F.col("next_id").alias("id"), F.col("next_h").alias("h"))
    given = signed.join(asked, ["id", "h"]).select(F.col("for_id").alias("id"), F.col("for_h").alias("h"), F.expr("left(text, want)").alias("tail"), F.col("own").alias("next"), F.col("doc_id").alias("next_doc_id"))
    given = given.dropDuplicates(["id", "h"])
    half = F.expr("concat(left(text, length(text) - cast(floor(length(text) / 2) as int)), tail)")
    edited = with_signatures(signed.join(given, ["id", "h"]).withColumn("edited", half), "edited", "other", **options)
    return edited.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"), "next_doc_id",
    )
