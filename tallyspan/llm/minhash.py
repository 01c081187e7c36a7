"""Near-duplicate documents by bottom-k sketches of one hash function.

1. Every document becomes the set of its word shingles (64-bit hashes); the k
   smallest are its sketch. Documents of equal sets are one class from here on.
2. Inverted lists. Two sets of Jaccard similarity t share about t * k retained
   values; fewer than ``need`` (more than six standard deviations below) never
   happens in practice, and sets of at most k shingles are retained whole, so
   that there the bound is exact. By the prefix principle, two sketches that
   share ``need`` values also share one among the (size - need + 1) that come
   first in any common order. The order is by how often a value's bucket occurs
   over all documents, so values of passages that many documents share are
   listed last, and lists stay short.
3. Each list elects a pivot, its most central class. Lists with one pivot are
   joined into a group, so a family of copies, whose values make many equal
   lists, is looked at once.
4. Star: every member of a group meets its pivot, a slice of members with a copy
   of the pivot at a time. The union sketch (the k smallest of both) estimates
   the similarity, and members below ``margin`` drop out; the full sets of the
   rest, made from their whole texts, give the exact links. The work grows with
   the number of members, also in a family of near copies.
5. Components of these links. Members that are not in their pivot's component
   are outsiders of the group, and only pairs of an outsider and a member of
   another component remain. They are looked at in the same two steps, blocks of
   outsiders against blocks of members; no pair of documents is ever a row, and
   a unit emits a spanning forest of its links.
6. Components of all links.

Texts are shuffled once for the star and once for the outsiders: those whose id
a bitmap holds, which spares most texts; all of them, once its size is at its
bound and it is full.

Edge cases. Null text or no words: n_shingles 0, linked with nothing, its own
component. Fewer words than a shingle: the whole sequence is one shingle. Ties of
pivots: the larger id. Repeated texts: one class; repeated ids with different texts: rows of one id
are one node. Null doc_id: kept, component null. No rows: no rows. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import Bitmap, as_bytes, groups, hot_keys, join_unique, shipped, thrifty, written
from tallyspan.llm.components import components

_U = np.uint64
_SKETCHED = "doc_id long, n long, set_hash binary, sketch binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class _Hashes(dict):
    """64-bit hashes of words, kept between documents up to a bound."""

    MOST = 200_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.MOST:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Hashes()


def shingles(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of ``size`` words."""
    tokens = text.lower().split()  # of bytes: A-Z, and white space of ASCII
    if not tokens:
        return np.empty(0, dtype=_U)
    h = np.array(list(map(_HASHES.__getitem__, tokens)), dtype=_U)
    n = max(1, len(h) - size + 1)
    own = np.full(n, min(size, len(h)), dtype=_U)
    for k in range(min(size, len(h))):
        own = _mix(own * _U(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(own)


def least_shared(n: int, k: int, percent: int) -> int:
    """Retained values that partners of a set of n shingles surely share."""
    exact = -(-n * percent // 100)
    if exact * 100 <= k * percent and n * 100 <= k * percent:
        return max(1, exact)
    p = percent / 100
    return max(1, math.floor(k * p - 6 * math.sqrt(k * p * (1 - p))))


def _sketch(size: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, size) for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([s[:k].tobytes() for s in sets], pa.binary()),
                ],
                names=["doc_id", "n", "set_hash", "sketch"],
            )
        _HASHES.clear()

    return run


def _buckets(values: np.ndarray, bits: int) -> np.ndarray:
    # Retained values are small numbers; the low bits are as random as any.
    return (values & _U((1 << bits) - 1)).astype(np.int64)


def _count(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            data = b"".join(x or b"" for x in batch.column("sketch").to_pylist())
            counts += np.bincount(_buckets(np.frombuffer(data, dtype=_U), bits), minlength=1 << bits)
        at = np.flatnonzero(counts)
        for i in range(0, len(at), 100_000):
            own = at[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(counts[own])], names=["bucket", "n"])

    return run


def _prefix(counts, k: int, percent: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = counts.value
        for batch in batches:
            values, ids, central = [], [], []
            for i, n, sketch in zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), batch.column("sketch").to_pylist()):
                own = np.frombuffer(sketch, dtype=_U)
                c = often[_buckets(own, bits)]
                first = np.lexsort((own, c))[: len(own) - least_shared(n, k, percent) + 1]
                values.append(own[first].astype(np.int64))
                ids.append(np.full(len(first), i))
                central.append(np.full(len(first), int(1000 * np.log(c).mean())))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (values, ids, central)], names=["value", "doc_id", "central"])

    return run


def _near(a: np.ndarray, b: np.ndarray, na: int, nb: int, k: int, margin: float) -> bool:
    """Whether the union sketch of two sketches of sets of na and nb values puts
    their similarity at margin or more."""
    union = np.union1d(a, b)
    if max(na, nb) > k:
        union = union[:k]
    both = np.intersect1d(a, b, assume_unique=True)
    return bool((both <= union[-1]).sum() >= margin * len(union))


def _star_mates(k: int, percent: int, margin: float):
    """Of each unit, a pivot and some members, those that come near enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in groups(batches, ["pivot", "slice"]):
            ids, n = unit.column("doc_id").to_pylist(), unit.column("n").to_pylist()
            sketches = [np.frombuffer(x, dtype=_U) for x in unit.column("sketch").to_pylist()]
            pivot = unit.column("pivot")[0].as_py()
            centres = [c for c, i in enumerate(ids) if i == pivot]  # several where texts share an id

            def meets(x: int, c: int) -> bool:
                return 100 * min(n[x], n[c]) >= percent * max(n[x], n[c]) and _near(sketches[x], sketches[c], n[x], n[c], k, margin)  # noqa: B023

            keep = [x for x in range(len(ids)) if ids[x] != pivot and any(meets(x, c) for c in centres)]
            if keep:
                yield from unit.select(["pivot", "slice", "doc_id"]).take(pa.array([centres[0], *keep])).combine_chunks().to_batches()

    return run


def _star_links(size: int, percent: int):
    """The exact links of each unit's pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in groups(batches, ["pivot", "slice"]):
            ids, pivot = unit.column("doc_id").to_pylist(), unit.column("pivot")[0].as_py()
            texts = as_bytes(unit.column("text").combine_chunks())
            own = [shingles(t, size) for i, t in zip(ids, texts) if i == pivot]
            found = []
            for i, t in zip(ids, texts):
                if i != pivot:
                    s = shingles(t, size)
                    for c in own:
                        shared = len(np.intersect1d(s, c, assume_unique=True))
                        if shared and 100 * shared >= percent * (len(s) + len(c) - shared):
                            found.append(i)
                            break
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array([pivot] * len(found), pa.int64())], names=["u", "v"])
        _HASHES.clear()

    return run


_UNIT = "pivot long, i int, j int, outside boolean, doc_id long, label long"


def _outside_mates(k: int, percent: int, margin: float):
    """Of each unit, some outsiders and some members, those that come near enough
    to one of another component on the other side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in groups(batches, ["pivot", "i", "j"]):
            out, label, n = (np.array(unit.column(c).to_pylist()) for c in ("outside", "label", "n"))
            sketches = [np.frombuffer(x, dtype=_U) for x in unit.column("sketch").to_pylist()]
            size = np.array([len(x) for x in sketches])
            starts, at, flat, bounds = _index(sketches)
            near = np.zeros(len(n), dtype=bool)
            for x in np.flatnonzero(out).tolist():
                shared = np.bincount(_partners(starts, at, bounds[x], bounds[x + 1], flat), minlength=len(n))
                some = ~out & (label != label[x]) & (shared >= margin * np.minimum(k, np.maximum(size, size[x])))
                some &= 100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x])
                for y in np.flatnonzero(some).tolist():
                    if not (near[x] and near[y]) and _near(sketches[x], sketches[y], n[x], n[y], k, margin):
                        near[x] = near[y] = True
            keep = np.flatnonzero(near)
            if len(keep):
                yield from unit.select([f.split()[0] for f in _UNIT.split(", ")]).take(pa.array(keep)).combine_chunks().to_batches()

    return run


def _index(sets: list[np.ndarray]):
    """Inverted index of sets: rows of equal values, as runs of one array."""
    flat = np.concatenate(sets) if sets else np.empty(0, _U)
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    _, ids = np.unique(flat, return_inverse=True)
    at = np.repeat(np.arange(len(sets)), np.diff(bounds))[np.argsort(ids, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(ids))]) if len(flat) else np.zeros(1, np.int64)
    return starts, at, ids, bounds


def _partners(starts, at, low: int, high: int, ids) -> np.ndarray:
    """Rows that hold values of one row, once for each value shared."""
    own = ids[low:high]
    many = starts[own + 1] - starts[own]
    begin = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
    return at[begin + np.arange(many.sum())]


def _find(root: list[int], x: int) -> int:
    while root[x] != x:
        root[x] = root[root[x]]
        x = root[x]
    return x


def _outside_links(size: int, percent: int):
    """A spanning forest of each unit's exact links between components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in groups(batches, ["pivot", "i", "j"]):
            ids = unit.column("doc_id").to_pylist()
            out, label = (np.array(unit.column(c).to_pylist()) for c in ("outside", "label"))
            names, node = np.unique(label, return_inverse=True)
            sets = [shingles(t, size) for t in as_bytes(unit.column("text").combine_chunks())]
            n = np.array([len(s) for s in sets])
            starts, at, flat, bounds = _index(sets)
            root, edges = list(range(len(names))), []
            for x in np.flatnonzero(out).tolist():
                shared = np.bincount(_partners(starts, at, bounds[x], bounds[x + 1], flat), minlength=len(ids))
                linked = ~out & (label != label[x]) & (shared > 0) & (100 * shared >= percent * (n + n[x] - shared))
                for y in np.flatnonzero(linked).tolist():
                    a, b = _find(root, int(node[x])), _find(root, int(node[y]))
                    if a != b:
                        root[a] = b
                        edges.append((ids[x], ids[y]))
            if edges:
                u, v = zip(*edges)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
        _HASHES.clear()

    return run


def _by_unit(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, "doc_id")


def _texts(docs: DataFrame, near: DataFrame, bits: int | None) -> DataFrame:
    """(doc_id, text) of the ids in near, each different text of an id once. All
    steps after the bitmap share one shuffle of the texts."""
    likely = Bitmap(near.select("doc_id").distinct(), "doc_id", bits).split(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), True)
    wanted = likely.repartition("doc_id").join(near.select("doc_id").distinct(), "doc_id", "left_semi")
    return wanted.withColumn("set", F.xxhash64("text")).dropDuplicates(["doc_id", "set"]).drop("set")


@shipped
def near_duplicates(
    docs: DataFrame,
    *,
    words: int = 5,
    percent: int = 80,
    k: int = 64,
    margin: float = 0.5,
    bits: int = 18,
    block: int = 256,
    wide_block: int = 256,
    bitmap_bits: int | None = None,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id,
    text): documents whose shingle sets have a Jaccard similarity of at least
    percent / 100 are linked, and components of links share the smallest id."""
    spark = docs.sparkSession
    sketched = written(docs.select("doc_id", "text").mapInArrow(thrifty(_sketch(words, k)), _SKETCHED), "minhash-sketches")
    known = sketched.where("n > 0 and doc_id is not null")
    classes = written(known.groupBy("set_hash").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows")), "minhash-classes")
    heads = written(known.join(classes, ["set_hash", "doc_id"], "left_semi").dropDuplicates(["doc_id", "set_hash"]).select("doc_id", "n", "sketch"), "minhash-heads")

    often = np.ones(1 << bits, dtype=np.int64)
    sums = sketched.select("sketch").mapInArrow(thrifty(_count(bits)), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    often[sums.column("bucket").to_numpy()] += sums.column("n").to_numpy()
    counts = spark.sparkContext.broadcast(often)

    listed = heads.mapInArrow(thrifty(_prefix(counts, k, percent, bits)), "value long, doc_id long, central long")
    lists = listed.groupBy("value").agg(F.count("*").alias("size"), F.max(F.struct("central", F.col("doc_id").alias("pivot"))).alias("p"))
    pivots = written(lists.where("size > 1").select("value", "size", "p.pivot"), "minhash-pivots")
    hot = hot_keys(pivots, "value", "size", pivots.agg(F.sum("size")).first()[0] or 0)
    grouped = written(join_unique(listed, pivots.select("value", "pivot"), "value", hot).select("pivot", "doc_id").distinct(), "minhash-groups")

    # Star: members, a slice at a time, against their pivot.
    sizes = written(grouped.groupBy("pivot").agg(F.count("*").alias("size")), "minhash-sizes")
    hot = hot_keys(sizes, "pivot", "size", grouped.count())
    slices = F.ceil(F.col("size") / block).cast("int")
    members = join_unique(grouped, sizes, "pivot", hot).where("doc_id != pivot").select("pivot", F.pmod(F.xxhash64("doc_id"), slices).cast("int").alias("slice"), "doc_id")
    centres = sizes.select("pivot", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"), F.col("pivot").alias("doc_id"))
    units = members.union(centres).join(heads, "doc_id").select("pivot", "slice", "doc_id", "n", "sketch")
    near = written(_by_unit(units, "pivot", "slice").mapInArrow(thrifty(_star_mates(k, percent, margin)), "pivot long, slice int, doc_id long"), "minhash-near")
    star = _by_unit(near.join(_texts(docs, near, bitmap_bits), "doc_id"), "pivot", "slice").mapInArrow(thrifty(_star_links(words, percent)), "u long, v long")
    star = written(star, "minhash-star")

    # Outsiders against the members of other components.
    linked = components(star).withColumnsRenamed({"id": "doc_id", "component": "label"})
    labelled = grouped.join(linked, "doc_id", "left").select("pivot", "doc_id", F.coalesce("label", "doc_id").alias("label"))
    labelled = written(labelled, "minhash-labels")
    centre = labelled.where("doc_id = pivot").select("pivot", F.col("label").alias("own"))
    told = join_unique(labelled, centre, "pivot", hot).where("doc_id != pivot").withColumn("outside", F.col("label") != F.col("own")).drop("own")
    left = told.groupBy("pivot").agg(F.count("*").alias("size"), F.count_if("outside").alias("out")).where("out > 0 and size > 1")
    wide = lambda n: F.ceil(F.col(n) / wide_block).cast("int")
    left = written(left.select("pivot", wide("size").alias("across"), wide("out").alias("down")), "minhash-left")
    told = join_unique(told, left, "pivot", hot)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    outsiders = told.where("outside").select("pivot", own("down").alias("i"), every("across").alias("j"), F.lit(True).alias("outside"), "doc_id", "label")
    others = told.select("pivot", every("down").alias("i"), own("across").alias("j"), F.lit(False), "doc_id", "label")
    units = outsiders.union(others).join(heads, "doc_id").select("pivot", "i", "j", "outside", "doc_id", "label", "n", "sketch")
    near = written(_by_unit(units, "pivot", "i", "j").mapInArrow(thrifty(_outside_mates(k, percent, margin)), _UNIT), "minhash-outside")
    edges = star
    if near.limit(1).count():
        met = near.join(_texts(docs, near, bitmap_bits), "doc_id")
        edges = star.union(_by_unit(met, "pivot", "i", "j").mapInArrow(thrifty(_outside_links(words, percent)), "u long, v long"))

    # A class takes its smallest id, its component the smallest id of a class.
    linked = components(edges)
    of_class = classes.join(linked, classes["doc_id"] == linked["id"], "left").select("set_hash", F.coalesce("component", "doc_id").alias("component"))
    hot = hot_keys(classes, "set_hash", "rows", known.count())
    out = join_unique(sketched.select("doc_id", "n", "set_hash"), of_class, "set_hash", hot, "left")
    component = F.coalesce(F.when(F.col("n") > 0, F.col("component")), "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
