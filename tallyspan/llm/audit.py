"""What each filter of a chain removes, and what it would have removed elsewhere.

A document's failures are a mask of one bit for each filter; nothing else matters
for any order of the filters. So one pass over the documents yields, for each part
of the corpus, a histogram of the 2**k masks of all documents, of the good ones and
of the toxic ones. These histograms, stacked as rows, are multiplied by fixed
integer matrices of 2**k rows and k! * k columns (32 by 600 for five filters): the
incidence of a mask in an order's step, for documents that are kept after the step,
removed by it, redundant for it (fail it, but are gone), and unique to it.

``interactions`` takes any rows with a mask. ``document_failures`` makes masks of
five filters over whole texts. Four of them are a matter of the text alone; the
fifth, a copy of a document of smaller id, is found without joining texts: rows are
counted by the text's digest first, so a text that a third of all rows share is one
row of each task when tasks meet, and the least id of a digest tells how many of its
rows are copies.

Edge cases. Null or empty text: no words, fails only the filter of few words (and
that of copies). Null id: no copy, and nobody's original. Rows of one id and text:
none is a copy of the other. Null part: the empty string's. Several labels of an id:
good or toxic if one of them says so; null labels and null ids say nothing. No rows:
no parts. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import hot_keys, join_unique, shipped, thrifty, written

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
LETTERS = "ABCDEFGHIJ"
_SPACE = r"[\x20\x09-\x0D]+"


def outcome_matrices(k: int) -> dict[str, np.ndarray]:
    """For each outcome, whether a mask (row) has it in an order's step (column);
    orders as permutations come, k steps each. ``shapley`` counts, for the filter
    of that step, the orders in which a mask is removed by it."""
    masks = np.arange(1 << k)[:, None]
    orders = np.array(list(permutations(range(k))), np.int64).reshape(-1, k)
    bit = 1 << orders
    passed = np.cumsum(bit, axis=1)  # the filters up to each step, as a mask
    own, upto, before = bit.ravel(), passed.ravel(), (passed - bit).ravel()
    fails, gone = masks & own != 0, masks & before != 0
    removed = (fails & ~gone).astype(np.int64)
    by_filter = np.stack([removed[:, orders.ravel() == f].sum(axis=1) for f in range(k)], axis=1)
    return {
        "kept": (masks & upto == 0).astype(np.int64),
        "removed": removed,
        "redundant": (fails & gone).astype(np.int64),
        "unique_fails": (masks == own).astype(np.int64),
        "shapley": by_filter[:, orders.ravel()],
    }


@shipped
def interactions(rows: DataFrame, k: int = 5) -> DataFrame:
    """rows (part, mask, good, toxic: whether; n: how many such rows) to one row
    for each part, order and step."""
    if not 1 <= k <= 8:
        raise ValueError("one to eight filters")
    n = F.col("n")
    masks = rows.groupBy(F.coalesce("part", F.lit("")).alias("part"), "mask").agg(F.sum(n).alias("all"), F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"))
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "all", "good", "toxic")).alias("h"))
    orders = ["".join(LETTERS[i] for i in p) for p in permutations(range(k))]
    steps = factorial(k) * k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = outcome_matrices(k)
        order, step = pa.array(np.repeat(orders, k)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), factorial(k)))
        for batch in batches:
            # Parts stack as rows, some at a time: results are k! * k times as long.
            for start in range(0, batch.num_rows, 16):
                some = batch.slice(start, 16)
                h = np.zeros((3, some.num_rows, 1 << k), np.int64)
                for i, cells in enumerate(some.column("h").to_pylist()):
                    for c in cells:
                        h[:, i, c["mask"]] = c["all"], c["good"], c["toxic"]
                every, good, toxic = h
                got = {name: every @ m[name] for name in ("kept", "removed", "redundant", "unique_fails", "shapley")}
                got |= {"good_lost": good @ m["removed"], "toxic_lost": toxic @ m["removed"]}
                for i, part in enumerate(some.column("part").to_pylist()):
                    columns = [pa.array([part] * steps, pa.string()), order, step, *(pa.array(got[c][i]) for c in COUNTS)]
                    yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *COUNTS])

    return parts.mapInArrow(thrifty(run), "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


def text_mask(text, few: int = 200, distinct_percent: int = 50, capital_percent: int = 3, signs: str = "[#$%&*|]"):
    """Bits 0 to 3: few words, few different words, many capitals, odd signs."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    n, different = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [n < few, 100 * different < distinct_percent * n, 100 * capitals > capital_percent * F.length(text), text.rlike(signs)]
    return sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(fails)), F.lit(0))


@shipped
def document_failures(docs: DataFrame, labels: DataFrame, *, part: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, n) of whole texts; bit 4 is a copy of a smaller id."""
    own = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(part, F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = own.select("id", "part", F.sha2("text", 256).alias("digest"), text_mask(F.col("text")).alias("mask"))
    # Repeated rows become one with their number, before anything is joined.
    rows = written(rows.groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n")), "audit-rows")
    says = lambda c: F.max(F.coalesce(F.col(c).cast("int") == 1, F.lit(False)))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    hot = hot_keys(rows.groupBy("id").agg(F.count("*").alias("k")).where("k > 1"), "id", "k", rows.count())
    labelled = join_unique(rows.where("id is not null"), known, "id", hot, "left").unionByName(rows.where("id is null"), allowMissingColumns=True)
    labelled = labelled.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # Of a cell: all rows, those without an id, and those of the least id.
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first")
    cells = labelled.groupBy("digest", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("without"), first)
    cells = written(cells, "audit-cells")
    least = cells.groupBy("digest").agg(F.min("first.id").alias("least"))
    met = cells.join(least, "digest")
    originals = F.col("without") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    kinds = F.explode(F.array(F.struct(F.col("mask"), originals.alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - originals).alias("n"))))
    return met.select("part", "good", "toxic", kinds.alias("x")).select("part", "x.mask", "good", "toxic", "x.n").where("n > 0")
