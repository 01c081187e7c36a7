"""Mixing sources to target weights by budgets down a domain-language-source tree.

Weights split a token budget among domains, each domain's share among its
languages, and each language's among its sources. A node that holds fewer tokens
than its share gives what it lacks to its siblings, in proportion to their
weights; only what no sibling can take goes up, to the siblings of the parent.
So a shortage is met as near to its place in the tree as possible.

A leaf's documents come in a seeded order of their own for each epoch; the leaf
takes the shortest prefix of this sequence of epochs whose tokens reach its
budget, at most ``epochs`` times all of its documents.

Tokens per leaf are summed in Spark; the tree itself, one row for each leaf, is
solved on the driver (its size is that of the mixture's configuration: domains
times languages times sources; past ``most_leaves`` it raises an error rather
than guess). Prefixes need no sort of a whole leaf: documents are dealt to
slices by the leading digits of their order key, sums per slice tell in which
slice a prefix ends, and only this slice is ordered. The number of slices rises
with the largest leaf, so a slice holds ``per_slice`` documents or so at most.

Tokens are runs of what is not white space of ASCII, not a tokenizer's.

Edge cases. Null domain, language or source: a node of its own. Null or empty
text: 0 tokens, taken with the prefix it stands in. Ties of the order key (a
repeated id): by a hash of the text; rows equal in both are taken together. Domains,
languages and sources of equal weight share alike, in the order of their names.
Missing weights: ``other_weight``. Empty table: no rows.
All input columns are kept; ``epoch``, ``tokens`` and ``leaf_budget`` replace
columns of the same name.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import shipped, written

Path = tuple[str | None, ...]


def words_of(text: Column) -> Column:
    """Tokens of a text: runs of what is not white space of ASCII."""
    filled = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+", " "))
    return F.when(F.length(filled) == 0, F.lit(0)).otherwise(F.length(filled) - F.length(F.replace(filled, F.lit(" "), F.lit(""))) + 1).cast("long")


def share(amount: float, weights: dict, room: dict) -> dict:
    """amount split by weights, no part above its room: parts that are full give
    their excess to the others in proportion, until it is placed or all are full."""
    parts, live = dict.fromkeys(weights, 0.0), {k for k in weights if room[k] > 0}
    left = min(amount, sum(room[k] for k in live))
    while live and left > 1e-9:
        total = sum(weights[k] for k in live)
        scale = {k: (weights[k] / total if total else 1 / len(live)) for k in live}
        full = {k for k in live if room[k] <= parts[k] + left * scale[k]}
        if not full:
            for k in live:
                parts[k] += left * scale[k]
            break
        # Give the full ones what they hold, and deal the rest anew.
        for k in full:
            left -= room[k] - parts[k]
            parts[k] = room[k]
        live -= full
    return parts


def budgets(held: dict[Path, int], weights: dict[Path, float], amount: float, *, epochs: int = 1, other_weight: float = 1.0) -> dict[Path, float]:
    """Token budget of each leaf. held: tokens by leaf path; weights: by path of
    any node, relative to its siblings."""
    room: dict[Path, float] = defaultdict(float)
    children: dict[Path, set[Path]] = defaultdict(set)
    for leaf, tokens in held.items():
        for depth in range(len(leaf) + 1):
            room[leaf[:depth]] += float(tokens) * epochs
            if depth:
                children[leaf[: depth - 1]].add(leaf[:depth])
    out: dict[Path, float] = {}

    def down(node: Path, amount: float) -> None:
        if node in held and node not in children:
            out[node] = amount
            return
        below = sorted(children[node], key=lambda p: tuple((x is None, x or "") for x in p))
        # A share that stays within a child's room is what its subtree can take,
        # so a shortage inside the child goes to the child's own leaves first.
        for child, part in share(amount, {c: weights.get(c, other_weight) for c in below}, {c: room[c] for c in below}).items():
            down(child, part)

    if held:
        down((), amount)
    return out


@shipped
def mix(
    docs: DataFrame,
    *,
    domain: Column,
    weights: dict[Path, float] | None = None,
    fraction: float = 0.5,
    budget: int | None = None,
    epochs: int = 1,
    seed: int = 7,
    other_weight: float = 1.0,
    slices: int = 4096,
    per_slice: int = 20_000,
    most_leaves: int = 200_000,
) -> DataFrame:
    """Rows of docs chosen for the mixture, with epoch (from 0), tokens and
    leaf_budget. budget: in tokens; None: fraction of all tokens of docs."""
    spark = docs.sparkSession
    level = ["l0", "l1", "l2"]

    def keyed(df: DataFrame) -> DataFrame:
        """df's row as one column, with its leaf, tokens, a hash of the text and an
        order key per epoch."""
        name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
        own = {"l0": domain.cast("string"), "l1": F.col("lang").cast("string"), "l2": F.col("source").cast("string"), "tokens": words_of(F.col("text")), "_hash": F.xxhash64("text")}
        own |= {f"_key{e}": F.md5(F.concat(F.lit(f"{seed}:{e}|"), name)) for e in range(epochs)}
        return df.select(F.struct(*df.columns).alias("_row"), *[c.alias(n) for n, c in own.items()])

    keys = [f"_key{e}" for e in range(epochs)]
    slim = written(keyed(docs).select(*level, "tokens", "_hash", *keys), "mixing-keys")
    sums = slim.groupBy(*level).agg(F.sum("tokens").alias("held"), F.count("*").alias("rows")).limit(most_leaves + 1).collect()
    if len(sums) > most_leaves:
        raise ValueError(f"more than {most_leaves} leaves: the mixture's tree is not a configuration")
    held = {tuple(r[c] for c in level): r["held"] for r in sums}
    slices = max(slices, -(-max((r["rows"] for r in sums), default=0) // per_slice))
    amount = fraction * sum(held.values()) if budget is None else budget
    solved = budgets(held, weights or {}, amount, epochs=epochs, other_weight=other_weight)

    # For each leaf and epoch, the order key where its prefix ends.
    leaf = lambda a, b: a["l0"].eqNullSafe(b["l0"]) & a["l1"].eqNullSafe(b["l1"]) & a["l2"].eqNullSafe(b["l2"])
    ends = None
    for e in range(epochs):
        wants = [(*k, float(b), float(min(max(b - e * held[k], 0.0), held[k]))) for k, b in solved.items()]
        wanted = spark.createDataFrame(wants, "l0 string, l1 string, l2 string, leaf_budget double, want double").where("want > 0")
        own = slim.select(*level, "tokens", F.struct(F.col(f"_key{e}").alias("key"), F.col("_hash").alias("hash")).alias("at"))
        own = own.withColumn("slice", (F.conv(F.substring("at.key", 1, 8), 16, 10).cast("long") * slices / (1 << 32)).cast("int"))
        by_slice = own.groupBy(*level, "slice").agg(F.sum("tokens").alias("t"))
        ahead = Window.partitionBy(*level).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        placed = by_slice.withColumn("before", F.coalesce(F.sum("t").over(ahead), F.lit(0)))
        cut = placed.join(F.broadcast(wanted), leaf(placed, wanted)).where((F.col("before") < F.col("want")) & (F.col("before") + F.col("t") >= F.col("want")))
        cut = cut.select(wanted["l0"].alias("c0"), wanted["l1"].alias("c1"), wanted["l2"].alias("c2"), F.col("slice").alias("cs"), "before", "want")
        here = own.join(F.broadcast(cut), F.col("l0").eqNullSafe(F.col("c0")) & F.col("l1").eqNullSafe(F.col("c1")) & F.col("l2").eqNullSafe(F.col("c2")) & (F.col("slice") == F.col("cs")))
        run = Window.partitionBy("l0", "l1", "l2").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        last = here.withColumn("run", F.col("before") + F.coalesce(F.sum("tokens").over(run), F.lit(0))).where("run < want").groupBy(*level).agg(F.max("at").alias("last"))
        of_epoch = wanted.join(last, leaf(wanted, last), "left").select(wanted["l0"], wanted["l1"], wanted["l2"], "leaf_budget", F.lit(e).alias("epoch"), "last")
        ends = of_epoch if ends is None else ends.union(of_epoch)
    ends = written(ends, "mixing-ends").withColumnsRenamed({"l0": "c0", "l1": "c1", "l2": "c2"})

    # One row per leaf and epoch at most, so this side is as small as the tree.
    rows = keyed(docs)
    same = F.col("l0").eqNullSafe(F.col("c0")) & F.col("l1").eqNullSafe(F.col("c1")) & F.col("l2").eqNullSafe(F.col("c2"))
    at = F.struct(F.element_at(F.array(*keys), F.col("epoch") + 1).alias("key"), F.col("_hash").alias("hash"))
    taken = rows.join(F.broadcast(ends), same).where(F.col("last").isNull() | (at <= F.col("last")))
    added = ["tokens", "epoch", "leaf_budget"]
    return taken.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in added], *added)
