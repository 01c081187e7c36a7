"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents' tokens, cut into quanta of ``length //
runs`` tokens. In every round, a window of ``runs`` quanta, a queue earns its
target share of the window as credit, spends whole quanta in one run, and carries
the rest, its deficit, to the next round. So a window holds long runs of few
documents, and over the rounds each queue keeps to its share: it is never further
from it than one quantum for each level of the tree below.

Summed over the rounds, what a queue has spent after h quanta is a function of h
alone. Shares are split down a binary tree of queues, where the left child of a
node that has spent h of its n quanta has spent floor(h * n_left / n). So any
task can tell the place of any token without the others: deficits carry over
windows and partitions alike, no row waits for another, and every sequence but
the last is full. A queue's last quantum may be short of tokens; what follows
moves up, and sequences cut the rounds where they come to lie.

When targets differ from what the queues hold, the run falls into phases: one
ends when a targeted queue is empty, and the rest share what it no longer takes.
Towards the end, where few queues are left, windows are of these alone. Targets
are brought to whole rates, each within 0.5 % of its weight, and queues end at
ticks of these rates. Sums over queues then give the place of any quantum, so what
the driver and each task hold is a few numbers for each source, of 64 bits at up
to 2^50 quanta (2.8 * 10^17 tokens in quanta of 256).

Stage 1 tokenizes each document once and writes its ids (two bytes each) with
its place within (partition, source). Stage 2 adds the sums of earlier
partitions, a table of one row per partition and source, and cuts the pieces.

Edge cases. Null or empty text: a document of its end id alone. Null source: a
queue of its own. Repeated rows or ids: each row is packed. No rows: no pieces.
Long texts: cut over as many windows as needed. Ties of sources in tokens: by
name. Targets of sources that do not occur, or are not above zero, say nothing.
Other columns are ignored.
"""

from __future__ import annotations

import json
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import shipped, thrifty, written

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
_STAGED = "doc_id long, source string, part int, qkey string, local long, n long, ids binary"
_TOKENIZERS: dict[str, object] = {}


class Encoder:
    """Ids of texts as the tokenizer of a file gives them without special tokens
    put round the text. Strings of the file's added tokens stand for their ids,
    as that tokenizer has it; texts that hold one go to it, all others to a
    faster encoder of the same vocabulary where there is one."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        if not path.endswith(".json"):
            raise ValueError(f"a tokenizer .json file is needed, not {path}")
        self.plain = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = _byte_level_twin(spec, self.plain)
        self.kind = np.dtype("<u2") if self.plain.get_vocab_size() <= 65536 else np.dtype("<u4")

    def encode(self, text: str) -> bytes:
        if self.fast is None or any(x in text for x in self.added):
            ids = self.plain.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast(text)
        if sys.byteorder == "little":
            return array("H" if self.kind.itemsize == 2 else "I", ids).tobytes()
        return np.array(ids, dtype=self.kind).tobytes()


def _byte_level_twin(spec: dict, tok) -> Callable[[str], list[int]] | None:
    """tiktoken's encoder over the ranks of a byte-level BPE file, several times
    as fast for the same ids; None where the file is of another kind."""
    import tiktoken

    pre = spec.get("pre_tokenizer") or {}
    if spec["model"].get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        return None
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(kept)]
    byte_of = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    vocab = spec["model"]["vocab"]
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    encode = tiktoken.Encoding("twin", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary
    probe = "It's 12 new-ish wörds,\n  and\ttabs  x 中文! "
    return encode if encode(probe) == tok.encode(probe, add_special_tokens=False).ids else None


def tokenizer(name: str) -> Encoder:
    """The encoder of this worker, kept between tasks."""
    if name not in _TOKENIZERS:
        import public_tokenizers

        _TOKENIZERS[name] = Encoder(public_tokenizers.path(name) if "/" not in name else name)
    return _TOKENIZERS[name]


def _tokenize(name: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part, seen = tokenizer(name), TaskContext.get().partitionId(), {}
        end = np.asarray([end_id], dtype=tok.kind).tobytes()
        for batch in batches:
            ids = [tok.encode(t or "") + end for t in batch.column("text").to_pylist()]
            source, local = batch.column("source").to_pylist(), []
            qkey = ["n" if s is None else "s" + s for s in source]
            for q, x in zip(qkey, ids):
                local.append(seen.get(q, 0))
                seen[q] = local[-1] + len(x) // tok.kind.itemsize
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(source, pa.string()),
                    pa.array([part] * len(ids), pa.int32()),
                    pa.array(qkey, pa.string()),
                    pa.array(local, pa.int64()),
                    pa.array([len(x) // tok.kind.itemsize for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "source", "part", "qkey", "local", "n", "ids"],
            )

    return run


#: Quanta that one run can hold: below it, floors of products over sums are exact.
MOST_QUANTA = 1 << 50


def whole_rates(weights: np.ndarray) -> np.ndarray:
    """Integers in the proportion of the weights, each within 0.5 %: the smallest
    of a hundred scales that has it. A weight above zero has at least 1; those below
    2^-40 of all weights together count as much as that."""
    some = weights[weights > 0]
    if not len(some):
        return np.zeros(len(weights), dtype=np.int64)
    most = (1 << 40) / some.sum()
    for times in range(1, 101):
        exact = weights * min(times / some.min(), most)
        whole = np.where(weights > 0, np.maximum(1, np.rint(exact)), 0)
        if (abs(whole - exact) <= 0.005 * exact).all():
            break
    return whole.astype(np.int64)


def floor_share(x: np.ndarray, part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """floor(x * part / whole) for 0 <= x, part <= whole < 2^50. The quotient of
    floating point is off by one at most, and its remainder, taken modulo 2^64, says
    by how much."""
    q = (x.astype(np.float64) * part / whole).astype(np.int64)
    return q + (x * part - q * whole) // whole


class Credit:
    """What each queue has spent after h quanta; see the module's text.

    A targeted queue spends its rate, a whole number, at every tick until it ends;
    the last tick may find less. So queues are placed by the tick at which they end,
    untargeted ones last, and what the queues of any run of places take between two
    ticks follows from sums over places of totals and of rates. These sums, and a
    few numbers for each tick at which queues end, are all that is kept: memory and
    time are linear in queues."""

    def __init__(self, totals: list[int], weights: list[float] | None = None) -> None:
        self.total, self.queues = sum(totals), len(totals)
        if self.total >= MOST_QUANTA or self.total * (self.queues + 1) >= 1 << 63:
            raise ValueError(f"{self.total} quanta of {self.queues} queues: pack them in parts, or with longer quanta")
        size = np.array(totals, dtype=np.int64)
        rate = whole_rates(np.array([0.0] * len(totals) if weights is None else weights, dtype=np.float64))
        ends = np.maximum(1, -(-size // np.maximum(rate, 1))) * (rate > 0)
        ends = np.where(rate > 0, ends, ends.max(initial=0) + 1)
        order = np.argsort(ends, kind="stable")
        self.place = np.empty(len(order), dtype=np.int64)
        self.place[order] = np.arange(len(order))
        sums = lambda x: np.concatenate([np.zeros(1, np.int64), np.cumsum(x[order])])
        self.sizes, self.rates = sums(size), sums(rate)
        self.until, self.low = np.unique(ends[order], return_index=True) if totals else (np.ones(1, np.int64), np.zeros(1, np.int64))
        self.high = np.append(self.low[1:], len(order))
        self.since = np.append(0, self.until[:-1])
        self.begins = self._before(np.arange(len(self.low)), np.full(len(self.low), self.queues))
        self.takes = self._taken(np.arange(len(self.low)), np.full(len(self.low), self.queues))

    def _before(self, phase: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Quanta that the queues of the first ``at`` places have spent before a phase."""
        low = self.low[phase]
        return self.sizes[np.minimum(at, low)] + self.since[phase] * (self.rates[np.maximum(at, low)] - self.rates[low])

    def _taken(self, phase: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Quanta that the queues of the first ``at`` places take in a phase."""
        low, high, since = self.low[phase], self.high[phase], self.since[phase]
        end = np.minimum(np.maximum(at, low), high)
        ending = self.sizes[end] - self.sizes[low] - since * (self.rates[end] - self.rates[low])
        return ending + (self.until[phase] - since) * (self.rates[np.maximum(at, high)] - self.rates[high])

    def spent(self, queue: int | np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(quanta of the queue, quanta of the queues placed before it) among the first h."""
        h = np.asarray(h, dtype=np.int64)
        if not self.queues:
            return h * 0, h * 0
        at = self.place[np.broadcast_to(queue, h.shape)]
        phase = np.searchsorted(self.begins, h, "right") - 1
        x, ahead = np.minimum(h - self.begins[phase], self.takes[phase]), self._before(phase, at)
        own = self._before(phase, at + 1) - ahead
        lo, hi = np.zeros(h.shape, np.int64), np.full(h.shape, self.queues)
        below, above = np.zeros(h.shape, np.int64), self.takes[phase]
        while (hi - lo > 1).any():
            mid = np.where(hi - lo > 1, (lo + hi) // 2, hi)
            middle = self._taken(phase, mid)
            y = floor_share(x, middle - below, np.maximum(above - below, 1))
            left = at < mid
            ahead, x = np.where(left, ahead, ahead + y), np.where(left, y, x - y)
            lo, hi = np.where(left, lo, mid), np.where(left, mid, hi)
            below, above = np.where(left, below, middle), np.where(left, middle, above)
        return own + x, ahead

    def window(self, queue: int | np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        """The round of ``length`` quanta that holds the queue's quantum at a position."""
        at = np.asarray(at, dtype=np.int64)
        lo = at * 0
        hi = at * 0 + (self.total - 1) // length
        while (lo < hi).any():
            mid = (lo + hi) // 2
            over = self.spent(queue, (mid + 1) * length)[0] > at
            hi, lo = np.where(over, mid, hi), np.where(over, lo, mid + 1)
        return lo


class Layout:
    """Places of the queues' tokens in the stream of all tokens."""

    def __init__(self, tokens: list[int], weights: list[float] | None, length: int, runs: int) -> None:
        self.length, self.runs, self.quantum = length, min(runs, length), max(1, length // runs)
        self.tokens = tokens
        units = [-(-n // self.quantum) for n in tokens]
        self.credit = Credit(units, weights)
        # Rounds in which queues end on a quantum that is short, and by how much.
        short = np.array([i for i, n in enumerate(tokens) if n % self.quantum], dtype=np.int64)
        ends = self.credit.window(short, np.array([units[i] - 1 for i in short], dtype=np.int64), self.runs)
        keys = ends * (len(tokens) + 1) + self.credit.place[short]
        order = np.argsort(keys)
        self.lacks_at = keys[order]
        self.lacks = np.append(0, np.cumsum([self.quantum - tokens[q] % self.quantum for q in short[order]], dtype=np.int64))

    def pieces(self, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, first token, end, place in the stream) of the pieces of documents
        that lie at ``first`` in their queues, in order, cut at ends of sequences."""
        q, runs, credit = self.quantum, self.runs, self.credit
        q0, q1 = first // q, (first + n - 1) // q
        r0, r1 = credit.window(queue, q0, runs), credit.window(queue, q1, runs)
        # The rounds in which a document may lie: those from its first to its last,
        # or, where its queue comes up more rarely, those of its quanta.
        rare = r1 - r0 > q1 - q0
        many = np.where(rare, q1 - q0, r1 - r0) + 1
        row = np.repeat(np.arange(len(n)), many)
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        rnd, seldom = r0[row] + step, np.flatnonzero(rare[row])
        rnd[seldom] = credit.window(queue[row[seldom]], q0[row[seldom]] + step[seldom], runs)
        fresh = np.ones(len(row), dtype=bool)
        fresh[1:] = (row[1:] != row[:-1]) | (rnd[1:] != rnd[:-1])
        row, rnd = row[fresh], rnd[fresh]
        own0, before0 = credit.spent(queue[row], rnd * runs)
        own1, before1 = credit.spent(queue[row], np.minimum((rnd + 1) * runs, credit.total))
        low, high = np.maximum(first[row], own0 * q), np.minimum(first[row] + n[row], own1 * q)
        lacking = self.lacks[np.searchsorted(self.lacks_at, rnd * (len(self.tokens) + 1) + credit.place[queue[row]])]
        place = (rnd * runs + before1 - before0 - own0) * q - lacking + low
        some = high > low
        row, low, high, place = row[some], low[some], high[some], place[some]
        # Runs of one document that follow each other are one.
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (place[1:] != (place + high - low)[:-1])
        begin = np.flatnonzero(new)
        row, low, place, high = row[begin], low[begin], place[begin], high[np.append(begin[1:], len(new)) - 1] if len(begin) else high
        s0 = place // self.length
        many = ((place + high - low - 1) // self.length - s0 + 1).astype(np.int64)
        of = np.repeat(np.arange(len(row)), many)
        seq = s0[of] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        start = np.maximum(place[of], seq * self.length)
        end = np.minimum((place + high - low)[of], (seq + 1) * self.length)
        shift = (low - place - first[row])[of]
        return tuple(np.asarray(x, dtype=np.int64) for x in (row[of], start + shift, end + shift, seq, start - seq * self.length))


def _cut(layout: Layout, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            queue, first, n = (np.asarray(batch.column(c).to_pylist(), dtype=k) for c, k in (("queue", np.int64), ("first", np.int64), ("n", np.int64)))
            row, low, high, seq, off = layout.pieces(queue, first, n)
            ids, crc, last, data = batch.column("ids"), [], -1, b""
            for i, a, b in zip(row.tolist(), low.tolist(), high.tolist()):
                if i != last:
                    data, last = np.frombuffer(ids[i].as_py(), dtype=kind).astype("<u4").tobytes(), i
                crc.append(zlib.crc32(memoryview(data)[4 * a : 4 * b]))
            take = pa.array(row)
            for i in range(0, len(row), 20_000):
                s = slice(i, i + 20_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(take[s]),
                        pa.array(low[s]),
                        pa.array((high - low)[s]),
                        pa.array(crc[s], pa.int64()),
                        pa.array(n[row[s]]),
                        pa.array(seq[s]),
                        pa.array(off[s]),
                        batch.column("source").take(take[s]),
                    ],
                    names=[x.split()[0] for x in PIECES.split(", ")],
                )

    return run


@shipped
def pack(
    docs: DataFrame,
    *,
    length: int = 2048,
    runs: int = 8,
    targets: dict[str, float] | Callable[[str], float] | None = None,
    tokenizer_name: str = "byte_bpe_50k.json",
    end_id: int = 1,
    most_queues: int | None = None,
) -> DataFrame:
    """Pieces of docs (doc_id, text, source) in sequences of ``length`` tokens.

    targets: weight by source, or a function that gives it; sources without one
    weigh nothing until the targeted are used up. None: the sources' own shares,
    so that all queues end together and every window is a sample of the whole.
    Every source has a queue of its own; the driver and the tasks keep some
    numbers for each source. Where ``most_queues`` is
    given, all sources but the targeted and the ``most_queues`` - 1 largest share
    the last queue; no row is left out.
    """
    staged = written(
        docs.select("doc_id", "text", F.col("source").cast("string").alias("source")).mapInArrow(thrifty(_tokenize(tokenizer_name, end_id)), _STAGED), "packing-ids"
    )
    sums = written(staged.groupBy("part", "qkey").agg(F.sum("n").alias("tokens")), "packing-sums")
    own = [(r["qkey"], r["tokens"]) for r in sums.groupBy("qkey").agg(F.sum("tokens").alias("tokens")).orderBy(F.desc("tokens"), "qkey").collect()]
    weigh = targets if callable(targets) else (targets or {}).get
    aim = {q: w for q, _ in own if targets is not None and q[0] == "s" and (w := weigh(q[1:]) or 0.0) > 0}
    rest = []
    if most_queues is not None:
        rest = [x for x in own[most_queues - 1 :] if x[0] not in aim]
        own = own[: most_queues - 1] + [x for x in own[most_queues - 1 :] if x[0] in aim]
    weights = None if targets is None else [aim.get(q, 0.0) for q, _ in own] + [0.0] * bool(rest)
    layout = Layout([n for _, n in own] + [sum(n for _, n in rest)] * bool(rest), weights, length, runs)
    numbers = [(q, i) for i, (q, _) in enumerate(own)] + [(q, len(own)) for q, _ in rest]
    queued = sums.join(docs.sparkSession.createDataFrame(numbers, "qkey string, queue int"), "qkey")
    before = Window.partitionBy("queue").orderBy("part", "qkey").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(queued.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))).select("part", "qkey", "queue", "base"), "packing-offsets")
    placed = staged.join(offsets, ["part", "qkey"]).withColumn("first", F.col("base") + F.col("local"))
    kind = "<u2" if tokenizer(tokenizer_name).kind.itemsize == 2 else "<u4"
    return placed.select("doc_id", "source", "queue", "first", "n", "ids").mapInArrow(thrifty(_cut(layout, kind)), PIECES)
