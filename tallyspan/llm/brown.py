"""Class-based bigram language model with Brown classes.

P(text) is the product over tokens of P(class | class before) * P(word | class);
the end token is a token, and its class stands before the first word.

1. Word counts of the training texts, over all of them.
2. The ``head`` most frequent words are clustered: all words above a count that
   rises with the data. Their counts of neighbours, also of END and of forms,
   come from all training texts and stay in Spark, dealt by word.
3. Exchange clustering: the ``core`` most frequent words are dealt to
   ``classes`` classes, and each in turn moves to the class that raises the
   likelihood of the class bigrams most, which gives the start. Then the next
   ``middle`` words join, and then ``sweeps`` sweeps move every word of the head,
   by its own counts of classes after and before it. Sweeps stop where one has
   raised the likelihood by less than ``least_gain`` of what it was.
4. All rarer and unknown words have classes of their form (length, punctuation,
   non-ASCII), so that a class is known wherever a word is seen.
5. Transitions are smoothed by the frequency of classes. Emissions use absolute
   discounting: a known word has (count - D) / class tokens. What the D of the
   known words leave of each class, be it exchanged or of a form, belongs to the
   unknown word, whatever class that would have: its probability is the sum over
   all classes of P(class | class before) times the part left of it, shared among
   forms like the different words of training. So the probabilities of known words
   and unknown forms add up to one after any class, at every size, and a class
   after an unknown word is that after its form.

Scoring: counts of the ``head`` most frequent words (a bound on what is
broadcast) are looked up where the text is; rarer words of each text are joined
with their counts in Spark, so any vocabulary fits. ``score`` is the log10
probability of the text, ``perplexity`` the inverse of its geometric mean for a
token.

Ties: of words with equal counts the first by its bytes is the more frequent; of
classes with equal gain the word stays, or goes to the first.

Edge cases. Null or empty text: the end token alone. Null doc_id: held out.
Repeated rows: each is scored, and each counts in training. No training rows:
every word is unknown. Long texts: whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import give_back, shipped, written

#: No token is empty, so this can stand for the end token.
END = b""
FORMS = 16
#: Rows of neighbour counts go by groups of words, moves by units of groups.
GROUPS, UNITS = 4096, 16


def tokenized(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(tokens, n) of texts: the words of all of them in order, and how many each
    text has."""
    low = pc.ascii_trim_whitespace(pc.ascii_lower(texts.fill_null("")))
    lists = pc.ascii_split_whitespace(low)  # white space of ASCII; an empty text gives one empty word
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    n[pc.equal(low, "").to_numpy(zero_copy_only=False)] = 0
    flat = lists.flatten()
    return (flat.filter(pc.not_equal(flat, "")) if len(flat) > n.sum() else flat), n


def numbered(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, ids, n): the different tokens of texts, END the last of them; the
    tokens of all texts in order, each text's END included, as places in words;
    how many tokens each text has, END included."""
    flat, n = tokenized(texts)
    coded = flat.dictionary_encode()
    words = pa.concat_arrays([coded.dictionary, pa.array([END.decode()], coded.dictionary.type)])
    return words, np.insert(coded.indices.to_numpy().astype(np.int64), np.cumsum(n), len(words) - 1), n + 1


def gathered(batches: Iterator[pa.RecordBatch], most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Rows of several batches as one, up to some bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def forms(words: pa.Array) -> np.ndarray:
    """Numbers of words' forms, by length, letters only, and ASCII only."""
    n, letters, plain = (f(words).to_numpy(zero_copy_only=False) for f in (pc.binary_length, pc.ascii_is_alpha, pc.string_is_ascii))
    return (n > 3).astype(np.int64) + (n > 6) + (n > 10) + 4 * (~letters & plain) + 8 * ~plain


def form(word: bytes) -> int:
    return int(forms(pa.array([word.decode()]))[0])


@dataclass
class Model:
    words: pa.Array  # head words by number
    counts: np.ndarray
    classes: np.ndarray  # of head words; END has class n_classes
    n_classes: int = 0
    total: int = 0
    distinct: int = 0
    class_tokens: np.ndarray = field(default_factory=lambda: np.zeros(0))
    class_words: np.ndarray = field(default_factory=lambda: np.zeros(0))
    steps: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    form_words: np.ndarray = field(default_factory=lambda: np.zeros(FORMS))  # different words by form

    @property
    def head(self) -> dict[bytes, int]:
        return {w.encode(): i for i, w in enumerate(self.words.to_pylist())}

    @property
    def all_classes(self) -> int:
        """Exchanged classes, the end's, and those of forms."""
        return self.n_classes + 1 + FORMS

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Number of a head word; others -1 - form."""
        found = pc.fill_null(pc.index_in(words, value_set=self.words.cast(words.type)), -1).to_numpy().astype(np.int64)
        rare = np.flatnonzero(found < 0)
        found[rare] = -1 - forms(words.take(pa.array(rare)))
        return found

    def transitions(self, smooth: float) -> np.ndarray:
        """P(class | class before), smoothed by P(class)."""
        weight = smooth * self.all_classes
        usual = (self.steps.sum(0) + smooth) / (self.steps.sum() + weight)
        return (self.steps + weight * usual) / (self.steps.sum(1, keepdims=True) + weight)

    def unknown(self, smooth: float, discount: float) -> tuple[np.ndarray, np.ndarray]:
        """(P(unknown | class before), P(form | unknown))."""
        left = np.where(self.class_tokens > 0, discount * self.class_words / np.maximum(self.class_tokens, 1.0), 1.0)
        return self.transitions(smooth) @ left, (self.form_words + smooth) / (self.form_words.sum() + smooth * FORMS)

    def class_of(self, numbers: np.ndarray) -> np.ndarray:
        if not len(self.classes):
            return self.n_classes - numbers
        return np.where(numbers >= 0, self.classes[np.maximum(numbers, 0)], self.n_classes - numbers)


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int, sweeps: int = 6) -> np.ndarray:
    """Classes of words by exchange on a square matrix of bigram counts, rows in
    descending order of frequency."""
    k = len(bigrams)
    n = bigrams.astype(np.float64)
    of = np.arange(k) % classes
    z = np.eye(classes)[of]
    after, before = n @ z, n.T @ z  # counts of each word with each class
    m = z.T @ after
    for _ in range(sweeps):
        moved = 0
        for w in range(k):
            a, self_ = of[w], n[w, w]
            r, c = after[w].copy(), before[w].copy()
            r[a] -= self_
            c[a] -= self_
            m[a] -= r
            m[:, a] -= c
            m[a, a] -= self_
            rows, cols = m.sum(1) + c, m.sum(0) + r
            gain = (_h(m + r[None, :]) - _h(m)).sum(1) + (_h(m.T + c[None, :]) - _h(m.T)).sum(1)
            d = m.diagonal()
            gain += _h(d + r + c + self_) - _h(d + r) - _h(d + c) + _h(d)
            sr, sc = r.sum() + self_, c.sum() + self_
            gain -= _h(rows + sr) - _h(rows) + _h(cols + sc) - _h(cols)
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            m[b] += r
            m[:, b] += c
            m[b, b] += self_
            if b != a:
                moved += 1
                of[w] = b
                after[:, a] -= n[:, w]
                after[:, b] += n[:, w]
                before[:, a] -= n[w]
                before[:, b] += n[w]
        if not moved:
            break
    return of


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def out():
        counts = pa.chunked_array(held).value_counts()
        for i in range(0, len(counts), 50_000):
            part = counts.slice(i, 50_000)
            yield pa.RecordBatch.from_arrays([part.field(0).cast(pa.binary()), part.field(1)], names=["word", "c"])

    for batch in batches:
        flat, n = tokenized(batch.column("text"))
        held += [flat, pa.array([END.decode()], flat.type).take(pa.array(np.zeros(len(n), np.int64)))]
        size += len(flat)
        if size > 2_000_000:
            yield from out()
            held, size = [], 0
    if held:
        yield from out()


def _cells(array: np.ndarray) -> Iterator[pa.RecordBatch]:
    flat = array.ravel()
    at = np.flatnonzero(flat)
    for i in range(0, len(at), 100_000):
        own = at[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(flat[own].astype(np.int64))], names=["cell", "n"])


def _pairs(docs: DataFrame, model: Model) -> DataFrame:
    """Counts of neighbours (grp, own, other, n) of all nodes, head words and
    forms. A row holds those of the words of one group (node % GROUPS) from a
    run of texts, as three arrays of four-byte numbers: other is the node after
    own, or the number of nodes plus the node before own."""
    sent, heads = docs.sparkSession.sparkContext.broadcast(model), len(model.words)
    nodes = heads + FORMS

    def out(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        w, o = keys // nodes, keys % nodes
        back = o < heads  # forms do not move, so what stands before them is not asked for
        own, other, n = np.concatenate([w, o[back]]), np.concatenate([o, w[back] + nodes]), np.concatenate([n, n[back]])
        order = np.argsort(((own % GROUPS) * (nodes // GROUPS + 1) + own // GROUPS) * (2 * nodes) + other)
        own, other, n = own[order], other[order], n[order]
        grp, first = np.unique(own % GROUPS, return_index=True)
        cut = np.append(first, len(own))
        for i in range(0, len(grp), 512):
            lo, hi = cut[i], cut[min(i + 512, len(grp))]
            ends = pa.py_buffer(((cut[i : min(i + 512, len(grp)) + 1] - lo) * 4).astype("<i4").tobytes())
            size = min(512, len(grp) - i)
            blobs = [pa.Array.from_buffers(pa.binary(), size, [None, ends, pa.py_buffer(x[lo:hi].astype("<u4").tobytes())]) for x in (own, other, n)]
            yield pa.RecordBatch.from_arrays([pa.array(grp[i : i + 512], pa.int32()), *blobs], names=["grp", "own", "other", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_: Model = sent.value
        held, size = [], 0
        for batch in gathered(batches):
            words, ids, _ = numbered(batch.column("text"))
            x = model_.numbers(words)
            node = np.where(x >= 0, x, heads - 1 - x)
            for i in range(0, len(ids), 500_000):  # a batch of long texts is counted in parts
                p = node[ids[i : i + 500_000]]
                before = np.concatenate([[node[-1] if not i else node[ids[i - 1]]], p[:-1]])
                held.append(before * nodes + p)
                size += len(p)
                if size > 1_000_000:
                    yield from out(held)
                    held, size = [], 0
        if held:
            yield from out(held)
        held.clear()
        give_back()

    kept = docs.select("text").mapInArrow(run, "grp int, own binary, other binary, n binary")
    return written(kept.repartition("grp").sortWithinPartitions("grp"), "lm-pairs")


def _unpacked(batch: pa.RecordBatch, below: int | None = None) -> list[np.ndarray]:
    """own, other and n of all of a batch's rows, or of those with other below."""
    found = [np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u4") for c in ("own", "other", "n")]
    if below is not None:
        some = found[1] < below
        found = [x[some] for x in found]
    return [x.astype(np.int64) for x in found]


def _pair_sums(pairs: DataFrame, shape: tuple[int, ...], nodes: int, cell) -> np.ndarray:
    """Counts of pairs (word, next word) by cell(word, next), -1 for none."""

    def run(batches):
        array = np.zeros(int(np.prod(shape)), dtype=np.int64)
        for batch in batches:
            own, other, n = _unpacked(batch, nodes)
            at = cell(own, other)
            some = at >= 0
            array += np.bincount(at[some], weights=n[some], minlength=len(array)).astype(np.int64)
        yield from _cells(array)

    out = np.zeros(int(np.prod(shape)), dtype=np.int64)
    for batch in pairs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow().to_batches():
        out[batch.column("cell").to_numpy()] = batch.column("n").to_numpy()
    return out.reshape(shape).astype(np.float64)


def likelihood(m: np.ndarray) -> float:
    """Log likelihood by class bigrams, less what no class changes."""
    return float(_h(m).sum() - _h(m.sum(0)).sum() - _h(m.sum(1)).sum())


def best_moves(words: np.ndarray, contexts: np.ndarray, of: np.ndarray, m: np.ndarray, k: int) -> dict[int, int]:
    """New classes, below k, of those words that move, each in turn, by the
    likelihood of m (classes x classes, changed in place). contexts: a row for
    each word, of its counts by class after it, by class before it, and of
    itself after itself; of: class of each word here."""
    size, moved, low = len(m), {}, np.arange(k)
    for w, x, a in zip(words.tolist(), contexts, of.tolist()):
        r, c, s = x[:size].copy(), x[size : 2 * size].copy(), x[2 * size]
        r[a] -= s
        c[a] -= s
        m[a] -= r
        m[:, a] -= c
        m[a, a] -= s
        nr, nc = np.flatnonzero(r), np.flatnonzero(c)
        x, y, d, rk, ck = m[:k, nr], m[nc, :k].T, m[low, low], r[:k], c[:k]
        gain = (_h(x + r[nr]) - _h(x)).sum(1) + (_h(y + c[nc]) - _h(y)).sum(1)
        rows, cols = m[:k].sum(1) + ck, m[:, :k].sum(0) + rk
        h = _h(np.stack([d + rk + ck + s, d, rows, cols, d + rk, d + ck, rows + (r.sum() + s), cols + (c.sum() + s)]))
        gain += h[:4].sum(0) - h[4:].sum(0)
        b = int(gain.argmax())
        if a < k and gain[b] <= gain[a] + 1e-9:
            b = a
        m[b] += r
        m[:, b] += c
        m[b, b] += s
        if b != a:
            moved[w] = b
    return moved


def _contexts(pairs: DataFrame, of: np.ndarray, size: int) -> DataFrame:
    """(unit, cell, n) from pairs under the classes of: cell is node * (2 * size
    + 1) + the class after it, size + the class before it, or 2 * size for the
    node itself after it. Several rows of a unit may hold one cell."""
    nodes, width = len(of), 2 * size + 1
    each = nodes // GROUPS + 1
    sent = pairs.sparkSession.sparkContext.broadcast(of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.zeros(GROUPS, dtype=np.int64)
        for batch in batches:
            own, other, n = _unpacked(batch)
            grps = np.unique(batch.column("grp").to_numpy())
            for some in np.split(grps, range(64, len(grps), 64)):  # bounds the array below
                at[:] = -1
                at[some] = np.arange(len(some)) * each * width
                start = at[own % GROUPS]
                ok = slice(None) if len(some) == len(grps) else start >= 0
                w, o, x, start = own[ok], other[ok], n[ok], start[ok]
                back = o >= nodes
                cell = start + w // GROUPS * width + sent.value[np.where(back, o - nodes, o)] + back * size
                sums = np.bincount(cell, weights=x, minlength=len(some) * each * width)
                same = w == o
                sums += np.bincount(start[same] + w[same] // GROUPS * width + 2 * size, weights=x[same], minlength=len(sums))
                full = np.flatnonzero(sums)
                row = full // width
                node = row % each * GROUPS + some[row // each]
                # A row's counts are of one batch of pairs, so four bytes hold them.
                cell, count, unit = (node * width + full % width).astype("<u4"), sums[full].astype("<u4"), node % GROUPS % UNITS
                units = np.unique(unit)
                blobs = [pa.array([v[unit == u].tobytes() for u in units], pa.binary()) for v in (cell, count)]
                yield pa.RecordBatch.from_arrays([pa.array(units, pa.int32()), *blobs], names=["unit", "cell", "n"])
        give_back()

    return written(pairs.mapInArrow(run, "unit int, cell binary, n binary").repartition(UNITS, "unit"), "lm-contexts")


def _steps_of(contexts: DataFrame, of: np.ndarray, size: int) -> np.ndarray:
    """Counts of classes after classes, from the contexts under them."""
    width = 2 * size + 1
    sent = contexts.sparkSession.sparkContext.broadcast(of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            for cell, n in zip(batch.column("cell"), batch.column("n")):  # a row at a time, as rows are long
                cell, n = (np.frombuffer(x.as_buffer(), dtype="<u4") for x in (cell, n))
                after = cell % width < size
                cell, n = cell[after], n[after]
                array += np.bincount(sent.value[cell // width] * size + cell % width, weights=n, minlength=len(array)).astype(np.int64)
        yield from _cells(array)
        give_back()

    out = np.zeros(size * size)
    for batch in contexts.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow().to_batches():
        out[batch.column("cell").to_numpy()] = batch.column("n").to_numpy()
    return out.reshape(size, size)


def sweep(contexts: DataFrame, of: np.ndarray, movable: np.ndarray, m: np.ndarray, k: int) -> np.ndarray:
    """of (class of each node) after one sweep of the exchange over all movable
    words. Words are dealt to UNITS; those of a unit move in turn, by frequency,
    against the classes of the others as they were at the sweep's start
    (Uszkoreit and Brants, 2008)."""
    width = 2 * len(m) + 1
    sent = contexts.sparkSession.sparkContext.broadcast((of, movable, m))

    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_, movable_, m_ = sent.value
        members = np.flatnonzero(movable_)
        members = [members[members % GROUPS % UNITS == u] for u in range(UNITS)]
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for u, cell, n in zip(batch.column("unit").to_pylist(), batch.column("cell"), batch.column("n")):
                cell, n = (np.frombuffer(x.as_buffer(), dtype="<u4") for x in (cell, n))
                some = movable_[cell // width]
                cell, n = cell[some], n[some]
                if u not in held:
                    held[u] = np.zeros((len(members[u]), width))
                np.add.at(held[u], (np.searchsorted(members[u], cell // width), cell % width), n)
        for u in sorted(held):
            moved = best_moves(members[u], held.pop(u), of_[members[u]], m_.copy(), k)
            yield pa.RecordBatch.from_arrays([pa.array(list(moved), pa.int64()), pa.array(list(moved.values()), pa.int64())], names=["word", "to"])
        give_back()

    found = contexts.repartition(UNITS, "unit").mapInArrow(moves, "word long, to long").toArrow()
    out = of.copy()
    out[found.column("word").to_numpy()] = found.column("to").to_numpy()
    return out


@shipped
def fit(learn: DataFrame, *, classes: int = 48, core: int = 1024, middle: int = 4096, head: int = 1 << 18, sweeps: int = 3, least_gain: float = 1e-3) -> tuple[Model, DataFrame]:
    """The model, and the table (word, c) of all training words, from learn
    (text)."""
    counts = written(learn.select("text").mapInArrow(_word_counts, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")
    total, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    # The least count of a head word, from a histogram of the counts' logarithms.
    bins = counts.groupBy(F.floor(F.log2("c") * 32).alias("b")).count().orderBy(F.desc("b")).collect()
    least, held = None, 0
    for r in bins:
        if held + r["count"] > head:
            break
        held, least = held + r["count"], r["b"]
    often = F.floor(F.log2("c") * 32) >= (float("inf") if least is None else least)
    rows = counts.where(often | (F.octet_length("word") == 0)).toArrow()  # END has a class of its own, however rare
    found = sorted(zip(rows.column("c").to_pylist(), rows.column("word").to_pylist()), key=lambda x: (-x[0], x[1]))
    words = [w for _, w in found]
    model = Model(pa.array([w.decode() for w in words], pa.string()), np.array([c for c, _ in found], dtype=np.float64), np.zeros(0, np.int64), total=total or 0, distinct=distinct)

    heads, k = len(words), min(classes, max(1, sum(w != END for w in words[:classes + 1])))
    nodes, size = heads + FORMS, k + 1 + FORMS
    usual = np.array([i for i, w in enumerate(words) if w != END], dtype=np.int64)
    core_at = usual[:core]
    n_core = len(core_at)
    place = np.full(nodes, -1)
    place[core_at] = np.arange(n_core)
    pairs = _pairs(learn, model)

    def of_core(w, o):
        return np.where((place[w] >= 0) & (place[o] >= 0), place[w] * n_core + place[o], -1)

    own_forms = forms(model.words)
    of = np.concatenate([own_forms, np.arange(FORMS)]) + k + 1
    if END in words:
        of[words.index(END)] = k
    if n_core:
        # Rows of other groups hold no pair of the core.
        own = pairs.where(F.col("grp").isin(np.unique(core_at % GROUPS).tolist())) if n_core < GROUPS // 2 else pairs
        of[core_at] = exchange(_pair_sums(own, (n_core, n_core), nodes, of_core), k)

    # The core and the middle first; then all words, as long as it helps.
    best, m = of, None
    for i in range(sweeps + 2 if n_core else 1):
        contexts = _contexts(pairs, of, size)
        new = _steps_of(contexts, of, size)
        rise = likelihood(new) - likelihood(m) if m is not None else 0.0
        if i > 1 and rise <= 0:
            break
        gained, best, m = rise, of, new
        if i > 1 and gained < least_gain * abs(likelihood(m)):
            break
        if i > sweeps or not n_core:
            break
        movable = np.zeros(nodes, dtype=bool)
        movable[usual[: core + middle] if i == 0 else usual] = True
        of = sweep(contexts, of, movable, m, k)
    of = best
    model.n_classes, model.classes, model.steps = k, of[:heads], m
    model.class_tokens = model.steps.sum(0)
    model.class_words = np.bincount(model.classes, minlength=size).astype(np.float64)

    def all_forms(batches):
        array = np.zeros(FORMS, dtype=np.int64)
        for batch in batches:
            array += np.bincount(forms(batch.column("word").cast(pa.string())), minlength=FORMS)
        yield from _cells(array)

    # Words of forms: all words, but not those of the head.
    model.class_words[k + 1 :] -= np.bincount(own_forms, minlength=FORMS)
    for r in counts.select("word").mapInArrow(all_forms, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        model.class_words[k + 1 + r["cell"]] += r["n"]
        model.form_words[r["cell"]] += r["n"]
    model.form_words[form(END)] -= END in words
    return model, counts


_LOCAL = "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, words array<binary>, times array<int>, forms array<int>, unseen array<double>"


@shipped
def score(docs: DataFrame, model: Model, counts: DataFrame, *, fold: int = 10, base: float = 0.1, smooth: float = 0.1, discount: float = 0.6) -> DataFrame:
    """Scores of every row of docs (doc_id, text)."""
    step = np.log10(model.transitions(smooth))
    mass = np.maximum(model.class_tokens, 1.0)
    emit = np.log10(np.maximum(model.counts - discount, 1e-9) / mass[model.classes]) if len(model.counts) else np.zeros(0)
    unknown, of_form = map(np.log10, model.unknown(smooth, discount))
    base_log = np.log10(model.counts + base)
    floor = float(np.log10(model.total + base * (model.distinct + 1)))
    sent = docs.sparkSession.sparkContext.broadcast((model, step, emit, base_log, unknown))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, step_, emit_, log_, unknown_ = sent.value
        uid = TaskContext.get().partitionId() << 40
        for batch in gathered(batches):
            rows = batch.num_rows
            if not rows:
                continue
            words, ids, n = numbered(batch.column("text"))
            begin, number = np.cumsum(n) - n, own.numbers(words)
            x = number[ids]
            c, known = own.class_of(x), x >= 0
            before = np.concatenate([[0], c[:-1]])
            before[begin] = own.n_classes
            value, base_ = step_[before, c], np.zeros(len(x))
            value[known] += emit_[x[known]]
            base_[known] = log_[x[known]]
            # The rare words of each text, each once, with their numbers of times and
            # what they add in place of their forms' transitions if they are unknown.
            at = np.flatnonzero(~known)
            key, place, times = np.unique(np.repeat(np.arange(rows), n)[at] * len(words) + ids[at], return_inverse=True, return_counts=True)
            unseen = np.bincount(place, weights=(unknown_[before] - step_[before, c])[at], minlength=len(key))
            ends = pa.array(np.searchsorted(key // len(words), np.arange(rows + 1)), pa.int32())
            word = key % len(words)
            lists = [pa.ListArray.from_arrays(ends, v) for v in (words.take(pa.array(word)).cast(pa.binary()), pa.array(times, pa.int32()), pa.array(-1 - number[word], pa.int32()), pa.array(unseen, pa.float64()))]
            sums = [np.add.reduceat(v, begin) for v in (known.astype(np.int64), base_, value)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid + np.arange(rows)), batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(n), *map(pa.array, sums), *lists],
                names=[f.split()[0] for f in _LOCAL.split(", ")],
            )
            uid += rows

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % fold == 0, F.lit(True)).alias("held_out")
    local = written(docs.select("doc_id", held, "text").mapInArrow(run, _LOCAL), "lm-local")

    # Rare words: joined with their counts, added up for each text.
    rare = local.select("uid", F.explode(F.arrays_zip("words", "times", "forms", "unseen")).alias("x"))
    rare = rare.select("uid", F.col("x.words").alias("word"), F.col("x.times").alias("times"), F.col("x.forms").alias("form"), F.col("x.unseen").alias("unseen"))
    c = F.coalesce("c", F.lit(0))
    lookup = lambda a: F.element_at(F.array(*[F.lit(float(x)) for x in a]), F.col("form") + 1)
    forms_mass = np.log10(mass[model.n_classes + 1 :])
    emitted = F.when(c > 0, F.col("times") * (F.log10(c - discount) - lookup(forms_mass))).otherwise(F.col("unseen") + F.col("times") * lookup(of_form))
    joined = rare.join(counts, "word", "left")
    sums = joined.groupBy("uid").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"), F.sum(F.col("times") * F.log10(c + base)).alias("more_base"), F.sum(emitted).alias("more_score")
    )
    out = local.drop("words", "times", "forms", "unseen").join(sums, "uid", "left")
    zero = F.lit(0.0)
    total = F.col("score") + F.coalesce("more_score", zero)
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero) - F.col("n_tokens") * floor).alias("base_score"), total.alias("score"),
        F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"),
    )


@shipped
def class_bigram_scores(docs: DataFrame, *, fold: int = 10, **options) -> DataFrame:
    """Scores of all docs by a model of those whose crc32 of doc_id is not a
    multiple of fold."""
    learn = docs.where(F.crc32(F.col("doc_id").cast("string")) % fold != 0)
    model, counts = fit(learn, **options)
    return score(docs, model, counts, fold=fold)
