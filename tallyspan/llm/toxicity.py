"""Severity of toxicity by cumulative-link ordinal regression.

P(grade > k) = sigmoid(w . x - theta_k): one weight vector for all thresholds
theta_1 <= theta_2 <= ...; x holds the presence of single words and steps of
the share of marked words in the text. The expected severity is the sum of
P(grade > k).

The vocabulary are at most ``most_terms`` words, for toxic texts or for clean ones,
under a ridge. The first of them, the marked words, stand out in toxic texts (log
odds and their z value, counted over the sample); the others are those of
``least_docs`` texts or more whose odds differ most surely, z of either sign.

Where labels have a column of grades, these are fitted. Labels that only say toxic
or not get their grades out of fold: the sample is dealt to two folds, each has
marked words of its own, and a toxic text is of grade 2 where the share of its words
that the *other* fold marks is above the median of toxic texts, of grade 1 else. So
no text has a hand in the words that grade it, and the features
that are fitted to its grade come from another vocabulary. Clean texts are of
grade 0.

Bounds of what is learned from, whatever the size of the data: ``most_labels``
labelled documents (smallest hashes of doc_id) and ``most_terms`` words. Every
text is scored, whole, in one pass without a shuffle.

Edge cases. Null or empty text: no features, scored by the thresholds alone.
Repeated ids: each row is scored; with several labels the row that is more toxic
counts. No labels, or of one kind only, or no marked words: nothing is toxic,
severity 0. Ties: words of equal z by their bytes, shares equal to the median are
of grade 1, labels of equal hash by id. Long texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import as_bytes, shipped, smallest_hashes, thrifty, written

SCORES = "doc_id long, severity int, expected_severity double, p_toxic double, toxic boolean, n_words long"
#: Words are runs of letters, digits and non-ASCII bytes, A-Z lowered.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))
#: Shares of marked words from which each step feature is on.
SHARES = (0.0005, 0.002, 0.005, 0.01, 0.03)


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


@dataclass
class Model:
    vocabulary: dict[bytes, int]
    weights: np.ndarray
    thresholds: np.ndarray
    #: How many words, the first, are marked; None: all.
    marked: int | None = None

    def features(self, found: list[bytes]) -> list[int]:
        hits = [i for i in map(self.vocabulary.get, found) if i is not None]
        if not hits:
            return []
        marked = len(hits) if self.marked is None else sum(i < self.marked for i in hits)
        share = marked / len(found)
        return [*sorted(set(hits)), *(len(self.vocabulary) + k for k, s in enumerate(SHARES) if share >= s)]

    def above(self, features: list[int]) -> np.ndarray:
        """P(grade > k) for each threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - self.weights[features].sum(), -50, 50)))


def fit_cumulative_link(rows: Sequence[Sequence[int]], grades: np.ndarray, n_features: int, *, ridge: float = 0.02, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by gradient ascent of the penalised log
    likelihood (Adam), on rows of active feature numbers."""
    top = int(grades.max(initial=0))
    n, at = len(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cols = np.concatenate([np.zeros(0, np.int64), *[np.asarray(r, dtype=np.int64) for r in rows]])
    base = [np.clip((grades > k).mean(), 1e-4, 1 - 1e-4) for k in range(top)]
    theta = np.log((1 - np.array(base)) / np.array(base))
    params = np.concatenate([np.zeros(n_features), [theta[0]], np.log(np.maximum(np.diff(theta), 1e-3))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    for step in range(1, steps + 1):
        w, gaps = params[:n_features], np.exp(params[n_features + 1 :])
        theta = params[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])
        eta = np.bincount(at, weights=w[cols], minlength=n)
        s = sig(eta[:, None] - theta[None, :])  # P(y > k)
        upper = np.concatenate([np.ones((n, 1)), s], 1)
        lower = np.concatenate([s, np.zeros((n, 1))], 1)
        i = np.arange(n)
        p = np.maximum(upper[i, grades] - lower[i, grades], 1e-12)
        du, dl = upper[i, grades], lower[i, grades]
        gu, gl = du * (1 - du) / p, dl * (1 - dl) / p
        g_eta = gu - gl
        g_theta = np.zeros(top)
        np.add.at(g_theta, grades[grades > 0] - 1, -gu[grades > 0])
        np.add.at(g_theta, grades[grades < top], gl[grades < top])
        tails = np.cumsum(g_theta[::-1])[::-1]
        grad = np.concatenate([np.bincount(cols, weights=g_eta[at], minlength=n_features) / n - ridge / 100 * w, [tails[0] / n], tails[1:] * gaps / n])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        params = params + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    gaps = np.exp(params[n_features + 1 :])
    return params[:n_features], params[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])


#: Folds by which binary labels are graded.
FOLDS = 2


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[int, int], Counter] = {(f, t): Counter() for f in range(FOLDS) for t in (0, 1)}
    for batch in batches:
        for text, fold, toxic in zip(as_bytes(batch.column("text")), batch.column("fold").to_pylist(), batch.column("toxic").to_pylist()):
            counts[fold, toxic].update(set(words(text)))
    terms = list(set().union(*counts.values()))
    for i in range(0, len(terms), 50_000):
        own = terms[i : i + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.binary()), *(pa.array([c[t] for t in own], pa.int64()) for c in counts.values())], names=["term", *(f"n{f}{t}" for f, t in counts)]
        )


def sample(docs: DataFrame, labels: DataFrame, most_labels: int, grade: str | None = None) -> DataFrame:
    """(text, toxic, fold, grade) of at most most_labels labelled documents."""
    known = labels.where("doc_id is not null and toxic is not null")
    level = F.max(F.col(grade) if grade else F.lit(None)).cast("int").alias("grade")
    own = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"), level)
    few = smallest_hashes(own, "doc_id", most_labels, known.count())
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    return written(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("text", "toxic", fold, "grade"), "toxicity-sample")


def _terms(
    counts: DataFrame, folds: range | list[int], clean: int, toxic: int, most_terms: int, least_z: float, least_odds: float, least_share: float, least_docs: int
) -> list[tuple[bytes, bool]]:
    """(word, whether it is marked) over some folds, marked words first, by falling
    size of z; at most most_terms."""
    c, t = (sum(F.col(f"n{f}{k}") for f in folds) + 0.5 for k in (0, 1))
    odds = F.log(t / (F.lit(toxic + 1.0) - t)) - F.log(c / (F.lit(clean + 1.0) - c))
    spread = F.sqrt(1 / t + 1 / c + 1 / (F.lit(toxic + 1.0) - t) + 1 / (F.lit(clean + 1.0) - c))
    z = odds / spread
    marked = (t >= max(3.0, least_share * toxic) + 0.5) & (z >= least_z) & (odds >= least_odds)
    known = counts.select("term", marked.alias("marked"), F.abs(z).alias("z")).where(F.col("marked") | (t + c >= least_docs + 1.0))
    return [(bytes(r["term"]), r["marked"]) for r in known.orderBy(F.desc("marked"), F.desc("z"), "term").limit(most_terms).collect()]


@shipped
def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    grade: str | None = None,
    most_labels: int = 20_000,
    most_terms: int = 2048,
    least_z: float = 3.0,
    least_odds: float = 3.0,
    least_share: float = 0.01,
    least_docs: int = 5,
) -> Model:
    """The model from labels (doc_id, toxic, and the column ``grade`` names) and
    docs (doc_id, text). A marked word must occur in least_share of the toxic texts,
    which keeps out the chance words of single texts and their copies; it is low,
    as each language has terms of its own and some languages are rare."""
    rows = sample(docs, labels, most_labels, grade)
    n = {(r["fold"], r["toxic"]): r["count"] for r in rows.groupBy("fold", "toxic").count().collect()}
    totals = lambda folds: [sum(n.get((f, t), 0) for f in folds) for t in (0, 1)]
    none = Model({}, np.zeros(len(SHARES)), np.array([50.0, 60.0]))
    if not all(totals(range(FOLDS))):
        return none
    names = [f"n{f}{t}" for f in range(FOLDS) for t in (0, 1)]
    counts = rows.select("text", "fold", "toxic").mapInArrow(thrifty(_term_counts), "term binary, " + ", ".join(f"{x} long" for x in names))
    counts = written(counts.groupBy("term").agg(*[F.sum(x).alias(x) for x in names]), "toxicity-terms")

    def terms(folds) -> list[tuple[bytes, bool]]:
        clean, toxic = totals(folds)
        return _terms(counts, folds, clean, toxic, most_terms, least_z, least_odds, least_share, least_docs) if clean and toxic else []

    chosen = terms(range(FOLDS))
    marked = sum(m for _, m in chosen)
    if not marked:
        return none
    whole = {w: i for i, (w, _) in enumerate(chosen)}
    others = [{w for w, m in terms([g for g in range(FOLDS) if g != f]) if m} for f in range(FOLDS)] if grade is None else [set()] * FOLDS

    def features(batches):
        own = Model(whole, np.zeros(0), np.zeros(0), marked)
        for batch in batches:
            out, share = [], []
            for text, fold in zip(as_bytes(batch.column("text")), batch.column("fold").to_pylist()):
                found = words(text)
                out.append(np.array(own.features(found), dtype=np.int32).tobytes())
                share.append(sum(w in others[fold] for w in found) / max(1, len(found)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column("toxic"), batch.column("grade"), pa.array(share, pa.float64())], names=["x", "toxic", "grade", "share"])

    got = rows.select("text", "toxic", "fold", "grade").mapInArrow(thrifty(features), "x binary, toxic int, grade int, share double").collect()
    got.sort(key=lambda r: (r["toxic"], r["share"], r["grade"] or 0, bytes(r["x"])))
    label = np.array([r["toxic"] for r in got])
    if grade is None:
        share = np.array([r["share"] for r in got])
        seen = share[(label == 1) & (share > 0)]
        grades = label + ((label == 1) & (share > (np.median(seen) if len(seen) else 1.0)))
    else:
        grades = np.maximum(np.array([r["grade"] or 0 for r in got]), label)
    weights, thresholds = fit_cumulative_link([np.frombuffer(r["x"], np.int32) for r in got], grades.astype(np.int64), len(whole) + len(SHARES))
    return Model(whole, weights, thresholds, marked)


@shipped
def score(docs: DataFrame, model: Model, *, toxic_from: float = 0.5) -> DataFrame:
    """severity (the likeliest side of each threshold), its expectation, and
    toxic where P(grade > 0) reaches toxic_from, for every row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = sent.value
        blank = own.above([])
        for batch in batches:
            rows = []
            for text in as_bytes(batch.column("text")):
                found = words(text)
                x = own.features(found)
                p = own.above(x) if x else blank
                rows.append((int((p >= 0.5).sum()), float(p.sum()), float(p[0]), bool(p[0] >= toxic_from), len(found)))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int32(), pa.float64(), pa.float64(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=[x.split()[0] for x in SCORES.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(thrifty(run), SCORES)


@shipped
def clean_rows(docs: DataFrame, model: Model, *, toxic_from: float = 0.5) -> DataFrame:
    """The rows of docs, with all of their columns, that score() finds not toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = sent.value
        blank = own.above([])[0]
        for batch in batches:
            x = [own.features(words(t)) for t in as_bytes(batch.column("text"))]
            yield batch.filter(pa.array([(own.above(f)[0] if f else blank) < toxic_from for f in x], pa.bool_()))

    return docs.mapInArrow(thrifty(run), docs.schema)
