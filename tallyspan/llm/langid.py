"""Language by string kernels: blended-spectrum presence kernels, Nystroem
landmarks, one-versus-rest kernel ridge regression.

A text is the set of its 1-, 2- and 3-grams of bytes (A-Z lowered, other ASCII
but letters as blanks), each hashed to one of ``buckets`` places. The kernel of
two texts is the number of places they share over the root of the product of
their sizes. Landmarks are some training texts; with their kernel matrix K and
its inverse root R, any text x has the features k(x, landmarks) R, and one
ridge regression per language is solved on these. Scoring multiplies a batch's
presence matrix by the landmarks' and by the solved weights.

Training rows are documents with text and language whose crc32 of doc_id is not
a multiple of ``fold``; of each language the ``per_lang`` smallest hashes of
doc_id, the first ``landmarks`` of these as landmarks. The prediction sees the
text alone.

Bounds of what is learned from, whatever the size of the data: the ``most_langs``
most frequent languages (rarer ones are never predicted), ``most_rows`` training
rows and ``most_landmarks`` landmarks in all, dealt evenly to the languages where
``per_lang`` and ``landmarks`` come to more. With the defaults the driver holds
128 MB of kernel values and 64 MB of landmarks.

Edge cases. Null doc_id: held out. Null text, or one without any letter: ``und``
with score 0. No training rows: all ``und``. One language only: that one. Repeated
rows: each is scored, and each may train. Ties: of languages with equal scores the
first by name, of training rows with equal hashes the smaller id, of languages
equally frequent the first by name. Long texts: whole. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import as_bytes, shipped, thrifty

PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
#: Odd multipliers that spread the n-grams over the buckets, for n = 1, 2, 3.
_SPREAD = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def presence(text: bytes, out: np.ndarray) -> None:
    """Set the places of the text's n-grams; out has a power of two places."""
    shift = np.uint32(33 - len(out).bit_length())
    key = np.frombuffer(text.translate(_LETTERS), dtype=np.uint8).astype(np.uint32)
    data = key
    for n, spread in enumerate(_SPREAD):
        if n:
            if len(key) < 2:
                break
            key = (key[:-1] << np.uint32(8)) | data[n:]
        out[((key + np.uint32(1)) * spread) >> shift] = 1


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


@dataclass
class Model:
    langs: list[str]
    landmarks: np.ndarray  # places x landmarks
    roots: np.ndarray
    weights: np.ndarray  # landmarks x languages

    def scores(self, present: np.ndarray) -> np.ndarray:
        """present: texts x places, float32."""
        size = np.sqrt(np.maximum(present.sum(1), 1))
        return ((present @ self.landmarks) / size[:, None] / self.roots[None, :]) @ self.weights

    def predict(self, texts: list[bytes], block: int) -> tuple[list[str], list[float]]:
        places = self.landmarks.shape[0]
        here, flags = np.empty((block, places), np.float32), np.empty(places, np.uint8)
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        todo = [i for i, t in enumerate(texts) if self.langs and has_letter(t)]
        for start in range(0, len(todo), block):
            some = todo[start : start + block]
            for k, i in enumerate(some):
                flags[:] = 0
                presence(texts[i], flags)
                here[k] = flags
            f = self.scores(here[: len(some)])
            best = f.argmax(1)
            for k, i in enumerate(some):
                langs[i] = self.langs[best[k]]
                scores[i] = float(min(1.0, max(0.0, (f[k, best[k]] + 1) / 2)))
        return langs, scores


def _inverse_root(k: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(k)
    keep = values > 1e-6 * values.max()
    return vectors[:, keep] / np.sqrt(values[keep])


@shipped
def fit(
    docs: DataFrame,
    *,
    fold: int = 5,
    per_lang: int = 400,
    landmarks: int = 40,
    buckets: int = 1 << 14,
    ridge: float = 0.1,
    most_langs: int = 500,
    most_rows: int = 16_000,
    most_landmarks: int = 1024,
) -> Model:
    """The model from docs (doc_id, text, lang)."""
    learn = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % fold != 0))
    often = learn.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_langs).collect()
    if not often:
        return Model([], np.zeros((buckets, 1), np.float32), np.ones(1, np.float32), np.zeros((1, 0), np.float32))
    per, n_marks = min(per_lang, max(1, most_rows // len(often))), min(landmarks, max(1, most_landmarks // len(often)))
    # Rows above a hash below which the smallest surely lie are not ranked.
    below = [(r["lang"], int(min(-(1 << 63) + (per + 8 * per**0.5 + 64) / r["count"] * (1 << 64), (1 << 63) - 1))) for r in often]
    limits = docs.sparkSession.createDataFrame(below, "lang string, below long")
    hashed = F.xxhash64("doc_id")
    some = learn.select("doc_id", "lang", "text").join(F.broadcast(limits), "lang").where(hashed <= F.col("below"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in as_bytes(batch.column("text")):
                here = np.zeros(buckets, dtype=np.uint8)
                presence(text, here)
                out.append(np.packbits(here).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("doc_id").cast(pa.int64()), pa.array(out, pa.binary())], names=["lang", "doc_id", "x"])

    rows = some.select("lang", "doc_id", "text").mapInArrow(thrifty(features), "lang string, doc_id long, x binary")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(hashed, "doc_id", "x"))
    got = sorted(rows.withColumn("rank", rank).where(F.col("rank") <= per).select("rank", "lang", "x").collect())
    return solve([r["lang"] for r in got], [bytes(r["x"]) for r in got], np.array([r["rank"] <= n_marks for r in got]), buckets, ridge)


def solve(lang: list[str], packed: list[bytes], is_mark: np.ndarray, buckets: int, ridge: float, block: int = 512) -> Model:
    """The model of training texts given as packed presence bits; the kernel with
    the landmarks is made a block of texts at a time."""
    langs = sorted(set(lang))
    bits = lambda rows: np.unpackbits(np.frombuffer(b"".join(rows), dtype=np.uint8)).reshape(len(rows), buckets).astype(np.float32)
    marks = bits([x for x, m in zip(packed, is_mark) if m])
    roots = np.sqrt(np.maximum(marks.sum(1), 1))
    kernel = lambda a: (a @ marks.T) / np.sqrt(np.maximum(a.sum(1), 1))[:, None] / roots[None, :]
    k = np.concatenate([kernel(bits(packed[i : i + block])) for i in range(0, len(packed), block)])
    root = _inverse_root(k[is_mark].astype(np.float64))
    phi = k.astype(np.float64) @ root
    y = np.where(np.array(lang)[:, None] == np.array(langs)[None, :], 1.0, -1.0)
    beta = np.linalg.solve(phi.T @ phi + ridge * np.eye(phi.shape[1]), phi.T @ y)
    return Model(langs, np.ascontiguousarray(marks.T), roots.astype(np.float32), (root @ beta).astype(np.float32))


@shipped
def predict(docs: DataFrame, model: Model, *, fold: int = 5, block: int = 64) -> DataFrame:
    """lang_pred and score for every row of docs (doc_id, text); held_out says
    whether the row was kept from training."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = sent.value
        for batch in batches:
            langs, scores = own.predict(as_bytes(batch.column("text")), block)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % fold == 0, F.lit(True)).alias("held_out")
    return docs.select("doc_id", held, "text").mapInArrow(thrifty(run), PREDICTED)


@shipped
def rows_in(docs: DataFrame, model: Model, langs: tuple[str, ...], least_score: float, *, block: int = 64) -> DataFrame:
    """The rows of docs, with all of their columns, whose text predict() puts
    into one of langs with at least least_score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = zip(*sent.value.predict(as_bytes(batch.column("text")), block))
            yield batch.filter(pa.array([x in langs and s >= least_score for x, s in found], pa.bool_()))

    return docs.mapInArrow(thrifty(run), docs.schema)
