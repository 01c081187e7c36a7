"""Media columns stored as content-defined chunks.

A text's UTF-8 bytes, filled up with zeros to a positive multiple of 64, are the
samples of an 8-bit mono WAV file. Its bytes are cut where a rolling gear hash
of the last 32 bytes has ``bits`` leading zeros (at least ``least`` and at most
``most`` bytes apart), so equal passages give equal chunks wherever they stand.

1. Each file's ordered list of chunk digests (the manifest).
2. Joins on the digests find each chunk's first file, its owner, and for every
   other file the chunks that it only refers to.
3. The store is written once: a container for each distinct file, which holds the
   bytes of those of its chunks that no other place has, header included, and the
   file's list; and a pool row for each chunk of several places.
4. Reading back, a container is cut into its chunks, pool chunks come by a join,
   and the file is put together in the order of its list. Each chunk must have
   the digest that the list says, and the whole the file's digest and length;
   features are computed from these bytes.

Containers are compressed frames (a dictionary trained on a bounded sample), which
are moved once; files without pool chunks are not moved again. Equal files of one
task are sent once, and joins on a file or chunk that holds many rows broadcast
its row, so what a third of the rows hold is no hot key.

Edge cases. Null or empty text: 64 zero bytes. Repeated rows or ids: equal files
are stored once, each row gets its own result. Null doc_id: kept. Long texts:
whole, in as many chunks as needed. No rows: no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import as_bytes, groups, hot_keys, join_unique, shipped, smallest_hashes, written

UNIT, RATE, HEADER = 64, 8000, 44
DIGEST = 16
_GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4, person=b"gear").digest(), "little") for b in range(256)], dtype=np.uint32)


def payload_of(text: bytes) -> bytes:
    return text + bytes(-len(text) % UNIT if text else UNIT)


def wav(payload: bytes) -> bytes:
    n = len(payload)
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", (36 + n) & 0xFFFFFFFF, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", n & 0xFFFFFFFF)
    return head + payload


def samples_of(media: bytes) -> bytes:
    if media[:4] != b"RIFF" or media[36:40] != b"data":
        raise ValueError("not a WAV file of this store")
    return media[HEADER:]


def cuts(data: bytes, bits: int, least: int, most: int) -> list[int]:
    """Ends of the chunks of data."""
    n = len(data)
    h = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    for s in (1, 2, 4, 8, 16):
        if n > s:
            more = h[:-s] << np.uint32(s)
            h[s:] += more
    marks = (np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1).tolist()
    ends, at = [], 0
    while n - at > least:
        k = bisect_left(marks, at + least)
        at = min(marks[k] if k < len(marks) else n, at + most, n)
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=DIGEST).digest()


def feature(payload: bytes) -> str:
    """Level, zero crossings and a 16-step amplitude histogram of the samples."""
    x = np.frombuffer(payload, dtype=np.uint8).astype(np.int32) - 128
    level = float(np.sqrt((x * x).mean()))
    crossings = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    steps = np.bincount((x + 128) >> 4, minlength=16)
    return f"rms={level:.4f};zc={crossings};hist=" + ",".join(map(str, steps.tolist()))


class Frames:
    """Compression of chunks with the store's dictionary."""

    def __init__(self, dictionary: bytes, level: int) -> None:
        import zstandard

        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        options = {"dict_data": shared} if shared else {}
        self.pack = zstandard.ZstdCompressor(level=level, **options).compress
        self._unpack = zstandard.ZstdDecompressor(**options)

    def unpack(self, frame: bytes) -> bytes:
        return self._unpack.decompress(frame)


def train(docs: DataFrame, *, most_rows: int, most_bytes: int = 8192, size: int = 110_000) -> bytes:
    """A dictionary from at most most_rows texts of at most most_bytes."""
    import zstandard

    ids = smallest_hashes(docs.where("text is not null").select("doc_id"), "doc_id", most_rows)
    rows = docs.join(F.broadcast(ids), "doc_id").where(F.octet_length("text").between(64, most_bytes)).select("doc_id", "text").limit(2 * most_rows).collect()
    texts = [t.encode() for _, t in sorted((r["doc_id"], r["text"]) for r in rows)]
    try:
        return zstandard.train_dictionary(size, texts).as_bytes() if sum(map(len, texts)) > 20 * size else b""
    except zstandard.ZstdError:
        return b""


def _manifest(cut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, media, lists = as_bytes(batch.column("text")), [], []
            for text in texts:
                data = wav(payload_of(text))
                ends = cut(data)
                lists.append([digest(data[a:b]) for a, b in zip([0, *ends], ends)])
                media.append(digest(data))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(list(map(len, texts)), pa.int64()), pa.array(media, pa.binary()), pa.array(lists, pa.list_(pa.binary()))], names=["doc_id", "n_bytes", "media", "chunks"])

    return run


def _frames(dictionary: bytes, level: int, most_seen: int = 500_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, seen = Frames(dictionary, level).pack, set()
        for batch in batches:
            media, frames = [], []
            for text in as_bytes(batch.column("text")):
                data = wav(payload_of(text))
                name = digest(data)
                if name in seen:
                    continue
                if len(seen) < most_seen:
                    seen.add(name)
                media.append(name)
                frames.append(pack(data))
            yield pa.RecordBatch.from_arrays([pa.array(media, pa.binary()), pa.array(frames, pa.binary())], names=["media", "frame"])

    return run


#: Kinds of stored rows: a file's container (held: which chunks of its list it
#: holds, sizes: their lengths), and a pool chunk.
FILE, POOL = 0, 1
_STORED = "kind int, name binary, length long, chunks array<binary>, held array<int>, sizes array<int>, frame binary"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<binary>": pa.list_(pa.binary())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _store(cut, dictionary: bytes, level: int):
    """Store rows from plans (kind 0) and frames (kind 1), sorted by both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box, last, plan = Frames(dictionary, level), None, None
        for batch in batches:
            rows, size = [], 0
            cols = [batch.column(c) for c in ("media", "kind", "frame", "refs", "pooled")]
            for name, kind, frame, refs, pooled in zip(*(c.to_pylist() for c in cols)):
                if kind == 0:
                    plan = (name, set(refs or ()), set(pooled or ()))
                    continue
                if name == last:
                    continue
                last = name
                data = box.unpack(frame)
                ends = cut(data)
                parts = [data[a:b] for a, b in zip([0, *ends], ends)]
                lists, held = [digest(p) for p in parts], list(range(len(parts)))
                if plan and plan[0] == name:
                    held = [i for i in held if i not in plan[1] and i not in plan[2]]
                    rows += [(POOL, lists[i], len(parts[i]), None, None, None, box.pack(parts[i])) for i in sorted(plan[2])]
                    frame = box.pack(b"".join(parts[i] for i in held))
                rows.append((FILE, name, len(data), lists, held, [len(parts[i]) for i in held], frame))
                size += len(frame)
                if size > 4_000_000:
                    yield _batch(rows, _STORED)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, _STORED)

    return run


_READ = "media binary, payload_bytes long, n_chunks int, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _assembled(name: bytes, length: int, chunks: list[bytes], held: list[int], sizes: list[int], data: bytes, pool: dict[int, bytes]) -> tuple:
    """The row of a file put together from its list, its container's bytes and
    its pool chunks; an error if anything isn't what was written."""
    parts, at = dict(pool), 0
    for i, size in zip(held, sizes):
        parts[i], at = data[at : at + size], at + size
    for i, want in enumerate(chunks):
        if i not in parts or digest(parts[i]) != want:
            raise ValueError(f"chunk {i} of file {name.hex()} does not read back as it was written")
    media = b"".join(parts[i] for i in range(len(chunks)))
    if digest(media) != name or len(media) != length:
        raise ValueError(f"file {name.hex()} does not read back as it was written")
    payload = samples_of(media)
    return name, len(payload), len(chunks), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), feature(payload)


def _read_alone(dictionary: bytes):
    """Files whose containers hold all of their chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = Frames(dictionary, 3)
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("name", "length", "chunks", "held", "sizes", "frame")]
            rows = [_assembled(*own, box.unpack(frame), {}) for *own, frame in zip(*cols)]
            if rows:
                yield _batch(rows, _READ)

    return run


def _read_mixed(dictionary: bytes):
    """Files from rows sorted by (name, part): the file's container (part -1),
    then the pool chunks that it needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box, rows = Frames(dictionary, 3), []
        for file in groups(batches, ["name"]):
            head = file.slice(0, 1).to_pylist()[0]
            if head["part"] != -1:
                raise ValueError("chunks without their file")
            pool = {i: box.unpack(f) for i, f in zip(file.column("part").to_pylist()[1:], file.column("frame").to_pylist()[1:])}
            rows.append(_assembled(*(head[c] for c in ("name", "length", "chunks", "held", "sizes")), box.unpack(head["frame"]), pool))
            if len(rows) >= 500:
                yield _batch(rows, _READ)
                rows = []
        if rows:
            yield _batch(rows, _READ)

    return run


@dataclass
class Store:
    """manifest (doc_id, n_bytes, media, chunks): the rows' files and lists;
    rows (_STORED): containers and pool; shared (media, part, chunk): where lists
    refer to the pool; hot: files and chunks that hold many rows."""

    manifest: DataFrame
    rows: DataFrame
    shared: DataFrame
    dictionary: bytes
    hot_files: list
    hot_chunks: list


@shipped
def store(docs: DataFrame, *, bits: int = 10, least: int = 256, most: int = 8192, level: int = 9, sample: int = 1500) -> Store:
    """Every row of docs (doc_id, text) as a media file in a store of chunks."""
    cut = lambda data: cuts(data, bits, least, most)
    docs = docs.select("doc_id", "text")
    dictionary = train(docs, most_rows=sample)
    manifest = written(docs.mapInArrow(_manifest(cut), "doc_id long, n_bytes long, media binary, chunks array<binary>"), "media-manifest")

    # Owners of chunks: the first place of each digest among distinct files.
    files = manifest.groupBy("media").agg(F.first("chunks").alias("chunks"), F.count("*").alias("n"))
    places = files.select("media", F.posexplode("chunks").alias("part", "chunk"))
    first = F.min(F.struct("media", "part")).alias("first")
    owners = written(places.groupBy("chunk").agg(first, F.count("*").alias("n")).where("n > 1"), "media-owners")
    total = owners.agg(F.sum("n")).first()[0] or 0
    hot_chunks = hot_keys(owners, "chunk", "n", total)
    shared = join_unique(places, owners.select("chunk", "first"), "chunk", hot_chunks)
    shared = written(shared.select("media", "part", "chunk", (F.struct("media", "part") == F.col("first")).alias("own")), "media-shared")
    plans = shared.groupBy("media").agg(F.collect_list(F.when(~F.col("own"), F.col("part"))).alias("refs"), F.collect_list(F.when(F.col("own"), F.col("part"))).alias("pooled"))

    none = F.lit(None)
    frames = docs.mapInArrow(_frames(dictionary, level), "media binary, frame binary")
    sent = plans.select("media", F.lit(0).alias("kind"), none.cast("binary").alias("frame"), "refs", "pooled").union(
        frames.select("media", F.lit(1), "frame", none.cast("array<int>"), none.cast("array<int>"))
    )
    stored = sent.repartition("media").sortWithinPartitions("media", "kind").mapInArrow(_store(cut, dictionary, level), _STORED)
    rows = written(stored, "media-store", "none", ("kind",))
    hot_files = hot_keys(manifest.groupBy("media").agg(F.count("*").alias("n")), "media", "n", manifest.count())
    return Store(manifest, rows, shared.select("media", "part", "chunk"), dictionary, hot_files, hot_chunks)


@shipped
def _files(rows: DataFrame, shared: DataFrame, dictionary: bytes, hot_chunks: list) -> DataFrame:
    files = rows.where(F.col("kind") == FILE)
    alone = files.where(F.size("held") == F.size("chunks")).select("name", "length", "chunks", "held", "sizes", "frame").mapInArrow(_read_alone(dictionary), _READ)
    mixed = files.where(F.size("held") < F.size("chunks")).select("name", F.lit(-1).alias("part"), "length", "chunks", "held", "sizes", "frame")
    pool = rows.where(F.col("kind") == POOL).select(F.col("name").alias("chunk"), "frame")
    none = F.lit(None)
    needed = join_unique(shared, pool, "chunk", hot_chunks).select(
        F.col("media").alias("name"), "part", none.cast("long"), none.cast("array<binary>"), none.cast("array<int>"), none.cast("array<int>"), "frame"
    )
    joined = mixed.union(needed).repartition("name").sortWithinPartitions("name", "part").mapInArrow(_read_mixed(dictionary), _READ)
    return alone.union(joined)


def read(stored: Store) -> DataFrame:
    """Every row's file read back from the store: (doc_id, media, n_bytes) and
    the columns of _READ. A file that isn't what was written is an error."""
    files = written(_files(stored.rows, stored.shared, stored.dictionary, stored.hot_chunks), "media-read")
    return join_unique(stored.manifest.select("doc_id", "n_bytes", "media"), files, "media", stored.hot_files)


def store_and_read(docs: DataFrame, **options) -> DataFrame:
    """store() and read() of every row of docs (doc_id, text)."""
    return read(store(docs, **options))
