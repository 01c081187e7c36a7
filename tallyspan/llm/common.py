"""Helpers shared by the training-data operators: table access, the shared
folder for intermediate tables, and grouped iteration over Arrow batches."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.session import shared_dir

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Applications whose executors have this package.
_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application: their
    Python does not find it by the driver's path or working folder."""
    app, root = spark.sparkContext.applicationId, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if app in _SHIPPED or not os.path.isdir(root):
        return
    _SHIPPED.add(app)
    # Rows are whole texts: batches of the default 10,000 would be tens of MB on
    # both sides of each Python worker. A value that the user has set stays.
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, "1000")
    folder = tempfile.mkdtemp(prefix="tallyspan-code-")
    atexit.register(shutil.rmtree, folder, True)
    path = os.path.join(folder, "tallyspan_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for place, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(place, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)


def shipped(operator: Callable) -> Callable:
    """operator, with this package sent to the executors before it makes any of
    its functions for them (they take the list of what was sent when made)."""

    @functools.wraps(operator)
    def run(*args, **kwargs):
        for x in (*args, *kwargs.values()):
            if isinstance(x, DataFrame):
                ship_code(x.sparkSession)
                break
        return operator(*args, **kwargs)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paths of the tables written so far, by session; see drop_tables().
_WRITTEN: dict[str, list[str]] = {}


def written(df: DataFrame, name: str, compression: str = "zstd", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """df written to the shared folder as Parquet and read again: its lineage is
    cut, and a lost executor costs no recomputation of what lies before."""
    spark = df.sparkSession
    ship_code(spark)
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).partitionBy(*partition_by).parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    give_back()  # the driver's, with its hold on plans that are done
    return spark.read.schema(df.schema).parquet(path)


def table_mark(spark: SparkSession) -> int:
    return len(_WRITTEN.get(spark.sparkContext.applicationId, []))


def drop_tables(spark: SparkSession, since: int = 0, until: int | None = None) -> None:
    """Delete intermediate tables by their order of writing, once nothing that
    is still to run reads them."""
    paths = _WRITTEN.get(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for i in range(since, len(paths) if until is None else until):
        if paths[i]:
            where = jvm.org.apache.hadoop.fs.Path(paths[i])
            where.getFileSystem(conf).delete(where, True)
            paths[i] = ""


class Bitmap:
    """A set of ids as bits of their hashes: eight bits for each id, but 2**most
    bits (32 MB) at most, which bounds what is broadcast. Ids outside the set may
    seem inside (all do, once it is full), none inside seems outside, so it is
    only ever used to spare rows a shuffle before an exact join."""

    def __init__(self, ids: DataFrame, column: str, bits: int | None = None, most: int = 28) -> None:
        if bits is None:
            bits = min(most, max(16, (8 * ids.count()).bit_length()))
        self.column, self.bits = column, bits

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros(1 << (bits - 3), dtype=np.uint8)
            for batch in batches:
                at = self._at(batch.column(0).drop_null())
                np.bitwise_or.at(own, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
            words = own.view(np.int64)
            at = np.flatnonzero(words)
            for i in range(0, len(at), 100_000):
                part = at[i : i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(words[part])], names=["at", "word"])

        got = ids.select(F.col(column).cast("long")).mapInArrow(thrifty(run), "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
        words = np.zeros(1 << (bits - 6), dtype=np.int64)
        words[got.column("at").to_numpy()] = got.column("word").to_numpy()
        self.sent = ids.sparkSession.sparkContext.broadcast(words.view(np.uint8))

    def __getstate__(self) -> dict:
        return {"column": self.column, "bits": self.bits}

    def _at(self, ids: pa.Array) -> np.ndarray:
        h = ids.cast(pa.int64()).to_numpy(zero_copy_only=False).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def split(self, df: DataFrame, inside: bool) -> DataFrame:
        """Rows of df whose id may be inside, or those surely outside (null too)."""
        sent, at, column = self.sent, self._at, self.column

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(column)
                where = at(ids.fill_null(0))
                found = (sent.value[where >> 3] >> (where & 7).astype(np.uint8)) & 1 == 1
                found &= ids.is_valid().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(found if inside else ~found))

        return df.mapInArrow(thrifty(run), df.schema)


@shipped
def without_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """df without the rows whose id is in ids (column of that name). Rows surely
    outside are not shuffled; the rest meet the ids in an exact anti-join. Rows of a
    null id stay, null ids take nothing out; of repeated rows all stay or go."""
    gone = written(ids.select(column).where(F.col(column).isNotNull()).distinct(), "gone")
    bitmap = Bitmap(gone, column)
    return bitmap.split(df, False).union(bitmap.split(df, True).join(gone, column, "left_anti").select(*df.columns))


def thrifty(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, giving back its worker's free memory when a task ends."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def give_back() -> None:
    """Return a worker's free memory to the system at a task's end; the worker
    itself lives on, idle beside the next stages."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def smallest_hashes(df: DataFrame, key: str, most: int, rows: int | None = None) -> DataFrame:
    """The ``most`` rows of least hash of key (ties by key), from df of ``rows``
    rows (counted where not given). Rows above a hash below which nearly all of
    the sought lie are left out first, so few rows of each task meet in one. Null
    keys hash alike and sort first among equals; of rows with one key any may be
    the last; fewer rows than ``most``: all."""
    n = df.count() if rows is None else rows
    h = F.xxhash64(key)
    share = (most + 8 * most**0.5 + 64) / max(n, 1)
    if share < 1:
        below = df.where(h < int(-(1 << 63) + share * (1 << 64)))
        if below.count() >= most:
            df = below
    return df.orderBy(h, key).limit(most)


#: A key is hot where it holds more than this part of the rows, so there are at
#: most 1,000 hot keys.
HOT = 1 / 1000


def hot_keys(counts: DataFrame, key: str, n: str, total: int) -> list:
    """The keys of counts (key, n) that hold more than HOT of total rows."""
    return [r[0] for r in counts.where((F.col(n) > HOT * total) & F.col(key).isNotNull()).select(key).collect()]


def join_unique(df: DataFrame, other: DataFrame, key: str, hot: list, how: str = "inner") -> DataFrame:
    """df joined with other, which has one row for each key. Rows of hot keys
    stay where they are, as the few rows of other that they meet are broadcast.
    Null keys meet nothing (a left join keeps their rows); repeated rows of df each
    meet the one row of their key."""
    if not hot:
        return df.join(other, key, how)
    few = F.coalesce(F.col(key).isin(hot), F.lit(False))
    met = df.where(few).join(F.broadcast(other.where(few)), key, how)
    return df.where(~few).join(other.where(~few), key, how).unionByName(met)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column, null as empty, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def lower_ascii(text):
    """A-Z to a-z, all else unchanged (lower() would touch other letters)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, whole, from batches that come sorted by the
    keys. Memory: one group and one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*cols))
        start = 0
        for i, key in enumerate(rows):
            if last is not None and key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, start = [], i
            last = key
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
