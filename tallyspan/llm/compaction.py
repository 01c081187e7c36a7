"""Executed bin-packed compaction: small files of a Parquet table become few.

``write_files`` lays a table out in files: rows go by day of a time column, and
within a day by a hash of an id into lots and pieces, one file each, whose size
follows the table's. ``compact`` then joins a day's small files by first fit of
falling sizes and executes the result: each group of several files is rewritten
as one, rows in joining order, and the others stay byte for byte.

First fit asks for the earliest group with room for a file. A day's groups are
held as a bit-sliced index of their residual room: one large integer for each bit
of the room, whose bit g belongs to group g. Comparing all groups with a size is
a walk over these planes from the highest bit down ("greater so far" and "equal so
far" are integers too), and the lowest set bit of the outcome is the group. So a
file costs a few operations on integers of as many bits as there are groups.

At scale. A file is at most some 1/450 of the table and a day has at most 804, so
the plan of a day (a row for each file) is small whatever the table's size, and
each day's is made by a task of its own. Rows find the size of their day by a join
on (day, salt), so a day of a third of all rows meets over SALTS tasks; then one
shuffle puts each file's rows together, sorted by external sort and streamed to
its file. Rewriting reads the small files alone. The driver sees file names and
moves files, no rows; files that are rewritten are written aside as one job, and
only then take the places of their sources, so a lost executor costs a task, and
a run that fails before that leaves the old files whole.

Edge cases. A null time: a day of its own (null), in a folder of its own. Null
ids: hashed as the empty text, sorted first, and empty words in digests. Rows
repeated or with equal sort keys: all kept, in any order among themselves. Ties of
files in rows: by lot, then piece. No rows: no files. Extra columns: written as they
are, whatever their names; folders are named so that none clashes with a column.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm.common import shipped, thrifty, written
from tallyspan.session import shared_dir

#: Parts of a day's rows when they look up their day's size.
SALTS = 64
_PLAN = "day long, lot long, piece long, n long, grp long, pos long, files long"


def share(rows: int, parts: int) -> int:
    """S(parts): one more than a part of the table's rows."""
    return 1 + rows // parts


class RoomIndex:
    """Residual room of groups, bit by bit: plane k holds bit k of every group."""

    def __init__(self, most: int) -> None:
        self.groups, self.planes = 0, [0] * max(most.bit_length(), 1)

    def open(self, room: int) -> int:
        g = self.groups
        self.groups += 1
        self._flip(g, room)
        return g

    def first_with(self, size: int) -> int | None:
        """The earliest group with room for size."""
        if size >> len(self.planes):
            return None
        greater, equal = 0, (1 << self.groups) - 1
        for k in range(len(self.planes) - 1, -1, -1):
            if size >> k & 1:
                equal &= self.planes[k]
            else:
                greater |= equal & self.planes[k]
                equal &= ~self.planes[k]
        fits = greater | equal
        return (fits & -fits).bit_length() - 1 if fits else None

    def room(self, group: int) -> int:
        return sum((p >> group & 1) << k for k, p in enumerate(self.planes))

    def take(self, group: int, size: int) -> None:
        room = self.room(group)
        self._flip(group, room ^ (room - size))

    def _flip(self, group: int, bits: int) -> None:
        for k in range(len(self.planes)):
            if bits >> k & 1:
                self.planes[k] ^= 1 << group


def first_fit(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """(group, place in it) of each size in turn; a size above most opens a group
    that takes no other."""
    index, count, out = RoomIndex(most), [], []
    for size in sizes:
        g = index.first_with(size)
        if g is None:
            g = index.open(max(most - size, 0))
            count.append(0)
        else:
            index.take(g, size)
        out.append((g, count[g]))
        count[g] += 1
    return out


def plan(files: DataFrame, small: int, most: int) -> DataFrame:
    """files (day, lot, piece, n) with their group, place in it and the number of
    files of the group; files of ``small`` rows or more have none (null, 0, 1)."""

    def run(day: pd.DataFrame) -> pd.DataFrame:
        day = day.sort_values(["n", "lot", "piece"], ascending=[False, True, True], ignore_index=True)
        own = (day["n"] < small).to_numpy()
        got = np.array(first_fit(day["n"][own].tolist(), most), np.int64).reshape(-1, 2)
        group, pos, files = np.full(len(day), -1), np.zeros(len(day), np.int64), np.ones(len(day), np.int64)
        group[own], pos[own] = got[:, 0], got[:, 1]
        files[own] = np.bincount(got[:, 0], minlength=1)[got[:, 0]] if len(got) else []
        return pd.DataFrame({"day": day["day"].astype("Int64"), "lot": day["lot"], "piece": day["piece"], "n": day["n"], "grp": group, "pos": pos, "files": files})

    return files.select("day", "lot", "piece", "n").groupBy("day").applyInPandas(run, _PLAN).withColumn("grp", F.nullif("grp", F.lit(-1)))


def free_names(columns: list[str], names: tuple[str, ...]) -> list[str]:
    """names, each with as many x put to it as keep it off the columns."""
    taken, out = {c.lower() for c in columns}, []
    for n in names:
        while n in taken:
            n += "x"
        out.append(n)
    return out


def day_of(at: Column) -> Column:
    """Whole days since 1970 of a time without a zone (or of one in UTC)."""
    return F.datediff(F.to_date(at), F.lit("1970-01-01").cast("date")).cast("long")


@shipped
def write_files(df: DataFrame, folder: str, *, at: str, key: str, rows: int) -> None:
    """df of ``rows`` rows in one file for each day, lot and piece that occurs."""
    columns = df.columns
    day, lot, piece, salt, h, r = free_names(columns, ("day", "lot", "piece", "salt", "hashed", "dayrows"))
    keyed = df.select("*", F.coalesce(day_of(F.col(at)), F.lit(_NULL_DAY)).alias(day), F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")).alias(h))
    sizes = keyed.groupBy(day).agg(F.count("*").alias(r)).select(day, r, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(salt))
    met = keyed.withColumn(salt, (F.col(h) % SALTS).cast("int")).join(sizes, [day, salt])
    low = lambda k: F.shiftright(h, k).bitwiseAND(F.lit(3))
    places = {day: F.nullif(F.col(day), F.lit(_NULL_DAY)), lot: F.shiftright(h, 4) % F.expr(f"1 + {r} div {share(rows, 200)}"), piece: F.least(low(0), low(2))}
    placed = met.select(*[F.col(f"`{c}`") for c in columns], *[c.alias(n) for n, c in places.items()])
    placed.repartition(day, lot, piece).sortWithinPartitions(day, lot, piece, at, key).write.partitionBy(day, lot, piece).parquet(folder)


#: Stands for a null day in joins; no time that Spark holds is of that day.
_NULL_DAY = -(1 << 40)
_NULL_NAME = "__HIVE_DEFAULT_PARTITION__"


def opened(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files' own columns, and in ``_at`` each row's file, its place there,
    and the file's day, lot and piece by the names of its folders."""
    path = F.col("_metadata.file_path")
    number = lambda k: F.nullif(F.regexp_extract(path, "/[^/=]+=([^/]*)/[^/=]+=([^/]*)/[^/=]+=([^/]*)/[^/]+$", k), F.lit(_NULL_NAME)).cast("long")
    at = {"day": number(1), "lot": number(2), "piece": number(3), "path": path, "row": F.col("_metadata.row_index")}
    return spark.read.option("recursiveFileLookup", True).parquet(*paths).select("*", F.struct(*[c.alias(n) for n, c in at.items()]).alias("_at"))


def _names(spark: SparkSession, folder: str) -> list[str]:
    """The data files of a folder, as Spark's own listing has them."""
    jvm = spark._jvm
    found = spark.read.option("recursiveFileLookup", True).parquet(folder).inputFiles()
    return [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)).toString() for name in found]


def _place(path: str) -> tuple[int | None, ...]:
    """(day, lot, piece) of a file by the names of its folders."""
    values = (x.rsplit("=", 1)[1] for x in path.split("/")[-4:-1])
    return tuple(None if v == _NULL_NAME else int(v) for v in values)


def _same(a: str, b: str, *columns: str) -> Column:
    """Null-safe equality, as a day may be null."""
    return reduce(Column.__and__, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns])


def compact(spark: SparkSession, folder: str, *, rows: int) -> DataFrame:
    """Joins the small files of write_files() in place, and returns the plan that
    was executed, one row for each file that there was."""
    data = opened(spark, [folder])
    own = [c for c in data.columns if c != "_at"]
    files = data.groupBy("_at.day", "_at.lot", "_at.piece").agg(F.count("*").alias("n"))
    done = written(plan(files, share(rows, 750), share(rows, 400)), "compaction-plan")
    several = done.where("files > 1")
    lead = several.where("pos = 0").select("day", "grp", F.col("lot").alias("to_lot"), F.col("piece").alias("to_piece"))
    moves = several.alias("s").join(lead.alias("l"), _same("s", "l", "day", "grp")).select("s.day", "s.lot", "s.piece", "s.pos", "to_lot", "to_piece")
    parts = {tuple(r) for r in several.select("day", "lot", "piece").collect()}
    old = [n for n in _names(spark, folder) if _place(n) in parts]
    if not old:
        return done
    day, lot, piece, pos, row = free_names(own, ("day", "lot", "piece", "pos", "row"))
    new = {day: "m.day", lot: "to_lot", piece: "to_piece", pos: "m.pos", row: "d.row"}
    sources = opened(spark, old).select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)], "_at.*")
    met = sources.alias("d").join(moves.alias("m"), _same("d", "m", "day", "lot", "piece"))
    out = met.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(own)], *[F.col(c).alias(n) for n, c in new.items()])
    aside = f"{folder.rstrip('/')}/_joined-{uuid.uuid4().hex}"
    out.repartition(day, lot, piece).sortWithinPartitions(day, lot, piece, pos, row).drop(pos, row).write.partitionBy(day, lot, piece).parquet(aside)
    _swap(spark, folder, old, aside)
    return done


def _swap(spark: SparkSession, folder: str, old: list[str], aside: str) -> None:
    """Files written aside take the places of their first sources; the sources go
    last, those of other places with their folders."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    new = {"/".join(name.split("/")[-4:-1]): name for name in _names(spark, aside)}
    for place, name in new.items():
        if not fs.rename(path(name), path(f"{folder.rstrip('/')}/{place}/{name.rsplit('/', 1)[1]}")):
            raise OSError(f"could not move {name}")
    for name in old:
        inside = "/".join(name.split("/")[-4:-1]) in new
        fs.delete(path(name if inside else name.rsplit("/", 1)[0]), not inside)
    fs.delete(path(aside), True)


_FILE = "day long, lot long, piece long, n_rows long, min_click_id long, max_click_id long, cents long, ids_sha256 string"


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and digest of each file from rows (day, lot, piece, id, cents) that
    come file by file; of a file only these are held, never its rows."""
    schema = pa.schema([(n, pa.string() if n == "ids_sha256" else pa.int64()) for n in (x.split()[0] for x in _FILE.split(", "))])
    place, s, digest = None, {}, None

    def done() -> pa.RecordBatch:
        row = dict(zip(("day", "lot", "piece"), place)) | s | {"ids_sha256": digest.hexdigest()}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        at = [batch.column(k).to_pylist() for k in ("day", "lot", "piece")]
        places = list(zip(*at))
        starts = [i for i in range(len(places)) if not i or places[i] != places[i - 1]]
        for i, j in zip(starts, [*starts[1:], len(places)]):
            if places[i] != place:
                if digest:
                    yield done()
                place, digest = places[i], hashlib.sha256()
                s = {"n_rows": 0, "min_click_id": None, "max_click_id": None, "cents": 0}
            ids = batch.column("id").slice(i, j - i)
            words = pc.fill_null(ids.cast(pa.string()), "").to_pylist()
            digest.update((("," if s["n_rows"] else "") + ",".join(words)).encode())
            ends = pc.min_max(ids).as_py()
            for k, f in (("min", min), ("max", max)):
                known = [x for x in (s[f"{k}_click_id"], ends[k]) if x is not None]
                s[f"{k}_click_id"] = f(known) if known else None
            s["n_rows"] += j - i
            s["cents"] += pc.sum(batch.column("cents").slice(i, j - i)).as_py()
    if digest:
        yield done()


@shipped
def described_files(done: DataFrame, folder: str, *, key: str, value: str) -> DataFrame:
    """One row for each file as it now stands, from its rows read again in file
    order, with the starting files that it holds by the executed plan ``done``."""
    rows = opened(done.sparkSession, [folder])
    columns = ",".join(c for c in rows.columns if c != "_at")
    cents = F.coalesce(F.floor(F.lit(100.0) * F.col(value).cast("double") + 0.5), F.lit(0)).cast("long")
    thin = rows.select("_at.day", "_at.lot", "_at.piece", "_at.row", F.col(key).cast("long").alias("id"), cents.alias("cents"))
    by_file = ["day", "lot", "piece"]
    found = thin.repartition(*by_file).sortWithinPartitions(*by_file, "row").mapInArrow(thrifty(_sums), _FILE)
    paths = rows.groupBy("_at.day", "_at.lot", "_at.piece").agg(F.min("_at.path").alias("path"))
    group = F.coalesce(F.col("grp").cast("string"), F.concat_ws("-", F.lit("own"), "lot", "piece"))
    held = done.groupBy("day", group.alias("made")).agg(F.array_sort(F.collect_list(F.struct("pos", "lot", "piece"))).alias("s"))
    names = F.transform("s", lambda x: F.concat_ws("-", x["lot"], x["piece"]))
    held = held.select("day", F.col("s")[0]["lot"].alias("lot"), F.col("s")[0]["piece"].alias("piece"), F.array_join(names, ",").alias("sources"), (F.size("s") > 1).alias("rewritten"))
    met = found.alias("f").join(held.alias("h"), _same("f", "h", *by_file)).join(paths.alias("p"), _same("f", "p", *by_file))
    return met.select("f.*", "sources", F.lit(columns).alias("columns"), "path", "rewritten")


@shipped
def written_and_compacted(df: DataFrame, *, at: str, key: str, value: str) -> DataFrame:
    """A table written to a new folder of the shared one, compacted there, and its
    files as they then stand. The folder stays."""
    spark = df.sparkSession
    folder, rows = f"{shared_dir(spark)}/compacted/{uuid.uuid4().hex}", df.count()
    if not rows:
        return spark.createDataFrame([], f"{_FILE}, sources string, columns string, path string, rewritten boolean")
    write_files(df, folder, at=at, key=key, rows=rows)
    return described_files(compact(spark, folder, rows=rows), folder, key=key, value=value)
