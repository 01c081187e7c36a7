"""Checks of a landing zone that a reader can not make for itself. These list
files on the driver, as the reader's own planning does, by Spark's file systems
where a session is given (any store that Spark reads), else on the local disk."""

from __future__ import annotations

import hashlib
import json
import os
import re
import time
import urllib.parse
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.sources import store

#: Characters that stay in a file's name; the others are per cent coded.
_SAFE = re.compile(r"[^A-Za-z0-9._-]")


def shard_of(name: str) -> str:
    """The folder of a name: two digits of its sha1, as columns.shard has it."""
    return hashlib.sha1(name.encode()).hexdigest()[:2]


def safe_name(name: str) -> str:
    """A file name that no reader hides: a leading underscore or dot is coded."""
    coded = _SAFE.sub(lambda m: urllib.parse.quote(m[0], safe=""), name)
    return f"%{ord(coded[0]):02X}{coded[1:]}" if coded[:1] in ("_", ".") else coded


def shard_globs(root: str, shards: Iterable[str] | None = None, pattern: str = "*.jsonl.gz") -> list[str]:
    """Globs of all shards or of the named ones (pruning by hand)."""
    return [f"{root}/{s}/{pattern}" for s in shards] if shards else [f"{root}/*/{pattern}"]


def listed(root: str, spark: SparkSession | None = None) -> list[str]:
    """All files below a root, hidden ones too."""
    if spark is None:
        return sorted(os.path.join(d, n) for d, _, names in os.walk(root) for n in names)
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found, out = fs.listFiles(where, True), []
    while found.hasNext():
        out.append(found.next().getPath().toString())
    return sorted(out)


def _hides(path: str) -> bool:
    name = path.rsplit("/", 1)[-1]
    return name[:1] in ("_", ".") and not name.endswith(".crc")


def hidden_files(root: str, spark: SparkSession | None = None) -> list[str]:
    """Files that Spark's readers would skip without a word: names that begin
    with an underscore or a dot."""
    return [f for f in listed(root, spark) if _hides(f)]


def audited(root: str, spark: SparkSession | None = None) -> int:
    """The number of visible files; an error if some are hidden."""
    files = listed(root, spark)
    if bad := [f for f in files if _hides(f)]:
        raise ValueError(f"{len(bad)} files would be skipped by the reader, first {bad[0]}")
    return len([f for f in files if not f.endswith(".crc")])


def landing_changed(root: str, report_path: str, spark: SparkSession | None = None, field: str = "files_on_disk") -> bool:
    """Whether the zone holds another number of files than the last report says
    (true if there is no report). A zone that is missing or empty is an error: a
    wrong path would else look like a change for ever. See ledger for changes by
    file."""
    if not store.exists(root, spark):
        raise FileNotFoundError(f"no landing zone at {root}")
    files = audited(root, spark)
    if not files:
        raise FileNotFoundError(f"the landing zone at {root} is empty")
    return not store.exists(report_path, spark) or json.loads(store.read(report_path, spark)).get(field) != files


def renames(root: str, suffix: str = ".jsonl.gz") -> dict[str, str]:
    """New paths of hidden files, under names that readers see."""
    return {f: os.path.join(os.path.dirname(f), safe_name(os.path.basename(f))) for f in hidden_files(root) if f.endswith(suffix)}


def migrate(root: str, *, apply: bool = False, force: bool = False, quiet_seconds: float = 120.0) -> dict[str, str]:
    """Renames hidden files; again, it finds none. Errors, before anything is
    renamed: a new name is taken, or files were written a moment ago (force goes
    on all the same). Without apply, only says what it would do."""
    plan = renames(root)
    if taken := [t for t in plan.values() if os.path.exists(t)]:
        raise FileExistsError(f"{len(taken)} names are taken, first {taken[0]}")
    if plan and apply:
        late = time.time() - quiet_seconds
        if not force and any(os.path.getmtime(f) > late for f in listed(root)):
            raise RuntimeError("files were written a moment ago; is a collection running?")
        for old, new in plan.items():
            os.rename(old, new)
    return plan


def lines_by_file(spark: SparkSession, files: Sequence[str]) -> dict[str, int]:
    """The number of lines that are not blank of each file, by one job over all."""
    if not files:
        return {}
    counts = spark.read.text(list(files)).where("trim(value) <> ''").groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
    # Rows name their files as URIs, whose odd letters are coded once more.
    found = {_bare(urllib.parse.unquote(r.path)): r.n for r in counts.toLocalIterator()}
    return {f: found.get(_bare(f), 0) for f in files}


def _bare(path: str) -> str:
    """A path without its scheme and machine."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "", path)


def unread_files(files: Iterable[str], rows: DataFrame, name_column: str) -> list[str]:
    """Files without rows. One line or less (a header) is an empty file and is
    returned; more lines mean that rows were lost, which is an error. All files
    that no row names are counted by one job."""
    seen = {r[0] for r in rows.select(name_column).distinct().toLocalIterator()}
    missing = [f for f in sorted(files) if f.rsplit("/", 1)[-1] not in seen]
    lines = lines_by_file(rows.sparkSession, missing)
    if lost := [f for f in missing if lines[f] > 1]:
        raise ValueError(f"{lost[0]} has rows, and none was read")
    return missing


def corpus_counts(attempts: DataFrame) -> dict[str, int]:
    """Distinct attempts by id, and how many are of one person (team of one, or
    no team), from raw rows that may repeat an id."""
    members = F.coalesce(F.size("author.members"), F.lit(0))
    per = attempts.groupBy("id").agg(F.min(members).alias("members"), F.max(F.col("author.teamId").isNotNull()).alias("team"))
    row = per.agg(F.count("*").alias("attempts"), F.count_if(~F.col("team") | (F.col("members") == 1)).alias("one_person")).first()
    return row.asDict()


def name_of(path: str, suffix: str = ".jsonl.gz") -> str:
    """The name that a file is of, as readers.file_stem has it."""
    return urllib.parse.unquote(path.rsplit("/", 1)[-1].removesuffix(suffix))


def files_with_rows(spark: SparkSession, files: Iterable[str], seen: set[str], suffix: str = ".jsonl.gz") -> tuple[int, list[str]]:
    """How many files hold rows, and which of these none of the names seen is of:
    only files that no row names are looked into, by one job."""
    files = sorted(files)
    missing = [f for f in files if name_of(f, suffix) not in seen]
    lines = lines_by_file(spark, missing)
    unseen = [f for f in missing if lines[f]]
    return len(files) - len(missing) + len(unseen), unseen


def counted_corpus(attempts: DataFrame, files: Iterable[str], name_column: str, suffix: str = ".jsonl.gz") -> dict[str, int]:
    """corpus_counts() of rows that carry their file's name; an error where a file
    with rows was not read at all."""
    seen = {r[0] for r in attempts.select(name_column).distinct().toLocalIterator()}
    _, gap = files_with_rows(attempts.sparkSession, files, seen, suffix)
    if gap:
        raise ValueError(f"{len(gap)} files have rows, and none was read, first {gap[0]}")
    return corpus_counts(attempts) | {"files": len(seen)}
