"""Progress of a collection that can be resumed: a journal of JSON lines, one for
each change of a user's state, and the last line of a user is its state."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspan.collection.requests import Judge, JudgeError, NotFound
from tallyspan.sources.landing import safe_name, shard_of
from tallyspan.sources.sinks import json_lines_file

#: States of a user.
PENDING, DONE, SKIPPED, ERROR = "pending", "done", "skipped", "error"
#: Fixed format: a line of the journal.
LINE = "seq long, handle string, band string, rating int, state string, rows long, pages long, person_rows long, tries int, error string, at string"
LONGEST_ERROR = 500


class Journal:
    """The states of users, held by name, and every change appended to a file."""

    def __init__(self, path: str) -> None:
        self.path, self.users, self._seq = path, {}, 0
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        if os.path.exists(path):
            with open(path, "r+b") as f:
                whole = 0
                for line in f:
                    if line.endswith(b"\n"):
                        row = json.loads(line)
                        self.users[row["handle"]], self._seq = row, row["seq"] + 1
                        whole += len(line)
                f.truncate(whole)  # a torn last line is of a change that did not happen

    def _put(self, row: dict[str, Any]) -> None:
        row = row | {"seq": self._seq, "at": datetime.now(timezone.utc).isoformat(timespec="seconds")}
        with open(self.path, "a", encoding="utf-8") as f:
            f.write(json.dumps(row, ensure_ascii=False) + "\n")
        self.users[row["handle"]], self._seq = row, self._seq + 1

    def register(self, members: Iterable[tuple[str, str, int | None]]) -> int:
        """Adds users (handle, band, rating) that are not known yet; what is known
        of the others stays."""
        new = [m for m in members if m[0] not in self.users]
        for handle, band, rating in new:
            self._put({"handle": handle, "band": band, "rating": rating, "state": PENDING, "rows": 0, "pages": 0, "person_rows": 0, "tries": 0, "error": None})
        return len(new)

    def pending(self, per_band: int | None = None) -> Iterator[dict[str, Any]]:
        """Users to do, by band and name, at most per_band of a band."""
        taken: dict[str, int] = {}
        for row in sorted((r for r in self.users.values() if r["state"] == PENDING), key=lambda r: (r["band"], r["handle"])):
            taken[row["band"]] = taken.get(row["band"], 0) + 1
            if per_band is None or taken[row["band"]] <= per_band:
                yield row

    def done(self, handle: str, *, rows: int, pages: int, person_rows: int) -> None:
        self._put(self.users[handle] | {"state": DONE, "rows": rows, "pages": pages, "person_rows": person_rows, "error": None})

    def skipped(self, handle: str, reason: str) -> None:
        self._put(self.users[handle] | {"state": SKIPPED, "error": reason[:LONGEST_ERROR]})

    def failed(self, handle: str, reason: str) -> None:
        own = self.users[handle]
        self._put(own | {"state": ERROR, "tries": own["tries"] + 1, "error": reason[:LONGEST_ERROR]})

    def retry_errors(self) -> int:
        bad = [r for r in self.users.values() if r["state"] == ERROR]
        for row in bad:
            self._put(row | {"state": PENDING})
        return len(bad)


def states(spark: SparkSession, path: str) -> DataFrame:
    """The last line of each user of a journal."""
    lines = spark.read.schema(LINE).json(path)
    last = F.row_number().over(Window.partitionBy("handle").orderBy(F.desc("seq")))
    return lines.withColumn("_n", last).where("_n = 1").drop("_n")


def by_band(states: DataFrame) -> DataFrame:
    """Users, states and rows of each band, in one pass."""
    counts = [F.count_if(F.col("state") == s).alias(n) for s, n in ((DONE, "done"), (SKIPPED, "skipped"), (ERROR, "errors"))]
    return states.groupBy("band").agg(F.count("*").alias("total"), *counts, *[F.sum(c).alias(c) for c in ("rows", "person_rows", "pages")])


def is_person(attempt: dict[str, Any]) -> bool:
    """Whether one named user stands behind a raw attempt."""
    author = attempt.get("author") or {}
    members = author.get("members") or []
    return len(members) == 1 and not author.get("ghost") and bool(members[0].get("handle"))


def collect(judge: Judge, journal: Journal, root: str, *, page: int = 1000, per_band: int | None = None) -> int:
    """Fetches all pending users into the landing zone, a file each; a user that
    the judge does not know is skipped, one that failed may be tried again."""
    n = 0
    for user in list(journal.pending(per_band)):
        handle = user["handle"]
        try:
            pages = list(judge.attempts(handle, page))
        except NotFound as e:
            journal.skipped(handle, str(e))
            continue
        except JudgeError as e:
            journal.failed(handle, str(e))
            continue
        rows = [r for p in pages for r in p if isinstance(r, dict)]
        json_lines_file(rows, os.path.join(root, shard_of(handle), f"{safe_name(handle)}.jsonl.gz"))
        journal.done(handle, rows=len(rows), pages=len(pages), person_rows=sum(map(is_person, rows)))
        n += len(rows)
    return n
