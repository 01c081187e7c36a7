"""Publishing of small aggregate tables, behind gates that read only files."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.sources import store
from tallyspan.sources.sinks import write_json


@dataclass(frozen=True)
class Publication:
    """What a table may show: these columns, in this order, sorted by a total
    order (a minus before a name: falling); statistics are null in cells of fewer than ``least`` members."""

    columns: tuple[str, ...]
    order: tuple[str, ...]
    caveat: str = ""
    count: str | None = None
    statistics: tuple[str, ...] = ()
    least: int = 5
    most_rows: int = 100_000
    tags: dict[str, Any] = field(default_factory=dict)


def allowed(df: DataFrame, rule: Publication) -> DataFrame:
    """df in the rule's shape; an error if its columns are not exactly these."""
    if extra := set(df.columns) - set(rule.columns):
        raise ValueError(f"columns that may not be published: {sorted(extra)}")
    if lacking := set(rule.columns) - set(df.columns):
        raise ValueError(f"columns that are lacking: {sorted(lacking)}")
    order = [F.col(c[1:]).desc_nulls_last() if c[0] == "-" else F.col(c).asc_nulls_last() for c in rule.order]
    return df.select(*rule.columns).orderBy(*order)


def export(df: DataFrame, name: str, folder: str, rule: Publication) -> str:
    """The table as one JSON file. Published tables are aggregates; one of more
    than most_rows rows is refused, not cut."""
    rows = allowed(df, rule).limit(rule.most_rows + 1).collect()
    if len(rows) > rule.most_rows:
        raise ValueError(f"{name} has more than {rule.most_rows} rows")
    path = store.join(folder, f"{name}.json")
    write_json(path, {"table": name, "caveat": rule.caveat, "columns": list(rule.columns), "row_count": len(rows), "rows": [r.asDict() for r in rows]}, df.sparkSession)
    return path


def verify(folder: str, rules: dict[str, Publication], denied: Sequence[str] = (), equal_sums: Sequence[tuple[str, str]] = (), spark: SparkSession | None = None) -> list[str]:
    """What is wrong with the files of a folder, read by themselves (without a
    session from the local disk, else from any store): shape, denied names, statistics of small cells, and counts that must add up alike."""
    out, sums = [], {}
    for name, rule in rules.items():
        path = store.join(folder, f"{name}.json")
        if not store.exists(path, spark):
            out.append(f"{name}: no file")
            continue
        table = json.loads(store.read(path, spark))
        if table["columns"] != list(rule.columns):
            out.append(f"{name}: columns differ from the rule")
        if not str(table.get("caveat") or "").strip():
            out.append(f"{name}: no caveat")
        if table["row_count"] != len(table["rows"]):
            out.append(f"{name}: row_count is wrong")
        for row in table["rows"]:
            if set(row) != set(rule.columns):
                out.append(f"{name}: a row has other columns")
            if bad := [c for c in row if c.lower() in denied]:
                out.append(f"{name}: denied {bad[0]}")
            if rule.count and row[rule.count] < rule.least and any(row[c] is not None for c in rule.statistics):
                out.append(f"{name}: a cell of {row[rule.count]} has statistics")
        if rule.count:
            sums[name] = sum(r[rule.count] for r in table["rows"])
    out += [f"{a} and {b} count different populations" for a, b in equal_sums if sums.get(a) != sums.get(b)]
    return out


def stale(folder: str, fresh: str, names: Sequence[str], spark: SparkSession | None = None) -> list[str]:
    """Tables whose committed file is not, byte for byte, what a fresh run wrote."""
    of = lambda d, n: store.read(store.join(d, f"{n}.json"), spark)
    return [n for n in names if of(folder, n) != of(fresh, n)]
