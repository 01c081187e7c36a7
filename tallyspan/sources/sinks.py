"""Sinks: partitioned and sorted Parquet, small JSON results, manifests."""

from __future__ import annotations

import gzip
import json
import os
import tempfile
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.sources import store


def lake(df: DataFrame, path: str, partition: str, codec: str = "snappy") -> None:
    """Parquet in folders by a column. A rebalance puts a folder's rows together
    and, by the sizes that adaptive execution finds, splits those of a large
    folder over as many tasks as it needs (spark.sql.adaptive
    .advisoryPartitionSizeInBytes each) and joins small ones."""
    df.hint("rebalance", partition).write.mode("overwrite").option("compression", codec).partitionBy(partition).parquet(path)


def lake_parts(df: DataFrame, path: str, partition: str, codec: str = "snappy") -> None:
    """Parquet in folders by a column, where only the folders that df has rows for
    are replaced and all others stay."""
    df.hint("rebalance", partition).write.mode("overwrite").options(compression=codec, partitionOverwriteMode="dynamic").partitionBy(partition).parquet(path)


def missing_parts(df: DataFrame, path: str, partition: str, codec: str = "snappy") -> None:
    """Adds the folders that are not there yet; those that are, stay as they are."""
    if store.exists(path, df.sparkSession):
        there = df.sparkSession.read.parquet(path).select(F.col(partition).alias("_there")).distinct()
        df = df.join(there, F.col(partition).eqNullSafe(F.col("_there")), "left_anti")
    df.hint("rebalance", partition).write.mode("append").option("compression", codec).partitionBy(partition).parquet(path)


def beside(path: str) -> str:
    """A new folder next to another."""
    return f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"


def sorted_slice(df: DataFrame, path: str, order: Sequence[str], codec: str = "zstd") -> None:
    """Parquet under a total order over all files: ranges are written side by
    side, each sorted, which also lets equal values compress well."""
    df.orderBy(*order).write.mode("overwrite").option("compression", codec).parquet(path)


def json_lines(df: DataFrame, path: str) -> None:
    """A snapshot as lines of JSON, compressed."""
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def write_json(path: str, value: Any, spark: SparkSession | None = None) -> None:
    """JSON in one piece, so no reader sees a part; see store for paths."""
    store.write(path, (json.dumps(value, indent=2, sort_keys=False, default=str, ensure_ascii=False) + "\n").encode(), spark)


def report(folder: str, name: str, counts: dict[str, Any], spark: SparkSession | None = None) -> str:
    path = store.join(folder, f"{name}_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}.json")
    write_json(path, counts, spark)
    return path


def described(df: DataFrame) -> list[list[str]]:
    return [[c, t] for c, t in df.dtypes]


def artefact(spark: SparkSession, path: str) -> dict[str, Any]:
    """Rows and schema of a Parquet artefact; the count reads footers only."""
    df = spark.read.parquet(path)
    return {"rows": df.count(), "schema": described(df)}


def _manifests(path: str) -> tuple[str, str]:
    return f"{path.rstrip('/')}.manifest.json", store.join(path, "_manifest.json")


def write_manifest(path: str, manifest: dict[str, Any], spark: SparkSession | None = None) -> tuple[str, str]:
    """The manifest beside an artefact, and the same bytes as a sidecar inside its
    folder, under a name that readers of the folder skip."""
    near, sidecar = _manifests(path)
    write_json(near, manifest, spark)
    store.write(sidecar, store.read(near, spark), spark)
    return near, sidecar


def sidecar_differences(path: str, spark: SparkSession | None = None) -> list[str]:
    """What is wrong with an artefact's manifest and sidecar: one is missing, or
    they are not the same bytes."""
    names = _manifests(path)
    out = [f"no {n}" for n in names if not store.exists(n, spark)]
    if not out and store.read(names[0], spark) != store.read(names[1], spark):
        out.append("manifest and sidecar differ")
    return out


def verify_artefact(spark: SparkSession, path: str, content: bool = False) -> list[str]:
    """What differs between an artefact, read from its footers, and the rows and
    schema that its manifest promises; also of manifest and sidecar. With content,
    the rows are read, and the promised digests compared too."""
    out, near = sidecar_differences(path, spark), _manifests(path)[0]
    if store.exists(near, spark):
        promised = json.loads(store.read(near, spark))
        found = artefact(spark, path)
        if content and "digest" in promised:
            groups = {k: v["columns"] for k, v in promised["digest"].items()}
            found["digest"] = digests(spark.read.parquet(path), groups)
        out += manifest_differences({k: promised.get(k) for k in found}, found)
    return out


def content_digest(df: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """One row: the number of rows, and for each group of columns a digest of its
    content that no order of rows, columns of other groups, files or codecs change:
    the sum over rows of 60 bits of an md5, as text. Sums are of decimals, which
    hold 10**20 rows. Null and empty differ; of numbers the text form counts."""
    of = lambda columns: F.conv(F.substring(F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])), 1, 15), 16, 10)
    sums = [F.coalesce(F.sum(of(columns).cast("decimal(28,0)")), F.lit(0)).cast("string").alias(name) for name, columns in groups.items()]
    return df.agg(F.count("*").alias("rows"), *sums)


def digests(df: DataFrame, groups: dict[str, Sequence[str]] | None = None) -> dict[str, dict[str, Any]]:
    """content_digest() as a manifest has it; each column is a group by itself
    where none are named, so a difference names its column, and all columns one."""
    groups = groups or {c: [c] for c in df.columns} | {"(row)": df.columns}
    names = {f"g{i}": list(columns) for i, columns in enumerate(groups.values())}
    row = content_digest(df, names).first()
    return {k: {"columns": list(columns), "sum": row[f"g{i}"]} for i, (k, columns) in enumerate(groups.items())}


def stale_content(spark: SparkSession, committed: str, fresh: str) -> list[str]:
    """What differs in content between two artefacts, whatever their files: rows,
    schema, and the columns whose values are not the same."""
    a, b = spark.read.parquet(committed), spark.read.parquet(fresh)
    out = schema_differences(described(a), described(b))
    if out:
        return out
    x, y = digests(a), digests(b)
    return [f"content of {k}" for k in x if x[k] != y[k]]


def json_lines_file(rows: list[dict[str, Any]], path: str) -> None:
    """Records as one compressed file of JSON lines, by way of a temporary file
    and a rename: for results small enough for the driver."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    fd, temporary = tempfile.mkstemp(dir=os.path.dirname(path) or ".", suffix=".tmp")
    with os.fdopen(fd, "wb") as raw, gzip.open(raw, "wt", encoding="utf-8") as f:
        for row in rows:
            f.write(json.dumps(row, ensure_ascii=False, sort_keys=True, default=str) + "\n")
    os.replace(temporary, path)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    """df under a name of this session."""
    df.createOrReplaceTempView(name)
    return df


#: How a layer's results are kept: views are computed when read, tables once.
MATERIALISED = {"staging": "view", "marts": "table"}


def materialise(df: DataFrame, name: str, layer: str) -> DataFrame:
    """df as its layer's policy keeps it: a view of the session, or a Parquet
    table of the catalogue, replaced whole."""
    if MATERIALISED[layer] == "view":
        return temp_view(df, name)
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def schema_differences(expected: list[list[str]], found: list[list[str]]) -> list[str]:
    """Missing, extra, retyped and reordered columns, by name."""
    was, now = dict(map(tuple, expected)), dict(map(tuple, found))
    out = [f"missing {c}" for c in was if c not in now] + [f"extra {c}" for c in now if c not in was]
    out += [f"retyped {c}: {was[c]} to {now[c]}" for c in was if c in now and was[c] != now[c]]
    if not out and [c for c, _ in expected] != [c for c, _ in found]:
        out.append("reordered columns")
    return out


def manifest_differences(expected: dict[str, Any], found: dict[str, Any]) -> list[str]:
    """What differs between two manifests; schema lists column by column."""
    out = []
    for key in sorted(expected.keys() | found.keys()):
        a, b = expected.get(key), found.get(key)
        if key == "schema":
            out += schema_differences(a or [], b or [])
        elif a != b:
            out.append(f"{key}: {a} to {b}")
    return out
