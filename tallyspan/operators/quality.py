"""Data checks: every check counts the rows that break it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A row rule of one table; ``broken`` is true for rows that break it."""

    name: str
    broken: Column
    severity: str = "error"
    tags: tuple[str, ...] = ()


def not_null(column: str, **more) -> Check:
    return Check(f"not_null:{column}", F.col(column).isNull(), **more)


def accepted(column: str, values: Sequence, **more) -> Check:
    return Check(f"accepted:{column}", ~F.col(column).isin(*values), **more)


def in_range(column: str, least=None, most=None, **more) -> Check:
    low = F.lit(False) if least is None else F.col(column) < least
    return Check(f"range:{column}", low if most is None else low | (F.col(column) > most), **more)


def row_checks(df: DataFrame, checks: Sequence[Check], without_tag: str | None = None) -> DataFrame:
    """(check, severity, failing) of all row rules of a table in one scan."""
    run = [c for c in checks if without_tag is None or without_tag not in c.tags]
    counted = df.agg(*[F.count_if(F.coalesce(c.broken, F.lit(False))).alias(f"c{i}") for i, c in enumerate(run)])
    rows = F.array(*[F.struct(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), F.col(f"c{i}").alias("failing")) for i, c in enumerate(run)])
    return counted.select(F.inline(rows))


def unique(df: DataFrame, column: str, severity: str = "error") -> DataFrame:
    """Values (not null) that occur more than once."""
    often = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
    return often.agg(F.count("*").alias("failing")).select(F.lit(f"unique:{column}").alias("check"), F.lit(severity).alias("severity"), "failing")


def references(child: DataFrame, column: str, parent: DataFrame, parent_column: str, severity: str = "error") -> DataFrame:
    """Child rows whose key (not null) the parent lacks."""
    keys = parent.select(F.col(parent_column).alias("_key")).distinct()
    orphans = child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_key"), "left_anti")
    return orphans.agg(F.count("*").alias("failing")).select(F.lit(f"references:{column}").alias("check"), F.lit(severity).alias("severity"), "failing")


def none_of(df: DataFrame, name: str, severity: str = "error") -> DataFrame:
    """A check that df, the rows that break a rule, is empty."""
    return df.agg(F.count("*").alias("failing")).select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), "failing")


def exact_count(df: DataFrame, name: str, expected: int) -> DataFrame:
    """One row if the table has another number of rows, none if it fits."""
    return df.agg(F.count("*").alias("n")).where(F.col("n") != expected).select(F.lit(name).alias("check"), "n")


def denied_columns(tables: dict[str, DataFrame], denied: Sequence[str]) -> list[tuple[str, str]]:
    """(table, column) of published columns that must not be."""
    return [(t, c) for t, df in tables.items() for c in df.columns if c.lower() in set(denied)]


def failures(report: DataFrame) -> list[tuple[str, int]]:
    """Failed checks of severity error; warnings keep a build green."""
    return [(r["check"], r["failing"]) for r in report.where("failing > 0 and severity = 'error'").collect()]


def catalogue(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(table, column, type) of all tables and views that the session knows."""
    found = [t.name for t in spark.catalog.listTables(database)]
    where = lambda t: f"{database}.{t}" if database else t
    rows = [(t, c.name, c.dataType) for t in found for c in spark.catalog.listColumns(where(t))]
    return inline(spark, rows, "table string, column string, type string")


def denied_in_catalogue(spark: SparkSession, denied: Sequence[str], prefix: str = "", database: str | None = None) -> DataFrame:
    """Columns of the catalogue's tables whose names begin with prefix, that must
    not be published."""
    return catalogue(spark, database).where(F.col("table").startswith(prefix) & F.lower("column").isin(*denied))


def inline(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A relation of given rows, under a declared schema. Spark cannot tell its size,
    so a join would deal the other side by a key that has a few values here, each of
    them one task's; as the driver holds all rows already, it is sent to all tasks."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))
