"""Column builders. Each takes and returns Columns, so Catalyst sees plain
expressions that it can push down, fold and compile; there are no UDFs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The opening of every first version: earlier than any event.
OPENING = "1970-01-01"


def mapped(value: Column, table: Mapping[str, str], default: str, on_null: str | None = None) -> Column:
    """Dictionary lookup; unknown values give default, null gives on_null (or
    default). A value that a source adds later so never joins a known class."""
    entries = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    found = F.coalesce(F.try_element_at(entries, value), F.lit(default))
    return F.when(value.isNull(), F.lit(default if on_null is None else on_null)).otherwise(found)


def member(value: Column, values: Sequence[str]) -> Column:
    return F.coalesce(value.isin(*values), F.lit(False))


def band(value: Column, edges: Sequence[float], names: Sequence[str]) -> tuple[Column, Column]:
    """(name, number from 1) of the half-open band below each edge. A null lies
    below no edge and so falls into the last band, as does all above the edges."""
    name, order = F.lit(names[-1]), F.lit(len(names))
    for i in reversed(range(len(edges))):
        name = F.when(value < edges[i], F.lit(names[i])).otherwise(name)
        order = F.when(value < edges[i], F.lit(i + 1)).otherwise(order)
    return name, order


def first_complete_key(*alternatives: Sequence[Column]) -> Column:
    """The first alternative whose parts are all known, put together; else null."""
    return F.coalesce(*[F.concat(*[p.cast("string") for p in parts]) for parts in alternatives])


def known_true(condition: Column) -> Column:
    """Three-valued to two-valued: unknown is false."""
    return F.coalesce(condition, F.lit(False))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def clean_text(text: Column) -> Column:
    """White space runs to one blank, trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def corrupt_below(value: Column, least: float) -> tuple[Column, Column]:
    """(value, or null where it is below least; whether it was)."""
    bad = known_true(value < least)
    return F.when(~bad, value), bad


def fraction(text: Column, sep: str) -> tuple[Column, Column]:
    """Both sides of 'a<sep>b' as integers; null where a side is missing or no
    number, instead of an error for the job."""
    parts = F.split(text, sep)
    return F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")


def surrogate_key(*parts: Column | str) -> Column:
    """md5 of the parts joined by a bar; null if a part is."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    joined = cols[0]
    for c in cols[1:]:
        joined = F.concat(joined, F.lit("|"), c)
    return F.md5(joined)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole as a rounded double; null where whole is 0."""
    return F.round(F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def at_least(count: Column, least: int, value: Column) -> Column:
    """value only where the cell holds at least ``least``: a statistic of a
    smaller cell would tell on its members."""
    return F.when(count >= least, value)


def full_match(text: Column, pattern: str) -> Column:
    """Whether all of the text matches (rlike alone looks anywhere)."""
    return text.rlike(f"^(?:{pattern})$")


def shard(name: Column) -> Column:
    """Two digits of a name's sha1: one of 256 shards."""
    return F.substring(F.sha1(name), 1, 2)
