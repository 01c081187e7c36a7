"""Temporal list join: URLs against dated list entries, as of their fetch.

List entries (key, action 'add' or 'remove', category, at) become validity
intervals: an 'add' holds from its time until the next entry of the same key and
category, for ever if none comes. A key is a host or a domain; a URL is looked
up by its host and by every parent domain of two labels or more, but an IP
address (four decimal numbers, or one in brackets) by itself alone. Each capture is
evaluated against the entries active at its fetch time, by an equi-join on the
key with the interval as a residual condition. Neither side has a size bound, so
Spark plans the join by their sizes, and adaptive execution splits a key that
holds many captures. DataFrame functions only.

Edge cases. Keys are compared in lower case and without trailing dots; an empty
key says nothing. Null URL, or one without a host: no key, nothing active, allowed.
Null fetch time: nothing active. Several entries of one key, category and time:
'remove' counts as the later. Repeated entries or captures: entries count once,
each capture gets its row. Empty list: all allowed. Columns of captures are
kept; names that this operator adds replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAR = "9999-12-31 00:00:00"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot; null if none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)", 1)
    return plain_name(host)


def plain_name(name: Column) -> Column:
    return F.nullif(F.regexp_replace(F.lower(name), r"\.+$", ""), F.lit(""))


def keys_of(host: Column) -> Column:
    """The host and its parent domains of two labels or more, longest first."""
    labels = F.split(host, r"\.")
    address = F.startswith(host, F.lit("[")) | host.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    starts = F.sequence(F.lit(1), F.when(address, 1).otherwise(F.greatest(F.size(labels) - 1, F.lit(1))))
    return F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, category, valid_from, valid_to) of entries (key, action, category, at)."""
    order = Window.partitionBy("key", "category").orderBy("at", "action")
    known = entries.where("key is not null and at is not null and action in ('add', 'remove')").select(plain_name(F.col("key")).alias("key"), "action", "category", "at").where("key is not null").distinct()
    until = F.coalesce(F.lead("at").over(order), F.lit(FAR).cast("timestamp_ntz"))
    dated = known.withColumn("valid_to", until).where((F.col("action") == "add") & (F.col("at") < F.col("valid_to")))
    return dated.select("key", "category", F.col("at").alias("valid_from"), "valid_to")


def active_entries(captures: DataFrame, entries: DataFrame, *, capture_id: str, url: str, fetched: str) -> DataFrame:
    """captures with host, n_active (long), categories (distinct, sorted,
    comma-joined), matched_key (the longest) and blocked."""
    added = ("host", "n_active", "categories", "matched_key", "blocked")
    base = captures.drop(*added).withColumn("host", host_of(F.col(url)))
    # Captures that agree in id, host and time agree in all that follows.
    looked = base.where(F.col("host").isNotNull() & F.col(fetched).isNotNull()).select(F.col(capture_id).alias("_id"), "host", F.col(fetched).alias("_at")).distinct()
    keyed = looked.select("_id", "host", "_at", F.explode(keys_of(F.col("host"))).alias("key"))
    spans = intervals(entries)
    met = keyed.join(spans, (keyed["key"] == spans["key"]) & (F.col("_at") >= F.col("valid_from")) & (F.col("_at") < F.col("valid_to")))
    found = met.groupBy("_id", "host", "_at").agg(
        F.count("*").alias("n_active"),
        F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"),
        F.max_by(keyed["key"], F.struct(F.length(keyed["key"]), keyed["key"])).alias("matched_key"),
    )
    found = found.select(F.col("_id"), F.col("host").alias("_host"), "_at", "n_active", "categories", "matched_key")
    joined = base.join(found, F.col(capture_id).eqNullSafe(F.col("_id")) & (F.col("host") == F.col("_host")) & (F.col(fetched) == F.col("_at")), "left")
    out = joined.drop("_id", "_host", "_at")
    return out.withColumn("n_active", F.coalesce("n_active", F.lit(0).cast("long"))).withColumn("categories", F.coalesce("categories", F.lit(""))).withColumn("blocked", F.col("n_active") > 0)
