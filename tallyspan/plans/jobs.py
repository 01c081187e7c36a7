"""Whole runs: raw files to the lake, the lake to published tables, facts to a
response artefact. Actions live here; operators stay lazy. Each run reports its
counts; what a run can check before it writes what others read, it checks."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyspan.operators import normalize, observatory, responses
from tallyspan.operators.publish import Publication, export, verify
from tallyspan.operators.rows import number_keys
from tallyspan.session import settled
from tallyspan.sources import landing, readers, sinks, store
from tallyspan.sources import ledger as ledgers


_FLAGS = ("is_person_level", "is_ghost", "is_accepted", "is_contest")
_DISTINCT = ("submission_id", "problem_id", "handle", "collected_via_handle", "team_id")


def attempts_to_lake(spark: SparkSession, source: str, lake: str, reports: str, shards: Iterable[str] | None = None) -> dict[str, Any]:
    """Landing zone to lake, one row per attempt, in folders by year. The zone is
    read once: its rows and those that are kept are counted as they pass. They are
    written beside the lake and take its place when the counts agree, so a run that
    fails leaves the lake that there was."""
    files = landing.audited(source, spark)
    if not files:
        raise FileNotFoundError(f"the landing zone at {source} is empty")
    chosen = sorted(shards) if shards else None
    new = sinks.beside(lake)
    counts = _written(spark, _raw(spark, landing.shard_globs(source, chosen)), new)
    handles = {r[0] for r in readers.parquet(spark, new).select("collected_via_handle").distinct().toLocalIterator()}
    listed = [f for f in landing.listed(source, spark) if f.endswith(".jsonl.gz") and (not chosen or f.split("/")[-2] in chosen)]
    # A file may hold nothing but repeats of what others hold; only files that the
    # lake does not name are opened again.
    counts |= {"files_read": landing.files_with_rows(spark, listed, handles)[0], "files_on_disk": files}
    store.swap_folder(new, lake, spark)
    sinks.report(reports, "attempts", counts, spark)
    return counts


def _raw(spark: SparkSession, paths: list[str]) -> DataFrame:
    return readers.json_lines(spark, paths, readers.ATTEMPT_JSON, name_as="collected_via_handle")


def _written(spark: SparkSession, raw: DataFrame, path: str) -> dict[str, Any]:
    """raw attempts normalised and written to a new folder, with their counts.
    Distinct values are counted from what was written; an error if it is not what
    passed."""
    seen, kept = Observation(), Observation()
    rows = normalize.normalize_attempts(raw.observe(seen, F.count(F.lit(1)).alias("raw_rows")))
    own = normalize.counters(true=_FLAGS, null=("problem_id", "problem_rating", "verdict"), extent=("submitted_year",))
    sinks.lake(rows.observe(kept, *own), path, "submitted_year")
    counts = kept.get | {"raw_rows": seen.get["raw_rows"]}
    back = normalize.census(readers.parquet(spark, path), distinct=_DISTINCT).first().asDict()
    if back["rows"] != counts["rows"] or back["distinct_submission_id"] + bool(back["rows"] and _null_ids(spark, path)) != counts["rows"]:
        store.delete(path, spark)
        raise ValueError(f"{counts['rows']} rows passed; {back['rows']} of {back['distinct_submission_id']} ids were written")
    return counts | back | {"duplicate_rows": counts["raw_rows"] - counts["rows"]}


def _null_ids(spark: SparkSession, path: str) -> bool:
    return not readers.parquet(spark, path).where("submission_id is null").isEmpty()


def attempts_increment(spark: SparkSession, source: str, lake: str, reports: str, ledger: str) -> dict[str, Any]:
    """Brings a lake up to date with its landing zone by a ledger of files. With
    nothing changed, nothing is read. New files alone are read, and only the years
    that their attempts are of are written again, merged with what the lake holds.
    A file that changed or is gone takes a whole run, as the lake no longer has
    what its rows had replaced; so does a lake that is missing. A zone that is
    missing or empty is an error."""
    files = ledgers.zone_files(spark, source)
    on_disk, known = landing.audited(source, spark), ledgers.known_files(spark, ledger)
    changes = settled(ledgers.compare(files, known))
    states = {r.state: r.n for r in changes.groupBy("state").agg(F.count("*").alias("n")).collect()}
    there = store.exists(lake, spark)
    if there and not states:
        return {"run": "skipped", "files_on_disk": on_disk}
    run = uuid.uuid4().hex
    if not there or set(states) != {"new"}:
        counts = attempts_to_lake(spark, source, lake, reports) | {"run": "whole"}
    else:
        paths = [r.path for r in changes.select("path").toLocalIterator()]
        seen = Observation()
        new = settled(normalize.normalize_attempts(_raw(spark, paths).observe(seen, F.count(F.lit(1)).alias("raw_rows"))))
        old = readers.parquet(spark, lake)
        # An attempt is of the year that the lake has it in, until it is merged.
        years = new.select("submitted_year").union(old.join(new.select("submission_id"), "submission_id", "left_semi").select("submitted_year")).distinct()
        years = settled(years)
        touched = old.join(years, old["submitted_year"].eqNullSafe(years["submitted_year"]), "left_semi")
        merged = settled(normalize.first_collected(touched.select(*new.columns).unionByName(new)))
        kept = Observation()
        sinks.lake_parts(merged.observe(kept, F.count(F.lit(1)).alias("rows")), lake, "submitted_year")
        _drop_empty_years(spark, lake, years, merged)
        counts = {"run": "increment", "files_read": len(paths), "files_on_disk": on_disk, "raw_rows": seen.get["raw_rows"], "rows_in_years": kept.get["rows"], "years": sorted(r[0] for r in years.collect() if r[0] is not None)}
        sinks.report(reports, "attempts_increment", counts, spark)
    ledgers.record(files, known, ledger, run)
    return counts


def _drop_empty_years(spark: SparkSession, lake: str, years: DataFrame, merged: DataFrame) -> None:
    """A year whose attempts all moved to others has no rows to replace it by."""
    for r in years.join(merged.select("submitted_year").distinct(), "submitted_year", "left_anti").where("submitted_year is not null").collect():
        store.delete(store.join(lake, f"submitted_year={r[0]}"), spark)


def metadata_to_lake(spark: SparkSession, source: str, index_name: str, lake: str, reports: str) -> dict[str, Any]:
    """Per-problem CSV files to lake. Files without rows must be empty and ids must
    be unique before anything is written; unknown statuses are counted."""
    files = [f for f in landing.listed(source, spark) if f.endswith(".csv") and f.rsplit("/", 1)[-1] != index_name and f.rsplit("/", 1)[0].endswith(source.rstrip("/").rsplit("/", 1)[-1])]
    rows = readers.csv_files(spark, files, readers.METADATA_CSV, name_as="source_file")
    index = readers.csv_files(spark, [store.join(source, index_name)], readers.INDEX_CSV)
    df = normalize.normalize_metadata(rows, index).persist()
    try:
        empty = landing.unread_files(files, df, "source_file")
        counts = normalize.census(
            df.withColumn("unknown", F.col("verdict_class") == "unknown"), distinct=("submission_id", "problem_id", "user_id", "source_file"),
            true=("is_accepted", "is_evidence", "has_corrupt_timing", "unknown"), null=("tests_total", "judge"), extent=("submitted_year",),
        ).first().asDict()
        if counts["distinct_submission_id"] != counts["rows"]:
            raise ValueError(f"{counts['rows']} rows have {counts['distinct_submission_id']} ids")
        new = sinks.beside(lake)
        sinks.lake(df.drop("source_file"), new, "submitted_year")
        store.swap_folder(new, lake, spark)
    finally:
        df.unpersist()
    counts |= {"files": len(files), "empty_files": [f.rsplit("/", 1)[-1] for f in empty]}
    sinks.report(reports, "metadata", counts, spark)
    return counts


#: Fixed format: published columns by the engine's own, in order, for each table.
PUBLISHED = {
    "obs_rating_distribution": {
        "rating_band": "rating_band", "band_order": "band_order", "cohort_users": "members", "cohort_share_pct": "share_pct", "min_rating": "min_rating", "max_rating": "max_rating",
        "mean_rating": "mean_rating",
    },
    "obs_activity_by_year": {
        "submitted_year": "year", "submissions": "attempts", "person_level_submissions": "person_attempts", "active_users": "active_users", "problems_attempted": "items",
        "accepted": "accepted", "accepted_pct": "accepted_pct", "in_contest": "in_contest", "is_partial_year": "is_partial_year", "registered_by_then": "registered_by_then",
        "active_share_pct": "active_share_pct",
    },
    "obs_tag_landscape": {
        "tag": "tag", "problems_with_tag": "items", "rated_problems": "rated_items", "mean_rating": "mean_rating", "median_rating": "median_rating", "min_rating": "min_rating",
        "max_rating": "max_rating", "median_solved_count": "median_solved", "from_problemset": "published_items", "from_tiebreak": "other_items",
    },
    "obs_country_participation": {
        "country": "country", "is_undeclared": "is_undeclared", "cohort_users": "members", "cohort_share_pct": "share_pct", "mean_rating": "mean_rating", "median_rating": "median_rating",
        "max_rating": "max_rating", "candidate_master_plus": "strong", "is_reportable": "is_reportable",
    },
    "obs_organization_participation": {
        "organization": "organization", "cohort_users": "members", "mean_rating": "mean_rating", "median_rating": "median_rating", "max_rating": "max_rating",
        "candidate_master_plus": "strong", "most_common_country": "most_common_country", "is_reportable": "is_reportable",
    },
}
_STATISTICS = ("mean_rating", "median_rating", "max_rating", "candidate_master_plus")


def _publication(table: str, order: tuple[str, ...], caveat: str, **more) -> Publication:
    return Publication(tuple(PUBLISHED[table]), order, caveat, **more)


#: What each published table may show. Tables of people are gated by their count.
PUBLICATIONS = {
    "obs_rating_distribution": _publication("obs_rating_distribution", ("band_order",), "Rated users of one snapshot; a user without a rating is in the last band.", count="cohort_users"),
    "obs_activity_by_year": _publication("obs_activity_by_year", ("submitted_year",), "The last year is partial; shares may pass 100, as attempts may come before a registration is seen."),
    "obs_tag_landscape": _publication("obs_tag_landscape", ("-problems_with_tag", "tag"), "A problem counts for each of its tags."),
    "obs_country_participation": _publication("obs_country_participation", ("-cohort_users", "country", "is_undeclared"), "Countries are as users declare them; statistics of small ones are left out.", count="cohort_users", statistics=_STATISTICS),
    "obs_organization_participation": _publication("obs_organization_participation", ("-is_reportable", "-cohort_users", "organization"), "Organisations are as users write them; small ones are one row.", count="cohort_users", statistics=_STATISTICS),
}
#: Tables that count the same people.
SAME_PEOPLE = (("obs_rating_distribution", "obs_country_participation"),)
#: Columns that must not be in a published table.
DENIED = ("handle", "user_key", "user_sk", "first_name", "last_name", "city")


def publish(facts: DataFrame, users: DataFrame, problems: DataFrame, folder: str, *, least: int = 5, strong: float = 1900) -> list[str]:
    """The five aggregates of a warehouse as JSON files. facts, users, problems:
    as dimensions.facts, user_dimension and problem_dimension give them."""
    people = users.where("is_current")
    current = problems.where("is_current").select(F.col("problem_tags").alias("tags"), F.col("problem_rating").alias("rating"), F.col("solved_count").alias("solved"), F.col("in_public_problemset").alias("published"))
    tries = facts.select(F.col("submitted_year").alias("year"), F.col("user_key").alias("user"), F.col("problem_key").alias("item"), F.col("is_accepted").alias("accepted"), F.col("is_person_level").alias("person"), F.col("is_contest").alias("contest"))
    joined = people.where("registered_at is not null").select(F.year("registered_at").alias("year"))
    tables = {
        "rating_distribution": observatory.rating_distribution(people),
        "activity_by_year": observatory.activity_by_year(tries, joined),
        "tag_landscape": observatory.tag_landscape(current),
        "country_participation": observatory.country_participation(people, least=least, strong=strong),
        "organization_participation": observatory.organization_participation(people, least=least, strong=strong),
    }
    out = []
    for own, df in tables.items():
        name = f"obs_{own}"
        out.append(export(df.select(*[F.col(c).alias(p) for p, c in PUBLISHED[name].items()]), name, folder, PUBLICATIONS[name]))
    return out


def verify_published(folder: str, spark: SparkSession | None = None) -> list[str]:
    """What is wrong with the files of publish()."""
    return verify(folder, PUBLICATIONS, denied=DENIED, equal_sums=SAME_PEOPLE, spark=spark)


def build_responses(facts: DataFrame, problems: DataFrame, path: str, *, cutoff: str, floor: int = 100_000, pins: dict[str, int] | None = None) -> dict[str, Any]:
    """The response matrix as sorted Parquet with a manifest beside it. Nothing
    is written if an invariant or a pinned count does not hold."""
    spark = facts.sparkSession
    items = problems.where("is_current").select(F.col("problem_key").alias("item"), F.col("problem_name").alias("name"), F.col("problem_contest_id").alias("contest"), F.col("problem_rating").alias("rating"), F.col("in_public_problemset").alias("published"))
    tries = facts.where("is_evidence and is_person_level").select(F.col("user_key").alias("user"), F.col("problem_key").alias("item"), F.col("submission_key").alias("attempt"), F.col("is_accepted").alias("accepted"), F.col("submitted_at").alias("at"))
    twins = responses.checked(responses.twin_map(items, floor))
    matrix = responses.response_matrix(tries, twins, items).persist()
    try:
        n = responses.matrix_counts(tries, twins, matrix).first().asDict()
        n |= responses.twin_counts(items, floor)
        n |= responses.temporal_split(matrix.where("published"), F.lit(cutoff).cast("timestamp")).first().asDict()
        broken = responses.broken_invariants(n) + [f"{k} is {n.get(k)}, not {v}" for k, v in (pins or {}).items() if n.get(k) != v]
        if broken:
            raise ValueError("; ".join(broken))
        rate = n["bank_accepted"] / n["bank"] if n["bank"] else None
        sinks.sorted_slice(matrix, path, ["user", "item"])
    finally:
        matrix.unpersist()
    manifest = n | {"cutoff": cutoff, "base_rate": rate, "constant_brier": None if rate is None else rate * (1 - rate)} | sinks.artefact(spark, path)
    manifest["digest"] = sinks.digests(readers.parquet(spark, path))
    sinks.write_manifest(path, manifest, spark)
    return manifest


def slices_without_identities(facts: DataFrame, users: DataFrame, folder: str, whole_years: tuple[int, int]) -> dict[str, int]:
    """User and fact slices that carry numbers in place of names, of whole years
    only: a year of which the facts hold a part would mislead."""
    first, last = whole_years
    top = facts.agg(F.max("submitted_year")).first()[0]
    if top is not None and last >= top:
        raise ValueError(f"{last} is not over in these facts")
    numbered = number_keys(users.where("is_current"), "user_key", "user_id").select("user_key", "user_id", "rating", "country", F.year("registered_at").alias("registration_year"))
    own = facts.where(F.col("submitted_year").between(first, last)).join(numbered.select("user_key", "user_id"), "user_key")
    own = number_keys(own, "problem_key", "problem_id").select("user_id", "problem_id", "submitted_year", "is_accepted", "is_person_level", "is_contest")
    sinks.sorted_slice(numbered.drop("user_key"), os.path.join(folder, "users"), ["user_id"])
    sinks.sorted_slice(own, os.path.join(folder, "facts"), ["submitted_year", "problem_id", "user_id"])
    spark = facts.sparkSession
    return {name: sinks.artefact(spark, os.path.join(folder, name))["rows"] for name in ("users", "facts")}
