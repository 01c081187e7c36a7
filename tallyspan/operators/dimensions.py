"""Dimensions and the fact table over normalised attempts. The columns of each are a
fixed format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.columns import OPENING, blank_to_null, surrogate_key
from tallyspan.operators.rows import as_of, enrich, richest_per_key


def _opened(df: DataFrame) -> DataFrame:
    """With the interval of a first and only version."""
    return df.withColumns({"valid_from": F.lit(OPENING).cast("timestamp"), "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)})


def problem_dimension(attempts: DataFrame, problemset: DataFrame) -> DataFrame:
    """One version per problem: of the attribute sets that attempts carry, the
    one richest in tags, with the published problemset's entry where there is
    one; its tags come before those of attempts."""
    own = ["problem_id", "problem_contest_id", "problem_index", "problem_name", "problem_rating", "problem_points", "problemset_name", "problem_tags", "problem_type"]
    sets = attempts.where("problem_id is not null").select(*own).distinct()
    chosen = richest_per_key(sets, ["problem_id"], "problem_tags", ["problem_name", "problem_rating", "problem_points", "problem_contest_id", "problem_index", "problemset_name", "problem_type"])
    listed = problemset.select("problem_id", F.col("problem_rating").alias("problemset_rating"), F.col("problem_tags").alias("_tags"), "solved_count", F.col("fetched_at").alias("problemset_fetched_at"))
    met = enrich(chosen, listed, "problem_id", "in_public_problemset").withColumn("problem_tags", F.coalesce("_tags", "problem_tags")).drop("_tags")
    out = met.withColumns({
        "problem_sk": surrogate_key(F.col("problem_id"), OPENING), "problemset_name": F.coalesce("problemset_name", F.lit("codeforces")), "tag_count": F.size("problem_tags"),
        "tags_source": F.when(F.col("in_public_problemset"), "problemset").otherwise("submissions"), "is_unrated": F.col("problem_rating").isNull(),
    })
    return _opened(out.withColumnRenamed("problem_id", "problem_key"))


def user_dimension(users: DataFrame) -> DataFrame:
    return _opened(users.withColumn("user_sk", surrogate_key(F.col("handle"), OPENING)).withColumnRenamed("handle", "user_key"))


def frozen_problem_dimension(index: DataFrame, attempts: DataFrame, statements: DataFrame, version: str) -> DataFrame:
    """Problems of a frozen archive: its index, with what attempts say of each
    and its statement, where there are any. index: INDEX_CSV."""
    seen = attempts.groupBy("problem_id").agg(
        F.count("*").alias("submission_count"), F.countDistinct("user_id").alias("user_count"), F.min("submitted_at").alias("first_submission_at"), F.max("submitted_at").alias("last_submission_at")
    )
    base = index.select(
        surrogate_key(*version.split("-"), F.col("id")).alias("problem_sk"), F.col("id").alias("problem_id"), F.col("dataset").alias("judge"), blank_to_null(F.col("name")).alias("problem_name"),
        F.col("time_limit").alias("time_limit_ms"), F.col("memory_limit").alias("memory_limit_kb"), F.lit(version).alias("snapshot_version"),
    )
    met = enrich(enrich(base, seen, "problem_id", "_seen"), statements, "problem_id", "has_statement")
    zero = F.lit(0).cast("long")
    return met.withColumns({"submission_count": F.coalesce("submission_count", zero), "user_count": F.coalesce("user_count", zero), "has_no_submissions": ~F.col("_seen")}).drop("_seen").withColumnRenamed("problem_id", "problem_key")


def rated_problem_dimension(ratings: DataFrame, source: str, version: str) -> DataFrame:
    """Problems of a rated list (readers.ratings)."""
    return ratings.withColumns({"problem_sk": surrogate_key(source, version, F.col("title_slug")), "problem_key": F.col("title_slug"), "snapshot_version": F.lit(version)})


def statement_staging(raw: DataFrame) -> DataFrame:
    """Problem statements with one test count, and blanks as nulls."""
    return raw.select(
        "problem_id", "full_name", "judge", F.col("description").alias("statement"), F.col("description_chars").alias("statement_chars"), "is_description_translated", "time_limit_seconds",
        "memory_limit_bytes", F.nullif("input_file", F.lit("")).alias("input_file"), F.nullif("output_file", F.lit("")).alias("output_file"), "public_test_count", "private_test_count",
        "generated_test_count", (F.col("public_test_count") + F.col("private_test_count") + F.col("generated_test_count")).alias("test_count"), "solution_count", "incorrect_solution_count",
    )


def facts(attempts: DataFrame, problems: DataFrame, users: DataFrame) -> DataFrame:
    """Classified attempts with the keys of the problem and user versions that
    were valid when they were made; attempts without either are left out."""
    met = as_of(attempts, problems, key="problem_id", version_key="problem_key", at="submitted_at", keep=["problem_sk"])
    met = as_of(met, users, key="collected_via_handle", version_key="user_key", at="submitted_at", keep=["user_sk"])
    renamed = {"submission_id": "submission_key", "problem_id": "problem_key", "collected_via_handle": "user_key", "time_consumed_millis": "execution_time_ms"}
    plain = ["problem_sk", "user_sk", "contest_id", "participant_type", "is_contest", "verdict", "verdict_class", "is_evidence", "is_accepted", "is_person_level", "team_id", "team_size", "programming_language", "testset", "passed_test_count", "points_scored", "submitted_at", "submitted_year"]
    return met.select(*[F.col(a).alias(b) for a, b in renamed.items()], *plain)
