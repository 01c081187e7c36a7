"""From raw records of two sources to lake tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.columns import corrupt_below, first_complete_key, fraction, known_true, mapped, member
from tallyspan.operators.rows import first_per_key

EVIDENCE = ("accepted", "partial", "rejected")
#: Verdicts of the first source and their classes.
VERDICT_CLASS = {
    "OK": "accepted",
    "PARTIAL": "partial",
    "WRONG_ANSWER": "rejected",
    "TIME_LIMIT_EXCEEDED": "rejected",
    "RUNTIME_ERROR": "rejected",
    "COMPILATION_ERROR": "rejected",
    "MEMORY_LIMIT_EXCEEDED": "rejected",
    "IDLENESS_LIMIT_EXCEEDED": "rejected",
    "CHALLENGED": "rejected",
    "PRESENTATION_ERROR": "rejected",
    "REJECTED": "rejected",
    "SECURITY_VIOLATED": "rejected",
    "SKIPPED": "unjudged",
    "TESTING": "unjudged",
    "FAILED": "unjudged",
    "CRASHED": "unjudged",
    "DENIAL_OF_JUDGEMENT": "unjudged",
    "INPUT_PREPARATION_CRASHED": "unjudged",
}
#: Statuses of the second source and their classes.
STATUS_CLASS = {
    "Accepted": "accepted",
    "Wrong Answer": "rejected",
    "Runtime Error": "rejected",
    "Time Limit Exceeded": "rejected",
    "Compile Error": "rejected",
    "WA: Presentation Error": "rejected",
    "Memory Limit Exceeded": "rejected",
    "Output Limit Exceeded": "rejected",
    "Query Limit Exceeded": "rejected",
    "Judge Not Available": "unjudged",
    "Internal error": "unjudged",
    "Judge System Error": "unjudged",
}
#: Fixed format: lake columns that are only renamed, by path in the raw record.
_PLAIN = {
    "submission_id": "id", "problem_contest_id": "problem.contestId", "problem_index": "problem.index", "problem_name": "problem.name", "problem_rating": "problem.rating",
    "problem_points": "problem.points", "problemset_name": "problem.problemsetName", "problem_tags": "problem.tags", "problem_type": "problem.type", "contest_id": "contestId",
    "collected_via_handle": "collected_via_handle", "team_id": "author.teamId", "participant_type": "author.participantType", "verdict": "verdict",
    "programming_language": "programmingLanguage", "testset": "testset", "passed_test_count": "passedTestCount", "time_consumed_millis": "timeConsumedMillis", "points_scored": "points",
    "creation_time_seconds": "creationTimeSeconds", "relative_time_seconds": "relativeTimeSeconds", "contest_start_time_seconds": "author.startTimeSeconds",
}


def stage_attempts(raw: DataFrame) -> DataFrame:
    """Flat attempts of 32 columns from nested records (ATTEMPT_JSON and
    collected_via_handle). A team of one that is no ghost is one person, and only
    then the attempt has a handle."""
    members = F.coalesce(F.size("author.members"), F.lit(0))
    ghost = known_true(F.col("author.ghost"))
    person = (members == 1) & ~ghost
    p = F.col("problem")
    key = first_complete_key((p["contestId"], p["index"]), (p["problemsetName"], p["index"]))
    handles = F.transform("author.members", lambda m: m["handle"])
    at = F.timestamp_seconds("creationTimeSeconds")
    derived = {
        "problem_id": key, "handle": F.when(person, F.get(handles, F.lit(0))), "author_handles": handles, "is_person_level": person, "is_ghost": ghost, "team_size": members,
        "is_contest": known_true(F.col("author.participantType") == "CONTESTANT"), "is_accepted": known_true(F.col("verdict") == "OK"), "submitted_at": at, "submitted_year": F.year(at),
    }
    return raw.select(*[F.col(path).alias(name) for name, path in _PLAIN.items()], *[c.alias(name) for name, c in derived.items()])


def normalize_attempts(raw: DataFrame) -> DataFrame:
    """One row per attempt: the one collected under the first handle."""
    return first_collected(stage_attempts(raw))


def first_collected(flat: DataFrame) -> DataFrame:
    """Of the rows of an attempt the one collected under the first handle."""
    tail = [F.col(c).asc_nulls_last() for c in ("collected_via_handle", "creation_time_seconds", "verdict", "passed_test_count", "time_consumed_millis")]
    return first_per_key(flat, ["submission_id"], tail)


def classify_attempts(attempts: DataFrame) -> DataFrame:
    """With verdict_class and is_evidence; a null verdict is not judged yet."""
    kind = mapped(F.col("verdict"), VERDICT_CLASS, "unknown", on_null="unjudged")
    return attempts.withColumn("verdict_class", kind).withColumn("is_evidence", member(F.col("verdict_class"), EVIDENCE))


def normalize_metadata(rows: DataFrame, problems: DataFrame) -> DataFrame:
    """Attempts of the second source with their problem's index entry. rows:
    METADATA_CSV (and source_file); problems: INDEX_CSV."""
    index = problems.select(F.col("id").alias("problem_id"), F.col("dataset").alias("judge"), F.col("name").alias("problem_name"), F.col("time_limit").alias("time_limit_ms"), F.col("memory_limit").alias("memory_limit_kb"))
    cpu, bad = corrupt_below(F.col("cpu_time"), 0)
    passed, total = fraction(F.nullif(F.col("accuracy"), F.lit("")), "/")
    at = F.timestamp_seconds("date")
    kind = mapped(F.col("status"), STATUS_CLASS, "unknown")
    # Fixed format: the lake's columns of this source.
    out = rows.join(index, "problem_id", "left").select(
        "submission_id", "problem_id", "user_id", "judge", "problem_name", "time_limit_ms", "memory_limit_kb", "status", kind.alias("verdict_class"),
        member(kind, EVIDENCE).alias("is_evidence"), (F.col("status") == "Accepted").alias("is_accepted"), "language", "original_language", "filename_ext",
        cpu.alias("cpu_time_ms"), bad.alias("has_corrupt_timing"), F.col("memory").alias("memory_kb"), F.col("code_size").alias("code_size_bytes"), "accuracy",
        passed.alias("tests_passed"), total.alias("tests_total"), at.alias("submitted_at"), F.year(at).alias("submitted_year"), *(["source_file"] if "source_file" in rows.columns else []),
    )
    return out


def counters(*, true: tuple[str, ...] = (), null: tuple[str, ...] = (), extent: tuple[str, ...] = ()) -> list[Column]:
    """Counts that one pass can keep, also while rows are written (observe): rows,
    true flags, nulls, least and greatest values."""
    return [
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c)).alias(f"true_{c}") for c in true], *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null],
        *[f(c).alias(f"{n}_{c}") for c in extent for n, f in (("first", F.min), ("last", F.max))],
    ]


def census(df: DataFrame, *, distinct: tuple[str, ...] = (), true: tuple[str, ...] = (), null: tuple[str, ...] = (), extent: tuple[str, ...] = ()) -> DataFrame:
    """One row of counters() and exact numbers of distinct values. Each distinct
    count is an aggregate by itself over its one column: of a columnar source each
    column is still read once, and no row is copied for every column (as several
    distinct counts in one aggregate would)."""
    out = df.agg(*counters(true=true, null=null, extent=extent))
    for c in distinct:
        out = out.join(df.agg(F.countDistinct(c).alias(f"distinct_{c}")))
    return out


def census_by(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(column, value, n): how often each value of each column occurs, nulls too,
    in one pass over df."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(each.alias("x")).groupBy("x.column", "x.value").agg(F.count("*").alias("n"))
