"""Readers with declared schemas; nothing is inferred, and a field that a schema
does not name is not read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.session import settled

#: Fixed format: one attempt as the judge's API delivers it.
ATTEMPT_JSON = """
id long, contestId int, creationTimeSeconds long, relativeTimeSeconds long, passedTestCount int,
programmingLanguage string, testset string, timeConsumedMillis long, points double, verdict string,
author struct<ghost: boolean, teamId: int, participantType: string, startTimeSeconds: long, members: array<struct<handle: string>>>,
problem struct<contestId: int, index: string, name: string, rating: int, points: double, problemsetName: string, tags: array<string>, type: string>
"""
#: Fixed format: the per-problem metadata files and their index.
METADATA_CSV = """
submission_id string, problem_id string, user_id string, date long, language string, original_language string,
filename_ext string, status string, cpu_time long, memory long, code_size long, accuracy string
"""
INDEX_CSV = "id string, name string, dataset string, time_limit long, memory_limit long, rating string, tags string, complexity string"
#: Fixed format: an envelope with one array of users.
USERS_JSON = """
status string, result array<struct<handle: string, rating: int, maxRating: int, rank: string, maxRank: string, country: string,
city: string, organization: string, firstName: string, lastName: string, contribution: int, friendOfCount: int,
registrationTimeSeconds: long, lastOnlineTimeSeconds: long>>
"""
PROBLEMSET_JSON = """
problem_id string, contest_id int, problemset_name string, problemset_source string, problem_index string, problem_name string,
problem_type string, problem_points double, problem_rating int, problem_tags array<string>, solved_count long, fetched_at string
"""
RATINGS_JSON = "Rating double, ID long, Title string, TitleZH string, TitleSlug string, ContestSlug string, ProblemIndex string, ContestID_en long, ContestID_zh long"


def file_stem(suffix: str) -> Column:
    """The file's name without suffix. The path is a URI, whose per cent signs
    are coded once more, and a leading underscore or dot is coded in the name
    itself (readers skip such files), so two layers come off; the second only at
    the start."""
    name = F.regexp_extract(F.col("_metadata.file_path"), rf"([^/]+){suffix}$", 1)
    once = F.regexp_replace(name, "%25", "%")
    return F.regexp_replace(F.regexp_replace(once, "^%5F", "_"), "^%2E", ".")


def json_lines(spark: SparkSession, paths: Sequence[str], schema: str, *, name_as: str | None = None, suffix: str = r"\.jsonl(?:\.gz)?") -> DataFrame:
    """JSON lines, compressed or not; optionally with the file's name. Files of
    gzip do not split, so their number sets the parallelism."""
    df = spark.read.schema(schema).json(list(paths))
    return df if name_as is None else df.withColumn(name_as, file_stem(suffix))


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one array of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def json_envelope(spark: SparkSession, path: str, schema: str, field: str) -> DataFrame:
    """Files that are one object each, with an array of objects in a field: a row
    for each of these, under the field's element type in schema. A file is read in
    as many tasks as it has splits, on any store, lines or not.

    Text is cut at closing braces, which splits may begin at. Whether a piece
    begins inside a string, how deep in objects, and in which record, are sums over
    all pieces before it: within a split a window's, and from split to split a sum
    over one row for each split. Pieces of one record then meet, and are parsed.

    Elements that are no objects are left out, null fields of elements are null,
    and a field that is missing, null or empty gives no rows. Compressed files are
    one split. The names of the envelope's fields may hold no quotes."""
    value, place = F.col("value"), ["file", "block"]
    text = spark.read.option("lineSep", "}").text(path)
    pieces = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    plain = F.regexp_replace(value, r"(?s)\\.", "")  # without escaped letters
    count = lambda x, sign: F.length(x) - F.length(F.replace(x, F.lit(sign), F.lit("")))
    pieces = settled(_running(pieces.withColumn("quotes", count(plain, '"')), "quotes", "before"))
    inside = F.col("before") % 2 == 1
    outside = F.when(~inside, plain).when(F.col("quotes") > 0, F.regexp_replace(plain, '^[^"]*"', "")).otherwise("")
    outside = F.regexp_replace(F.regexp_replace(outside, '"[^"]*"', ""), '"[^"]*$', "")
    closes = ((F.col("before") + F.col("quotes")) % 2 == 0).cast("int")
    pieces = pieces.withColumns({"closes": closes, "deeper": count(outside, "{") - closes}).drop("quotes", "before")
    pieces = settled(_running(pieces, "deeper", "depth"))
    ends = ((F.col("depth") + F.col("deeper") == 1) & (F.col("closes") == 1)).cast("int")
    pieces = _running(pieces.withColumn("ends", ends), "ends", "record")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*place[1:], "at", "value"))), lambda p: p["value"]), "}")
    records = pieces.groupBy("file", "record").agg(whole.alias("text"), F.max("ends").alias("ends")).where("ends = 1")
    # Before an element stands what ends the one before it, or the field's name.
    string = r'"(?:[^"\\]++|\\.)*+"'
    opening = F.when(F.col("record") == 0, F.regexp_replace("text", r"(?s)^[^{]*\{", "")).otherwise(F.col("text"))
    head = F.regexp_extract("text", rf'(?s)^((?:[^"{{]++|{string})*+)\{{', 1)
    records = records.withColumn("text", opening).withColumn("head", head)
    named = rf'(?s)^.*({string})\s*:\s*(\[?)'
    name = F.when(F.col("head").rlike(named), F.concat(F.regexp_extract("head", named, 1), F.regexp_extract("head", named, 2)))
    records = settled(records.select("file", "record", name.alias("name"), F.concat(F.expr("substring(text, length(head) + 1)"), F.lit("}")).alias("text")))
    until = F.lead("record").over(Window.partitionBy("file").orderBy("record"))
    fields = records.where("name is not null").select("file", "name", F.col("record").alias("since"), until.alias("until"))
    own = fields.where(F.col("name") == f'"{field}"[').alias("f")
    same = (F.col("r.file") == F.col("f.file")) & (F.col("r.record") >= F.col("f.since")) & (F.col("f.until").isNull() | (F.col("r.record") < F.col("f.until")))
    element = T.StructType.fromDDL(schema)[field].dataType.elementType
    return records.alias("r").join(own, same).select(F.from_json("r.text", element).alias("r")).select("r.*")


def _running(df: DataFrame, value: str, out: str) -> DataFrame:
    """df with the sum of value over all earlier pieces of a file."""
    within = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    splits = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy("file", "block").agg(F.sum(value).alias("_n"))
    sums = sums.select("file", "block", F.coalesce(F.sum("_n").over(splits), F.lit(0)).alias("_before"))
    return df.join(sums, ["file", "block"]).withColumn(out, F.col("_before") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("_before")


def csv_files(spark: SparkSession, paths: Sequence[str], schema: str, *, name_as: str | None = None) -> DataFrame:
    """CSV files with a header that must name the schema's columns in order
    (without enforceSchema a reordered header would be read as if it were not)."""
    df = spark.read.schema(schema).options(header=True, mode="FAILFAST", enforceSchema=False).csv(list(paths))
    return df if name_as is None else df.withColumn(name_as, F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1))


def parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet, with partition folders as columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def users(spark: SparkSession, path: str, snapshot_date: str) -> DataFrame:
    """The user list as rows, times as instants."""
    r = json_envelope(spark, path, USERS_JSON, "result")
    return r.select(
        "handle", "rating", F.col("maxRating").alias("max_rating"), F.col("rank").alias("rank_name"), F.col("maxRank").alias("max_rank_name"), "country", "city", "organization",
        F.col("firstName").alias("first_name"), F.col("lastName").alias("last_name"), "contribution", F.col("friendOfCount").alias("friend_of_count"),
        F.timestamp_seconds("registrationTimeSeconds").alias("registered_at"), F.timestamp_seconds("lastOnlineTimeSeconds").alias("last_online_at"), F.lit(snapshot_date).cast("date").alias("snapshot_date"),
    )


def ratings(spark: SparkSession, path: str) -> DataFrame:
    """Rated problems with their contest's type ('biweekly' holds 'weekly', so it
    is looked for first)."""
    r = json_array(spark, path, RATINGS_JSON)
    slug = F.col("ContestSlug")
    kind = F.when(slug.like("biweekly%"), "biweekly").when(slug.like("weekly%"), "weekly").otherwise("other")
    return r.select(
        F.col("TitleSlug").alias("title_slug"), F.col("ID").alias("problem_number"), F.col("Title").alias("title"), F.col("TitleZH").alias("title_zh"), F.col("Rating").alias("rating"),
        slug.alias("contest_slug"), F.col("ProblemIndex").alias("problem_index"), F.col("ContestID_en").alias("contest_name"), kind.alias("contest_type"),
    )
