"""Published aggregates over people, items and attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.columns import at_least, band, clean_text, percent

#: Upper edges of the rating bands, and their names.
BAND_EDGES = (1200, 1400, 1600, 1900, 2100, 2300, 2400, 2600, 3000)
BAND_NAMES = (
    "newbie", "pupil", "specialist", "expert", "candidate master", "master",
    "international master", "grandmaster", "international grandmaster", "legendary grandmaster",
)
SUPPRESSED = "(below reporting threshold)"
UNDECLARED = "(undeclared)"


def _share(count: str, digits: int = 3) -> Column:
    """Share of all groups' total; the window runs over one row per group."""
    return percent(F.col(count), F.sum(count).over(Window.partitionBy()), digits)


def rating_distribution(people: DataFrame) -> DataFrame:
    """Bands of a rating, in order. people: rating."""
    name, order = band(F.col("rating"), BAND_EDGES, BAND_NAMES)
    per = people.select(name.alias("rating_band"), order.alias("band_order"), "rating").groupBy("rating_band", "band_order")
    out = per.agg(F.count("*").alias("members"), F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating"), F.round(F.avg("rating"), 1).alias("mean_rating"))
    return out.withColumn("share_pct", _share("members"))


def activity_by_year(attempts: DataFrame, registrations: DataFrame) -> DataFrame:
    """Per year: attempts, people and items, acceptance, and the share of those
    registered by then. attempts: year, user, item, accepted, person, contest;
    registrations: year (one row per person).

    People registered by a year are a sum over an inequality join of two tables
    of one row per year. The distinct counts are taken in one pass.
    """
    years = attempts.groupBy("year").agg(
        F.count("*").alias("attempts"), F.count_if("person").alias("person_attempts"), F.countDistinct("user").alias("active_users"), F.countDistinct("item").alias("items"),
        F.count_if("accepted").alias("accepted"), F.count_if("contest").alias("in_contest"),
    )
    joined = registrations.groupBy(F.col("year").alias("r_year")).agg(F.count("*").alias("joined"))
    # A year's row meets the registrations up to it, and is one row again.
    out = years.join(joined, F.col("r_year") <= F.col("year"), "left").groupBy(*years.columns).agg(F.coalesce(F.sum("joined"), F.lit(0)).alias("registered_by_then"))
    final = F.max("year").over(Window.partitionBy())
    return out.select(
        "year", "attempts", "person_attempts", "active_users", "items", "accepted", percent(F.col("accepted"), F.col("attempts")).alias("accepted_pct"), "in_contest",
        (F.col("year") == final).alias("is_partial_year"), "registered_by_then", percent(F.col("active_users"), F.col("registered_by_then")).alias("active_share_pct"),
    )


def _people_stats(rating: str, strong: float) -> list[Column]:
    return [
        F.count("*").alias("members"), F.round(F.avg(rating), 1).alias("mean_rating"), F.median(rating).alias("median_rating"), F.max(rating).alias("max_rating"),
        F.count_if(F.col(rating) >= strong).alias("strong"),
    ]


def country_participation(people: DataFrame, *, least: int, strong: float) -> DataFrame:
    """Per country; statistics only from ``least`` members on. people: country,
    rating."""
    country = F.nullif(F.col("country"), F.lit(""))
    per = people.select(F.coalesce(country, F.lit(UNDECLARED)).alias("country"), country.isNull().alias("is_undeclared"), "rating").groupBy("country", "is_undeclared")
    out = per.agg(*_people_stats("rating", strong)).withColumn("share_pct", _share("members"))
    stats = [at_least(F.col("members"), least, F.col(c)).alias(c) for c in ("mean_rating", "median_rating", "max_rating", "strong")]
    return out.select("country", "is_undeclared", "members", "share_pct", *stats, (F.col("members") >= least).alias("is_reportable"))


def organization_participation(people: DataFrame, *, least: int, strong: float) -> DataFrame:
    """Per organisation of cleaned name; those of fewer than ``least`` members
    are one row with their count alone. people: organization, country, rating.

    The most common country is by count, then name: a bare mode would leave ties
    to chance.
    """
    known = people.select(clean_text(F.col("organization")).alias("organization"), "country", "rating").where("organization <> ''")
    per = known.groupBy("organization").agg(*_people_stats("rating", strong))
    counted = known.where("country is not null").groupBy("organization", "country").agg(F.count("*").alias("n"))
    usual = counted.groupBy("organization").agg(F.min(F.struct((-F.col("n")).alias("n"), "country"))["country"].alias("most_common_country"))
    shown = per.where(F.col("members") >= least).join(usual, "organization", "left").withColumn("is_reportable", F.lit(True))
    rest = per.where(F.col("members") < least).agg(F.sum("members").alias("members")).where("members > 0")
    blank = [F.lit(None).cast(t).alias(c) for c, t in shown.dtypes if c not in ("organization", "members", "is_reportable")]
    bucket = rest.select(F.lit(SUPPRESSED).alias("organization"), "members", *blank, F.lit(False).alias("is_reportable"))
    return shown.unionByName(bucket)


def tag_landscape(items: DataFrame) -> DataFrame:
    """Per tag. items: tags (array), rating, solved, published."""
    rows = items.where(F.size("tags") > 0).select(F.explode("tags").alias("tag"), "rating", "solved", "published")
    return rows.groupBy("tag").agg(
        F.count("*").alias("items"), F.count("rating").alias("rated_items"), F.round(F.avg("rating"), 1).alias("mean_rating"), F.median("rating").alias("median_rating"),
        F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating"), F.median("solved").alias("median_solved"), F.count_if("published").alias("published_items"),
        F.count_if(~F.col("published")).alias("other_items"),
    )
