"""Stand-ins: the reference's inputs re-derived from the given tables.

The reference reads external files that are not shipped (bike trips, a
blog export, housing prices). Each stand-in is a lazy projection of one
of the given tables, so every query built on it scans the whole table and
its work grows with the data. The DuckDB twins of these derivations live
next to them (``*_SQL``) so the oracle reads the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import ISO_SECONDS_FORMAT, TRIP_TEXT_FORMAT, wall_text
from quarry.sources.readers import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# --------------------------------------------------------------------- bike trips
# events -> trips: event_id is the trip, value (minutes) becomes whole
# seconds of duration, ts is the start, start + duration the end; both
# are rendered as text in the trip file's layout, user_id is the bike and
# the start terminal, event_type the subscriber type.

def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    duration = F.floor(F.col("value") * F.lit(60.0)).cast("bigint")
    end_ts = F.timestamp_add("SECOND", duration, F.col("ts"))
    return ev.select(
        F.col("event_id").alias("Trip_ID"),
        duration.alias("Duration"),
        wall_text("ts", TRIP_TEXT_FORMAT).alias("Start_Date"),
        wall_text(end_ts, TRIP_TEXT_FORMAT).alias("End_Date"),
        F.col("user_id").alias("Start_Terminal"),
        F.col("user_id").alias("Bike_#"),
        F.col("event_type").alias("Subscriber_Type"),
    )


TRIPS_SQL = """(SELECT event_id AS Trip_ID,
        CAST(floor(value * 60.0) AS BIGINT) AS Duration,
        ts AS start_ts,
        ts + to_seconds(CAST(floor(value * 60.0) AS BIGINT)) AS end_ts,
        strftime(ts, '%-m/%-d/%Y %-H:%-M') AS Start_Date,
        strftime(ts + to_seconds(CAST(floor(value * 60.0) AS BIGINT)), '%-m/%-d/%Y %-H:%-M') AS End_Date,
        user_id AS Start_Terminal,
        user_id AS "Bike_#",
        event_type AS Subscriber_Type
   FROM events)"""


# --------------------------------------------------------------------- blog export
# events -> blog posts: title from type and id, a JSON text column `dates`
# with createdOn (the event time) and publishedOn (floor(value) weeks later).

def blog(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    published = F.timestamp_add("DAY", F.floor("value").cast("int") * 7, F.col("ts"))
    # the values are digits, '-', ':' and 'T' only, so the JSON text is built
    # with concat (codegen) instead of to_json; no value needs escaping
    dates = F.concat(F.lit('{"createdOn":"'), wall_text("ts", ISO_SECONDS_FORMAT),
                     F.lit('","publishedOn":"'), wall_text(published, ISO_SECONDS_FORMAT),
                     F.lit('","tz":"UTC"}'))
    return ev.select(
        F.col("event_id").alias("post_id"),
        F.concat_ws(" #", "event_type", F.col("event_id").cast("string")).alias("title"),
        dates.alias("dates"),
    )


BLOG_SQL = """(SELECT event_id AS post_id,
        event_type || ' #' || CAST(event_id AS VARCHAR) AS title,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') AS createdOn,
        strftime(ts + to_days(CAST(floor(value) AS INTEGER) * 7), '%Y-%m-%dT%H:%M:%S') AS publishedOn
   FROM events)"""


# --------------------------------------------------------------------- JSON arrays
# part -> JSON array text columns: `authors` = the words of p_name,
# `categories` = the words longer than four letters (empty for some parts).

def part_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    words = F.split(F.col("p_name"), " ")
    return p.select(
        "p_partkey", "p_name",
        F.to_json(words).alias("authors"),
        F.to_json(F.filter(words, lambda w: F.length(w) > 4)).alias("categories"),
    )


PART_WORDS_SQL = "string_split(p_name, ' ')"
PART_CATEGORIES_SQL = "list_filter(string_split(p_name, ' '), lambda w: length(w) > 4)"
