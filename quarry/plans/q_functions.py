"""Queries for scalar functions and UDFs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import scalar as X
from quarry.functions.noise import normal, uniform
from quarry.functions.udfs import define_minutes_function, register_minutes_udf
from quarry.operators.relational import with_global_position
from quarry.plans.registry import fixed_sql, query
from quarry.plans.standins import TRIPS_SQL, table, trips


@query("parse_trip_dates", ops=("X03", "X04"), sql=f"""
SELECT Trip_ID, CAST(start_ts AS DATE) AS start_day, strftime(start_ts, '%m/%d/%Y') AS start_day_text,
       CAST(end_ts AS DATE) AS end_day, strftime(end_ts, '%m/%d/%Y') AS end_day_text
FROM {TRIPS_SQL} t""")
def parse_trip_dates(spark: SparkSession, sf: str) -> DataFrame:
    t = trips(spark, sf)
    out = t.select("Trip_ID", X.parse_date_text("Start_Date").alias("start_day"),
                   X.parse_date_text("End_Date").alias("end_day"))
    return out.select("Trip_ID", "start_day", X.format_date_text("start_day").alias("start_day_text"),
                      "end_day", X.format_date_text("end_day").alias("end_day_text"))


@query("date_range_filter", ops=("F06", "X03"), sql=f"""
SELECT Trip_ID, Duration, Start_Date, End_Date, "Bike_#", Subscriber_Type,
       row_number() OVER (ORDER BY CAST(start_ts AS DATE), Trip_ID) AS position
FROM {TRIPS_SQL} t WHERE CAST(start_ts AS DATE) >= DATE '2024-01-15'""")
def date_range_filter(spark: SparkSession, sf: str) -> DataFrame:
    trips(spark, sf).createOrReplaceTempView("trips_view")
    late = spark.sql("""
        SELECT Trip_ID, Duration, Start_Date, End_Date, `Bike_#`, Subscriber_Type,
               try_to_date(Start_Date, 'M/d/yyyy H:m') AS start_day FROM trips_view
        WHERE try_to_date(Start_Date, 'M/d/yyyy H:m') >= DATE '2024-01-15'""")
    # sorted on the date, not its text; the position makes the order part of the result
    return with_global_position(late, [F.col("start_day").asc(), F.col("Trip_ID").asc()]).drop("start_day")


@query("epoch_to_timestamp", ops=("X07",), sql="""
SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds, date_trunc('second', ts) AS ts
FROM events""")
def epoch_to_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", X.epoch_seconds("ts").alias("seconds"))
    return ev.withColumn("ts", X.epoch_to_timestamp("seconds"))


@query("parse_compact_ts", ops=("X06", "X07", "B21"), sql="""
SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S') AS compact,
       CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch_seconds,
       date_trunc('second', ts) AS parsed_ts
FROM events""")
def parse_compact_ts(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select(
        "event_id", X.wall_text("ts", X.COMPACT_TS_FORMAT).alias("compact"))
    parsed = ev.withColumn("parsed_ts", X.parse_compact_timestamp("compact"))
    return parsed.select("event_id", "compact", X.epoch_seconds("parsed_ts").alias("epoch_seconds"),
                         "parsed_ts")


@query("cast_columns", ops=("X11",), sql="""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id_text, CAST(trunc(o_totalprice) AS INTEGER) AS total_int,
       CAST(o_custkey AS INTEGER) AS custkey_int
FROM orders""")
def cast_columns(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    # try_cast: an out-of-range or malformed value becomes null, not a failed job
    return o.select(X.safe_cast("o_orderkey", "string").alias("order_id_text"),
                    X.safe_cast("o_totalprice", "int").alias("total_int"),
                    X.safe_cast("o_custkey", "int").alias("custkey_int"))


@query("column_arithmetic", ops=("X12",), sql=f"""
SELECT l_orderkey, l_linenumber, l_partkey + l_suppkey AS key_sum,
       CAST(l_linenumber * 100 AS INTEGER) AS line_x100,
       {fixed_sql('l_extendedprice * (1 - l_discount) * (1 + l_tax)', 4)} AS charge
FROM lineitem""")
def column_arithmetic(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_partkey") + F.col("l_suppkey")).alias("key_sum"),
                     (F.col("l_linenumber") * 100).cast("int").alias("line_x100"),
                     X.fixed_round(charge, 4).alias("charge"))


OFFSET = 3.7


@query("offset_round", ops=("X10", "X22", "B15"), sql=f"""
SELECT event_id, round(value + {OFFSET}, 2) AS adj_value FROM events""")
def offset_round(spark: SparkSession, sf: str) -> DataFrame:
    # the offset is an explicit literal (one value for all rows, as the
    # reference's driver-side random draw is); use F.rand(seed) for per-row noise
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.round(F.col("value") + F.lit(OFFSET), 2).alias("adj_value"))


@query("duration_minutes", ops=("V01", "B14"), sql=f"""
SELECT Trip_ID, {fixed_sql('Duration / 60.0', 3)} AS DurationMins FROM {TRIPS_SQL} t""")
def duration_minutes(spark: SparkSession, sf: str) -> DataFrame:
    # native; duration_minutes_sql runs the same rounding as a registered UDF
    t = trips(spark, sf)
    return t.select("Trip_ID", X.seconds_to_minutes("Duration", 3).alias("DurationMins"))


@query("duration_minutes_sql", ops=("V02", "S11"), sql=f"""
SELECT Trip_ID, {fixed_sql('Duration / 60.0', 3)} AS DurationMins, Start_Terminal FROM {TRIPS_SQL} t""")
def duration_minutes_sql(spark: SparkSession, sf: str) -> DataFrame:
    register_minutes_udf(spark, "to_minutes")
    trips(spark, sf).createOrReplaceTempView("trips_view")
    return spark.sql("SELECT Trip_ID, to_minutes(Duration) AS DurationMins, Start_Terminal "
                     "FROM trips_view")


@query("duration_minutes_function", ops=("V02", "S11"), sql=f"""
SELECT Trip_ID, {fixed_sql('Duration / 60.0', 3)} AS DurationMins, Start_Terminal FROM {TRIPS_SQL} t""")
def duration_minutes_function(spark: SparkSession, sf: str) -> DataFrame:
    # a function defined in SQL: Catalyst puts its body in the place of the call
    define_minutes_function(spark, "seconds_in_minutes")
    trips(spark, sf).createOrReplaceTempView("trips_for_function")
    return spark.sql("SELECT Trip_ID, seconds_in_minutes(Duration) AS DurationMins, Start_Terminal FROM trips_for_function")


_U = "(CAST(('0x' || substr(md5(concat('{seed}:', event_id)), {at}, 13)) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"


@query("noise_offset", ops=("X22", "B15"), sql=f"""
SELECT event_id, {fixed_sql(f"value + (-2.0 + 4.0 * ({_U.format(seed=7, at=1)}))", 4)} AS shifted,
       {fixed_sql(f"value + (0.0 + 1.5 * sqrt(-2.0 * ln({_U.format(seed=8, at=1)})) * cos(6.283185307179586 * ({_U.format(seed=8, at=14)})))", 4)} AS noisy
FROM events""")
def noise_offset(spark: SparkSession, sf: str) -> DataFrame:
    # one draw per row from (seed, event_id): the same numbers for any layout of the table
    ev = table(spark, sf, "events")
    return ev.select("event_id", X.fixed_round(F.col("value") + uniform(7, "event_id", -2.0, 2.0), 4).alias("shifted"),
                     X.fixed_round(F.col("value") + normal(8, "event_id", 0.0, 1.5), 4).alias("noisy"))
