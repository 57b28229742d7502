"""Queries over JSON text columns: struct fields, arrays, explode, paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quarry.operators import semistructured as S
from quarry.plans.registry import query
from quarry.plans.standins import (BLOG_SQL, PART_CATEGORIES_SQL, PART_WORDS_SQL, blog,
                                   part_arrays, table)

# The fields of the events' props and of the blog data's dates.
PROPS_SCHEMA = StructType([StructField("k", IntegerType(), True)])
DATES_SCHEMA = StructType([
    StructField("createdOn", StringType(), True),
    StructField("publishedOn", StringType(), True),
    StructField("tz", StringType(), True),
])
WORDS = ArrayType(StringType())


@query("json_struct_field", ops=("X15", "P12", "B23"), sql="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_struct_field(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "props")
    parsed = S.parse_json_column(ev, "props", PROPS_SCHEMA, alias="props_parsed")
    return S.lift_field(parsed, "props_parsed", "k").select("event_id", "k")


@query("json_path", ops=("X20",), sql="""
SELECT event_id, json_extract_string(props, '$.k') AS k_text FROM events""")
def json_path(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.select("event_id", S.json_path("props", "$.k").alias("k_text"))


@query("json_published_year", ops=("X05", "X15", "P12", "F07", "B16"), sql=f"""
SELECT title, publishedOn, CAST(publishedOn AS TIMESTAMP) AS publishedOnTimestamp
FROM {BLOG_SQL} b WHERE year(CAST(publishedOn AS TIMESTAMP)) = 2025""")
def json_published_year(spark: SparkSession, sf: str) -> DataFrame:
    b = S.parse_json_column(blog(spark, sf), "dates", DATES_SCHEMA, alias="dates_parsed")
    b = S.lift_field(b, "dates_parsed", "publishedOn").select("title", "publishedOn")
    return S.published_in_year(b, "publishedOn", 2025, alias="publishedOnTimestamp")


@query("json_first_element", ops=("X16", "X17", "B16"), sql=f"""
SELECT p_partkey, {PART_WORDS_SQL}[1] AS primaryAuthor FROM part""")
def json_first_element(spark: SparkSession, sf: str) -> DataFrame:
    p = S.parse_json_column(part_arrays(spark, sf), "authors", WORDS)
    return p.select("p_partkey", S.first_element("authors").alias("primaryAuthor"))


@query("array_contains_search", ops=("F09", "X19"), sql=f"""
SELECT p_partkey, p_name FROM part WHERE list_contains({PART_WORDS_SQL}, 'ring')""")
def array_contains_search(spark: SparkSession, sf: str) -> DataFrame:
    p = S.parse_json_column(part_arrays(spark, sf), "authors", WORDS)
    return p.filter(S.array_has("authors", "ring")).select("p_partkey", "p_name")


@query("explode_authors", ops=("X18",), sql=f"""
SELECT p_partkey, unnest({PART_CATEGORIES_SQL}) AS category FROM part""")
def explode_authors(spark: SparkSession, sf: str) -> DataFrame:
    p = S.parse_json_column(part_arrays(spark, sf), "categories", WORDS)
    return S.explode_array(p, "categories", "category", ["p_partkey"], outer=False)


@query("explode_outer_authors", ops=("X18",), sql=f"""
SELECT p_partkey, c.category
FROM part LEFT JOIN LATERAL (SELECT unnest({PART_CATEGORIES_SQL}) AS category) c ON true""")
def explode_outer_authors(spark: SparkSession, sf: str) -> DataFrame:
    p = S.parse_json_column(part_arrays(spark, sf), "categories", WORDS)
    return S.explode_array(p, "categories", "category", ["p_partkey"], outer=True)


@query("category_counts", ops=("X18", "G01", "O01"), sql="""
SELECT token, count(*) AS reference_count
FROM (SELECT unnest(string_split(text, ' ')) AS token FROM documents)
GROUP BY token ORDER BY reference_count DESC, token""")
def category_counts(spark: SparkSession, sf: str) -> DataFrame:
    # every document's whole text, split on spaces, counted per token;
    # partial aggregation on each task collapses frequent tokens before the shuffle
    d = table(spark, sf, "documents").select(F.split("text", " ").alias("tokens"))
    toks = d.select(F.explode("tokens").alias("token"))
    return (toks.groupBy("token").agg(F.count(F.lit(1)).alias("reference_count"))
                .orderBy(F.col("reference_count").desc(), F.col("token")))
