"""Queries for sources, sinks and catalog operations.

Sink queries write to one folder under the shared ``spark.checkpoint.dir``
(or one managed table) per query and session: first a part of the data, then,
over it, all of it. They return the frame read back; the oracle is the plain
source query, so a pass means that the second version replaced the first and
the round trip preserved every row and value.
"""

from __future__ import annotations

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from quarry.functions.scalar import salary_band
from quarry.operators.profile import count_reconcile as reconcile
from quarry.plans.registry import query
from quarry.plans.standins import TRIPS_SQL, table, trips
from quarry.session import session_path, session_table
from quarry.sources import readers as RD
from quarry.sources import sinks as SK
from quarry.sources.json_array import read_json_array
from quarry.sources.versions import create_versioned, drop_versions, replace_version, write_counted


def _replaced(sink, df: DataFrame, target: str, **options) -> str:
    """Write a first version of one row, then replace it by all rows."""
    sink(df.limit(1), target, **options)
    return sink(df, target, **options)


@query("scan_parquet", ops=("S01", "P10"), sql="SELECT * FROM orders")
def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return RD.read_parquet(spark, f"{sf}/orders.parquet")


@query("csv_infer_roundtrip", ops=("S02", "K01"), writes=True, sql="""
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def csv_infer_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = _replaced(SK.write_csv, table(spark, sf, "customer"), session_path(spark, "customer-csv"),
                        header=True, sep=",")
    return RD.read_csv(spark, path, header=True, sep=",", infer_schema=True)


@query("csv_untyped_rename", ops=("S03", "P04"), writes=True, sql="""
SELECT CAST(s_suppkey AS VARCHAR) AS Terminal, s_name AS Maintenance_Station FROM supplier""")
def csv_untyped_rename(spark: SparkSession, sf: str) -> DataFrame:
    path = _replaced(SK.write_csv, table(spark, sf, "supplier"), session_path(spark, "supplier-csv"))
    raw = spark.read.format("csv").load(path, header=True)  # every column a string
    return raw.selectExpr("s_suppkey as Terminal", "s_name as Maintenance_Station")


CUSTOMER_SCHEMA = StructType([
    StructField("c_custkey", LongType(), True),
    StructField("c_name", StringType(), True),
    StructField("c_nationkey", IntegerType(), True),
    StructField("c_acctbal", DoubleType(), True),
    StructField("c_mktsegment", StringType(), True),
])


@query("csv_declared_schema", ops=("S04", "B19"), writes=True, sql="SELECT * FROM customer")
def csv_declared_schema(spark: SparkSession, sf: str) -> DataFrame:
    path = _replaced(SK.write_csv, table(spark, sf, "customer"), session_path(spark, "customer-csv-2"))
    # header names are checked against the declared fields (no positional surprises)
    return RD.read_csv(spark, path, schema=CUSTOMER_SCHEMA, enforce_header=True)


ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")


@query("csv_ddl_schema", ops=("S05",), writes=True, sql="SELECT * FROM orders")
def csv_ddl_schema(spark: SparkSession, sf: str) -> DataFrame:
    path = _replaced(SK.write_csv, table(spark, sf, "orders"), session_path(spark, "orders-csv"))
    return RD.read_csv(spark, path, schema=ORDERS_DDL)


@query("json_infer_roundtrip", ops=("S06", "K02"), writes=True, sql="""
SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice
FROM part""")
def json_infer_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = _replaced(SK.write_json, table(spark, sf, "part"), session_path(spark, "part-json"))
    return RD.read_json(spark, path)


EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")


@query("json_declared_schema", ops=("S07",), writes=True, sql="SELECT * FROM events")
def json_declared_schema(spark: SparkSession, sf: str) -> DataFrame:
    path = _replaced(SK.write_json, table(spark, sf, "events"), session_path(spark, "events-json"))
    return RD.read_json(spark, path, schema=EVENTS_SCHEMA)


@query("json_multiline", ops=("S08", "B07"), writes=True, sql="""
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def json_multiline(spark: SparkSession, sf: str) -> DataFrame:
    path = _replaced(SK.write_json, table(spark, sf, "customer"), session_path(spark, "customer-jsonarr"),
                         layout="array")
    return RD.read_json(spark, path, layout="array")


@query("json_array_split", ops=("S08", "B07"), writes=True, sql="SELECT * FROM orders")
def json_array_split(spark: SparkSession, sf: str) -> DataFrame:
    # one file with one array: spark.read.json would take it in one task
    path = SK.write_json(table(spark, sf, "orders"), session_path(spark, "orders-one-array"), layout="array", single_file=True)
    return read_json_array(spark, path, schema=ORDERS_DDL)


@query("parquet_roundtrip", ops=("K03", "K05"), writes=True, sql="SELECT * FROM lineitem")
def parquet_roundtrip(spark: SparkSession, sf: str, fmt: str = "parquet") -> DataFrame:
    src = table(spark, sf, "lineitem")
    path = session_path(spark, f"lineitem-{fmt}")
    if fmt == "parquet":
        _replaced(SK.write_parquet, src, path, compression="snappy", mode="overwrite")
    else:  # e.g. "delta" when its connector is installed
        SK.write_path(src, path, fmt, mode="overwrite")
    return spark.read.format(fmt).load(path)


@query("ctas_from_path", ops=("S09", "K08"), writes=True, sql="SELECT * FROM part")
def ctas_from_path(spark: SparkSession, sf: str) -> DataFrame:
    name = session_table(spark, "part_ctas")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    src = f"{sf}/part.parquet".replace("`", "``")
    return SK.ctas(spark, name, f"SELECT * FROM parquet.`{src}`", if_not_exists=True)


@query("table_roundtrip", ops=("S10", "K06", "D01"), writes=True, sql="SELECT * FROM orders")
def table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    name = session_table(spark, "orders_copy")
    _replaced(SK.save_table, table(spark, sf, "orders"), name, mode="overwrite")
    return spark.read.table(name)


@query("table_schema_replace", ops=("K07",), writes=True, sql="""
SELECT c_custkey, c_name, abs(c_acctbal) AS c_acctbal,
       CAST(round(abs(c_acctbal) / 1000.0) AS INTEGER) AS balance_band
FROM customer""")
def table_schema_replace(spark: SparkSession, sf: str) -> DataFrame:
    name = session_table(spark, "customer_v")
    c = table(spark, sf, "customer")
    SK.save_table(c, name, mode="overwrite")
    # second version: one column changed, one added, one removed
    v2 = (c.select("c_custkey", "c_name", F.abs("c_acctbal").alias("c_acctbal"))
           .withColumn("balance_band", salary_band("c_acctbal", 1000.0)))
    # v2 reads the source files, not the table it replaces (Spark refuses to
    # overwrite a table that the written plan reads from)
    SK.save_table(v2, name, mode="overwrite")
    return spark.read.table(name)


@query("count_reconcile", ops=("G13",), writes=True, sql="""
SELECT count(*) AS source_rows, count(*) AS copy_rows, true AS counts_match FROM orders""")
def count_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    src = table(spark, sf, "orders")
    name = session_table(spark, "orders_reconciled")
    SK.save_table(src, name)
    return reconcile(src, spark.read.table(name))


# Service-level days per order priority, a local code list.
PRIORITY_SLA = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 5), ("4-NOT SPECIFIED", 10),
                ("5-LOW", 10)]
# A day allowance per line number, keyed by text as local files are.
LINE_DAYS = [(str(n), 2 * n) for n in range(1, 8)]


@query("local_lookup_join", ops=("S13", "B24"), sql="""
SELECT l.l_orderkey, l.l_linenumber, d.days, o.o_orderpriority, p.sla_days
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 5), ('4-NOT SPECIFIED', 10), ('5-LOW', 10)) AS p(priority, sla_days)
  ON o.o_orderpriority = p.priority
JOIN (VALUES ('1', 2), ('2', 4), ('3', 6), ('4', 8), ('5', 10), ('6', 12), ('7', 14)) AS d(line, days)
  ON CAST(l.l_linenumber AS VARCHAR) = d.line""")
def local_lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    # fixed code lists of five and seven rows: broadcasting them is bounded by construction
    sla = RD.from_local(spark, pd.DataFrame(PRIORITY_SLA, columns=["priority", "sla_days"]), "priority string, sla_days int")
    days = RD.from_local(spark, pd.DataFrame(LINE_DAYS, columns=["line", "days"]), "line string, days int")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    # the line number is an int, the lookup's key text: the int is cast, so no key fails to parse
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(F.broadcast(sla), F.col("o_orderpriority") == sla.priority) \
        .join(F.broadcast(days), F.col("l_linenumber").cast("string") == days.line)
    return j.select("l_orderkey", "l_linenumber", "days", "o_orderpriority", "sla_days")


@query("normalise_columns", ops=("P08", "S02", "K01", "B03"), writes=True, sql=f"""
SELECT CAST(Trip_ID AS INTEGER) AS Trip_ID, CAST(Duration AS INTEGER) AS Duration, Start_Date,
       End_Date, CAST(Start_Terminal AS INTEGER) AS Start_Terminal,
       CAST("Bike_#" AS INTEGER) AS "Bike_#", Subscriber_Type
FROM {TRIPS_SQL} t""")
def normalise_columns(spark: SparkSession, sf: str) -> DataFrame:
    # a raw trip file has header names with spaces ("Trip ID", "Bike #")
    raw = trips(spark, sf)
    raw = raw.toDF(*[c.replace("_", " ") for c in raw.columns])
    path = _replaced(SK.write_csv, raw, session_path(spark, "trips-csv"))
    # names are normalised where the data is read, so no later step sees spaces
    return RD.read_csv(spark, path, infer_schema=True, normalise=True)


@query("sink_default_mode", ops=("K04",), writes=True, sql="SELECT *, true AS second_write_refused FROM nation")
def sink_default_mode(spark: SparkSession, sf: str) -> DataFrame:
    nation, path = table(spark, sf, "nation"), session_path(spark, "nation-default-mode")
    SK.write_parquet(nation, path, mode="overwrite")
    refused = False
    try:  # the writer's default mode refuses a path that holds data; the first content stays
        SK.write_parquet(nation.limit(1), path, mode="errorifexists")
    except AnalysisException as exc:
        refused = exc.getCondition() == "PATH_ALREADY_EXISTS"
    return spark.read.parquet(path).withColumn("second_write_refused", F.lit(refused))


_DIRTY_SQL = """
SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' WHEN o_orderkey % 7 = 0 THEN concat(o_custkey, 'x')
       WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS raw FROM orders"""


def _dirty_orders(spark: SparkSession, sf: str, name: str):
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    raw = F.when(key % 5 == 0, "n/a").when(key % 7 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit("x"))) \
        .when(key % 11 != 0, F.col("o_custkey").cast("string"))
    path = SK.write_csv(o.select("o_orderkey", "o_orderpriority", raw.alias("custkey")), session_path(spark, name))
    text = RD.read_csv(spark, path, schema="o_orderkey BIGINT, o_orderpriority STRING, custkey STRING")
    return RD.typed_with_rejects(text, {"custkey": "bigint"})


@query("csv_rejects", ops=("B18", "S03"), writes=True, sql=f"""
SELECT o_orderkey, o_orderpriority, TRY_CAST(raw AS BIGINT) AS custkey,
       raw IS NOT NULL AND TRY_CAST(raw AS BIGINT) IS NULL AS rejected FROM ({_DIRTY_SQL})""")
def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    typed, _ = _dirty_orders(spark, sf, "orders-dirty")
    return typed.withColumnRenamed("_rejected", "rejected")


@query("csv_reject_counts", ops=("B18",), writes=True, sql=f"""
SELECT o_orderpriority, count(TRY_CAST(raw AS BIGINT)) AS typed_rows,
       CAST(count(*) FILTER (raw IS NOT NULL AND TRY_CAST(raw AS BIGINT) IS NULL) AS BIGINT) AS rejected_rows
FROM ({_DIRTY_SQL}) GROUP BY o_orderpriority""")
def csv_reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    typed, rejected = _dirty_orders(spark, sf, "orders-dirty-counts")
    return typed.groupBy("o_orderpriority").agg(F.count("custkey").alias("typed_rows"), rejected)


@query("table_update_in_place", ops=("K06", "K07"), writes=True, sql="""
SELECT c_custkey, c_name, abs(c_acctbal) AS c_acctbal, CAST(round(abs(c_acctbal) / 1000.0) AS INTEGER) AS balance_band, c_mktsegment
FROM customer WHERE c_nationkey <> 3""")
def table_update_in_place(spark: SparkSession, sf: str) -> DataFrame:
    # each version is made from the table it replaces: first other rows and values, then other columns
    name, root = session_table(spark, "customer_versions"), session_path(spark, "customer-versions")
    create_versioned(spark, name, table(spark, sf, "customer"), root)
    replace_version(spark, name, lambda t: t.where("c_nationkey <> 3").withColumn("c_acctbal", F.abs("c_acctbal")), root)
    replace_version(spark, name, lambda t: t.withColumn("balance_band", salary_band("c_acctbal", 1000.0)).drop("c_nationkey"), root)
    drop_versions(spark, name, root)
    return spark.read.table(name).select("c_custkey", "c_name", "c_acctbal", "balance_band", "c_mktsegment")


@query("write_counts", ops=("K10", "G13", "B18"), writes=True, sql=f"""
SELECT count(*) AS source_rows, count(raw) FILTER (TRY_CAST(raw AS BIGINT) IS NULL) AS rejected_rows,
       count(*) FILTER (raw IS NULL OR TRY_CAST(raw AS BIGINT) IS NOT NULL) AS written_rows,
       CAST(sum(TRY_CAST(raw AS BIGINT)) AS BIGINT) AS custkey_sum FROM ({_DIRTY_SQL})""")
def write_counts(spark: SparkSession, sf: str) -> DataFrame:
    # the counts around a save come from the save itself: the source is read once
    typed, rejected = _dirty_orders(spark, sf, "orders-dirty-written")
    counts = write_counted(typed, lambda df: SK.write_parquet(df.drop("_rejected"), session_path(spark, "orders-clean")),
                           keep=~F.col("_rejected"), rejected_rows=rejected, custkey_sum=F.sum("custkey"))
    names = ["source_rows", "rejected_rows", "written_rows", "custkey_sum"]
    return spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))
