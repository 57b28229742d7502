"""Queries for projections, filters, joins, aggregations, ordering, distinct."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import (TRIP_TEXT_FORMAT, fixed_round, format_date_text,
                                     parse_date_text, parse_timestamp_text, salary_band,
                                     year_at_least)
from quarry.operators import relational as R
from quarry.operators import profile as P
from quarry.plans.registry import fixed_sql, query
from quarry.plans.standins import TRIPS_SQL, table, trips

# ------------------------------------------------------------------ minimum slice


@query("year_count", ops=("G02", "F01", "X01", "O01", "S01"), sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS order_count
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
GROUP BY 1 ORDER BY 1""")
def year_count(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return (o.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
             .groupBy(F.year("o_orderdate").alias("order_year"))
             .agg(F.count(F.lit(1)).alias("order_count"))
             .orderBy("order_year"))


@query("sql_year_count", ops=("S11", "G02"), sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS order_count
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
GROUP BY 1 ORDER BY 1""")
def sql_year_count(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "orders").createOrReplaceTempView("orders_view")
    return spark.sql("""
        SELECT year(o_orderdate) AS order_year, count(*) AS order_count
        FROM orders_view
        WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
        GROUP BY year(o_orderdate)
        ORDER BY order_year""")


# ------------------------------------------------------------------ flagship
# customer x orders, balance cleansed to its absolute value, rows under the
# threshold rejected, balance banded, bands counted per order year.

BAND_WIDTH = 1000.0
BAND_FLOOR = 2000.0


def salary_band_by_year_df(spark: SparkSession, sf: str) -> DataFrame:
    # orders are first counted per (customer, year): a customer holding a
    # third of all orders becomes a handful of rows before the join shuffle
    o = (table(spark, sf, "orders")
         .groupBy("o_custkey", F.year("o_orderdate").alias("order_year"))
         .agg(F.count(F.lit(1)).alias("n")))
    c = table(spark, sf, "customer").select("c_custkey", F.abs("c_acctbal").alias("balance"))
    c = c.filter(F.col("balance") >= BAND_FLOOR).withColumn("band", salary_band("balance", BAND_WIDTH))
    joined = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return (joined.groupBy("order_year", "band")
                  .agg(F.sum("n").alias("orders"))
                  .orderBy("order_year", "band"))


query("salary_band_by_year", ops=("J01", "X08", "F10", "X09", "G03"), sql=f"""
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS order_year,
       CAST(round(abs(c.c_acctbal) / {BAND_WIDTH}) AS INTEGER) AS band,
       count(*) AS orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE abs(c.c_acctbal) >= {BAND_FLOOR}
GROUP BY 1, 2 ORDER BY 1, 2""")(salary_band_by_year_df)


# ------------------------------------------------------------------ projections / filters

@query("select_filter", ops=("P01", "F01", "F07"), sql="""
SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority
FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) > 1998""")
def select_filter(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    # year(d) > 1998 written as a range so the Parquet scan can use it
    return (o.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
             .filter((F.col("o_orderstatus") == "F") & year_at_least("o_orderdate", 1999)))


@query("year_filter", ops=("F07",), sql="""
SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) >= 1999""")
def year_filter(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
            .filter(year_at_least("o_orderdate", 1999)))


@query("between_flag", ops=("P03", "F05"), sql="""
SELECT l_orderkey, l_linenumber, l_quantity BETWEEN 1 AND 10 AS small_order FROM lineitem""")
def between_flag(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "`l_quantity` between 1 and 10 as small_order")


@query("string_predicate", ops=("F04",), sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_quantity > 45 AND l_discount < 0.02""")
def string_predicate(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "lineitem")
            .filter("l_quantity > 45 and l_discount < 0.02")
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))


@query("abs_cleanse", ops=("P06", "X08"), sql="""
SELECT c_custkey, c_name, abs(c_acctbal) AS c_acctbal FROM customer""")
def abs_cleanse(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return c.withColumn("c_acctbal", F.abs("c_acctbal"))


@query("salary_band", ops=("P05", "F10", "X09", "B12"), sql=f"""
SELECT c_custkey, c_name, abs(c_acctbal) AS balance,
       CAST(round(abs(c_acctbal) / {BAND_WIDTH}) AS INTEGER) AS balance_band
FROM customer WHERE abs(c_acctbal) >= {BAND_FLOOR}""")
def salary_band_q(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name", F.abs("c_acctbal").alias("balance"))
    return (c.filter(F.col("balance") >= BAND_FLOOR)
             .withColumn("balance_band", salary_band("balance", BAND_WIDTH)))


@query("drop_columns", ops=("P07",), sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_returnflag, l_linestatus, l_shipdate FROM lineitem""")
def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    # names that do not exist are ignored, as in DataFrame.drop
    return table(spark, sf, "lineitem").drop("l_tax", "no_such_column")


# ------------------------------------------------------------------ joins

@query("join_inner_aliased", ops=("J01", "P02", "P09"), sql="""
SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, o.o_orderkey AS order_id,
       o.o_orderdate AS order_date, o.o_totalprice AS order_total, c.c_acctbal AS balance
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_inner_aliased(spark: SparkSession, sf: str) -> DataFrame:
    return R.join_aliased(
        table(spark, sf, "orders"), table(spark, sf, "customer"),
        left_alias="o", right_alias="c", on=[("o_custkey", "c_custkey")],
        select={"customer_id": "c.c_custkey", "customer_name": "c.c_name",
                "order_id": "o.o_orderkey", "order_date": "o.o_orderdate",
                "order_total": "o.o_totalprice", "balance": "c.c_acctbal"})


@query("join_multi_key", ops=("J02",), sql=f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey AS partkey, l_suppkey AS suppkey, l_quantity
           FROM lineitem),
     a AS (SELECT partkey, suppkey, avg(l_quantity) AS avg_qty FROM l GROUP BY partkey, suppkey)
SELECT l.l_orderkey, l.l_linenumber, partkey, suppkey, l.l_quantity,
       {fixed_sql('a.avg_qty', 6)} AS pair_avg_qty
FROM l JOIN a USING (partkey, suppkey)""")
def join_multi_key(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"), "l_quantity")
    # many-to-one on (partkey, suppkey): the right side is one row per pair
    pair = R.pre_aggregate(li, ["partkey", "suppkey"], [F.avg("l_quantity").alias("avg_qty")])
    return (R.join_on_names(li, pair, ["partkey", "suppkey"])
             .select("l_orderkey", "l_linenumber", "partkey", "suppkey", "l_quantity",
                     fixed_round("avg_qty", 6).alias("pair_avg_qty")))


@query("join_multi_cond", ops=("J03",), sql="""
SELECT o.o_orderkey, l.l_linenumber, o.o_orderdate, l.l_shipdate
FROM orders o JOIN lineitem l
  ON o.o_orderkey = l.l_orderkey AND year(o.o_orderdate) = year(l.l_shipdate)""")
def join_multi_cond(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    cond = (o.o_orderkey == li.l_orderkey) & (F.year(o.o_orderdate) == F.year(li.l_shipdate))
    return R.join_on(o, li, cond).select("o_orderkey", "l_linenumber", "o_orderdate", "l_shipdate")


@query("join_or", ops=("J04",), sql="""
SELECT e.event_id, c.c_custkey, c.c_name
FROM events e JOIN customer c
  ON e.user_id = c.c_custkey
  OR TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) = c.c_custkey""")
def join_or(spark: SparkSession, sf: str) -> DataFrame:
    # an event is attributed to a customer by its user id or by the id in its props
    e = table(spark, sf, "events").select(
        "event_id", "user_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("prop_k"))
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    out = R.join_any_of(e, c, [("user_id", "c_custkey"), ("prop_k", "c_custkey")])
    return out.select("event_id", "c_custkey", "c_name")


# documents and labels, events and customers: whole tables with keys on either side only

_DOC_JOIN_SQL = """
SELECT d.doc_id, d.source, l.quality, l.toxic FROM documents d {kind} JOIN labels l ON d.doc_id = l.doc_id"""


@query("join_left", ops=("J05",), sql=_DOC_JOIN_SQL.format(kind="LEFT"))
def join_left(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "source")
    return R.join_on_names(d, table(spark, sf, "labels"), ["doc_id"], "left").select("doc_id", "source", "quality", "toxic")


@query("join_right", ops=("J06",), sql="""
SELECT e.event_id, e.user_id, c.c_custkey, c.c_name
FROM events e RIGHT JOIN customer c ON e.user_id = c.c_custkey""")
def join_right(spark: SparkSession, sf: str) -> DataFrame:
    # few users have many events each: written as inner + anti join so AQE can split them
    e = table(spark, sf, "events").select("event_id", "user_id")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return R.outer_join(e, c, [("user_id", "c_custkey")], "right")


@query("join_full", ops=("J07",), sql="""
SELECT c.c_custkey, c.c_nationkey, c.c_name, s.s_suppkey, s.s_nationkey, s.s_name
FROM customer c FULL OUTER JOIN supplier s ON c.c_custkey = s.s_suppkey AND c.c_nationkey = s.s_nationkey""")
def join_full(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_name")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_name")
    return R.outer_join(c, s, [("c_custkey", "s_suppkey"), ("c_nationkey", "s_nationkey")], "full")


_SEMI_SQL = """
SELECT doc_id, source FROM documents d WHERE {neg}EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""


def _semi(how):
    def build(spark: SparkSession, sf: str) -> DataFrame:
        d = table(spark, sf, "documents").select("doc_id", "source")
        return R.join_on_names(d, table(spark, sf, "labels"), ["doc_id"], how)
    return build


query("join_semi", ops=("J08",), sql=_SEMI_SQL.format(neg=""))(_semi("semi"))
query("join_anti", ops=("J09",), sql=_SEMI_SQL.format(neg="NOT "))(_semi("anti"))


@query("join_preaggregated", ops=("J01", "P02", "B13"), sql=f"""
SELECT c.c_custkey, c.nationkey, c.acctbal AS customer_acctbal, s.suppliers,
       {fixed_sql('s.acctbal', 2)} AS supplier_acctbal
FROM (SELECT c_custkey, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer) c
JOIN (SELECT s_nationkey AS nationkey, count(*) AS suppliers, sum(s_acctbal) AS acctbal FROM supplier GROUP BY 1) s
  ON c.nationkey = s.nationkey""")
def join_preaggregated(spark: SparkSession, sf: str) -> DataFrame:
    # both sides have a nationkey and an acctbal; the many side is one row per nation before the join
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    s = R.pre_aggregate(s, ["nationkey"], [F.count(F.lit(1)).alias("suppliers"), F.sum("acctbal").alias("acctbal")])
    out = R.join_aliased(c, s, left_alias="c", right_alias="s", on=[("nationkey", "nationkey")],
                         select={"c_custkey": "c.c_custkey", "nationkey": "c.nationkey", "customer_acctbal": "c.acctbal",
                                 "suppliers": "s.suppliers", "supplier_acctbal": "s.acctbal"})
    return out.withColumn("supplier_acctbal", fixed_round("supplier_acctbal", 2))


# ------------------------------------------------------------------ aggregations

_POPULAR = ("1-URGENT", "5-LOW")


@query("name_popularity", ops=("G01", "F02", "B06"), sql="""
SELECT o_orderpriority, count(*) AS occurrences FROM orders
WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND year(o_orderdate) >= 1997
GROUP BY 1 ORDER BY 1""")
def name_popularity(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return (o.filter(F.col("o_orderpriority").isin(list(_POPULAR)) & year_at_least("o_orderdate", 1997))
             .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("occurrences"))
             .orderBy("o_orderpriority"))


@query("name_popularity_by_year", ops=("G01", "F02", "F07", "B06"), sql="""
SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS occurrences
FROM orders
WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND year(o_orderdate) >= 1997
GROUP BY 1, 2 ORDER BY 1, 2""")
def name_popularity_by_year(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return (o.filter(F.col("o_orderpriority").isin(list(_POPULAR)) & year_at_least("o_orderdate", 1997))
             .groupBy("o_orderpriority", F.year("o_orderdate").alias("order_year"))
             .agg(F.count(F.lit(1)).alias("occurrences"))
             .orderBy("o_orderpriority", "order_year"))


@query("top10_names", ops=("O03", "G01", "B10"), sql="""
SELECT p_name, name_count, CAST(row_number() OVER (ORDER BY name_count DESC, p_name) AS INTEGER) AS rank
FROM (SELECT p_name, count(*) AS name_count FROM part WHERE p_type = 'ECONOMY' GROUP BY p_name)
ORDER BY name_count DESC, p_name LIMIT 10""")
def top10_names(spark: SparkSession, sf: str) -> DataFrame:
    counts = (table(spark, sf, "part").filter(F.col("p_type") == "ECONOMY")
              .groupBy("p_name").agg(F.count(F.lit(1)).alias("name_count")))
    return R.top_k(counts, [F.col("name_count").desc(), F.col("p_name").asc()], 10)


@query("sum_by_dates", ops=("G03", "X03", "X04", "B05", "B08"), sql=f"""
SELECT CAST(start_ts AS DATE) AS start_day, CAST(end_ts AS DATE) AS end_day,
       strftime(CAST(start_ts AS DATE), '%m/%d/%Y') AS Start_Date,
       strftime(CAST(end_ts AS DATE), '%m/%d/%Y') AS End_Date,
       CAST(sum(Duration) AS BIGINT) AS sum_duration,
       {fixed_sql('avg(Duration)', 4)} AS avg_duration,
       count(*) AS trips
FROM {TRIPS_SQL} t GROUP BY 1, 2 ORDER BY 1, 2""")
def sum_by_dates(spark: SparkSession, sf: str) -> DataFrame:
    t = trips(spark, sf)
    days = t.select(parse_date_text("Start_Date").alias("start_day"),
                    parse_date_text("End_Date").alias("end_day"), "Duration")
    # group and sort on real dates; the MM/dd/yyyy text is produced last
    return (days.groupBy("start_day", "end_day")
                .agg(F.sum("Duration").alias("sum_duration"),
                     fixed_round(F.avg("Duration"), 4).alias("avg_duration"),
                     F.count(F.lit(1)).alias("trips"))
                .withColumn("Start_Date", format_date_text("start_day"))
                .withColumn("End_Date", format_date_text("end_day"))
                .orderBy("start_day", "end_day"))


@query("instr_group_avg", ops=("G04", "F08", "X13"), sql=f"""
SELECT p_brand, p_type, {fixed_sql('avg(p_retailprice)', 4)} AS avg_price,
       {fixed_sql('avg(p_size)', 4)} AS avg_size
FROM part WHERE instr(p_name, 'ring') >= 1
GROUP BY p_brand, p_type ORDER BY p_brand, p_type""")
def instr_group_avg(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return (p.filter(F.instr("p_name", "ring") >= 1)
             .groupBy("p_brand", "p_type")
             .agg(fixed_round(F.avg("p_retailprice"), 4).alias("avg_price"),
                  fixed_round(F.avg("p_size"), 4).alias("avg_size"))
             .orderBy("p_brand", "p_type"))


@query("seasonal_avg", ops=("G05", "F03", "X02", "B26"), sql=f"""
SELECT l_returnflag, CAST(month(l_shipdate) AS INTEGER) AS month,
       {fixed_sql('avg(l_extendedprice)', 4)} AS avg_price
FROM lineitem WHERE month(l_shipdate) IN (1, 2, 3)
GROUP BY l_returnflag, month(l_shipdate) ORDER BY 1, 2""")
def seasonal_avg(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "lineitem").createOrReplaceTempView("lineitem_view")
    return spark.sql(f"""
        SELECT l_returnflag, month(l_shipdate) AS month,
               CAST(floor(avg(l_extendedprice) * 10000.0 + 0.5) / 10000.0 AS DOUBLE) AS avg_price
        FROM lineitem_view WHERE month(l_shipdate) IN (1, 2, 3)
        GROUP BY l_returnflag, month ORDER BY l_returnflag, month""")


@query("salary_stats", ops=("G06",), sql=f"""
SELECT {fixed_sql('avg(c_acctbal)', 6)} AS avg_balance, min(c_acctbal) AS min_balance,
       max(c_acctbal) AS max_balance FROM customer""")
def salary_stats(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(fixed_round(F.avg("c_acctbal"), 6).alias("avg_balance"),
                    F.min("c_acctbal").alias("min_balance"),
                    F.max("c_acctbal").alias("max_balance"))


@query("having_alias", ops=("F11", "G07", "B22"), sql=f"""
SELECT {fixed_sql('l_linenumber', 6)} AS l_linenumber, l_returnflag, l_quantity
FROM (SELECT avg(l_linenumber) AS l_linenumber, l_returnflag, l_quantity FROM lineitem
      GROUP BY l_returnflag, l_quantity HAVING avg(l_linenumber) <> 4)""")
def having_alias(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "lineitem").createOrReplaceTempView("lineitem_view")
    # the alias equals a base column; in HAVING it resolves to the aggregate
    agg = spark.sql("""
        SELECT avg(l_linenumber) AS l_linenumber, l_returnflag, l_quantity
        FROM lineitem_view GROUP BY l_returnflag, l_quantity HAVING l_linenumber <> 4""")
    return agg.withColumn("l_linenumber", fixed_round("l_linenumber", 6))


@query("count_rows", ops=("K10",), sql="SELECT count(*) AS row_count FROM lineitem")
def count_rows(spark: SparkSession, sf: str) -> DataFrame:
    return R.count_rows(table(spark, sf, "lineitem"))


@query("distinct_values", ops=("U01",), sql="""
SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders""")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return R.distinct_rows(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("distinct_counts", ops=("G09",), sql="""
SELECT 'customer' AS source, 'c_nationkey' AS column_name, count(DISTINCT c_nationkey) AS distinct_count
FROM customer
UNION ALL
SELECT 'supplier', 's_nationkey', count(DISTINCT s_nationkey) FROM supplier""")
def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return P.distinct_counts([("customer", table(spark, sf, "customer"), "c_nationkey"),
                              ("supplier", table(spark, sf, "supplier"), "s_nationkey")])


# ------------------------------------------------------------------ ordering

@query("first_n_by_key", ops=("K11", "O04", "B11"), sql="""
SELECT * FROM orders ORDER BY o_orderkey LIMIT 20""")
def first_n_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return R.first_n(table(spark, sf, "orders"), [F.col("o_orderkey")], 20)


@query("sort_mixed", ops=("O02", "O01"), sql=f"""
SELECT Trip_ID, End_Date, "Bike_#",
       row_number() OVER (ORDER BY date_trunc('minute', end_ts) DESC, "Bike_#", Trip_ID) AS position
FROM {TRIPS_SQL} t""")
def sort_mixed(spark: SparkSession, sf: str) -> DataFrame:
    t = trips(spark, sf)
    ev_end = parse_timestamp_text("End_Date", TRIP_TEXT_FORMAT)
    keyed = t.select("Trip_ID", "End_Date", "Bike_#", ev_end.alias("_end"))
    # newest end first, then bike, then trip id: a total order on real time
    # (the text form does not sort chronologically)
    out = R.with_global_position(
        keyed, [F.col("_end").desc(), F.col("`Bike_#`").asc(), F.col("Trip_ID").asc()])
    return out.drop("_end")
