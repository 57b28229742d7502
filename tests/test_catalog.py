"""Catalog and session operations."""

import pytest

from quarry.sources import catalog as C
from quarry.sources import sinks as SK


def test_workspace_reset_is_idempotent(spark):
    C.reset_workspace(spark, "quarry_t_reset")
    SK.save_table(spark.range(3), "quarry_t_reset.t1")
    C.reset_workspace(spark, "quarry_t_reset")
    assert C.list_tables(spark, "quarry_t_reset").where("not isTemporary").count() == 0
    assert C.current_database(spark) == "quarry_t_reset"
    spark.sql("USE default")


def test_list_describe_drop(spark):
    C.create_schema(spark, "quarry_t_cat", use=False)
    SK.save_table(spark.range(3).withColumnRenamed("id", "k"), "quarry_t_cat.t2")
    names = [r.tableName for r in C.list_tables(spark, "quarry_t_cat").collect()]
    assert "t2" in names
    desc = C.describe_table(spark, "quarry_t_cat.t2").collect()
    assert desc[0].col_name == "k" and desc[0].data_type == "bigint"
    ext = [r.col_name for r in C.describe_table(spark, "quarry_t_cat.t2", extended=True).collect()]
    assert "Location" in ext or "Type" in ext
    C.drop_table(spark, "quarry_t_cat.t2")
    C.drop_table(spark, "quarry_t_cat.t2")  # IF EXISTS: second drop is fine
    assert C.list_tables(spark, "quarry_t_cat").count() == 0


def test_overwrite_replaces_table_schema(spark):
    C.create_schema(spark, "quarry_t_cat", use=False)
    SK.save_table(spark.range(3), "quarry_t_cat.v")
    SK.save_table(spark.range(2).selectExpr("cast(id as string) as s", "id * 2 as d"), "quarry_t_cat.v")
    assert spark.read.table("quarry_t_cat.v").columns == ["s", "d"]


def test_literal_one_row_relation(spark):
    assert spark.sql("""select "it's one row" AS msg""").first().msg == "it's one row"


def test_schema_ddl(spark):
    df = spark.createDataFrame([(1, "a")], "`Bike #` int, s string")
    ddl = C.schema_ddl(df)
    assert "`Bike #` INT" in ddl


def test_ansi_setting(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        assert spark.sql("select cast('x' as int) as v").first().v is None
        spark.conf.set("spark.sql.ansi.enabled", "true")
        with pytest.raises(Exception):
            spark.sql("select cast('x' as int) as v").collect()
        assert spark.sql("select try_cast('x' as int) as v").first().v is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_bucketed_tables_join_without_shuffle(spark):
    from quarry.plans.inspect import plan_text
    from quarry.session import session_table
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    to, tc = session_table(spark, "orders_b"), session_table(spark, "customer_b")
    SK.save_table(o.withColumnRenamed("o_custkey", "custkey"), to, bucket_by=(8, ["custkey"]))
    SK.save_table(c.withColumnRenamed("c_custkey", "custkey"), tc, bucket_by=(8, ["custkey"]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force a sort-merge join
        j = spark.read.table(to).join(spark.read.table(tc), "custkey")
        text = plan_text(j, "simple")
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert j.count() == o.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
