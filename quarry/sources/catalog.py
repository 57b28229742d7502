"""Catalog and session operations (databases, tables, schema inspection).

OSS Spark has a two-level namespace (database.table); a workspace reset
drops and recreates the database, which covers what a catalog reset does
on platforms that have a third level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _ident(name: str) -> str:
    return name if name.startswith("`") else f"`{name}`"


def create_schema(spark: SparkSession, db: str, *, use: bool = True) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(db)}")
    if use:
        spark.sql(f"USE {_ident(db)}")
    return db


def reset_workspace(spark: SparkSession, db: str) -> str:
    """Idempotent reset: drop the database with everything in it, recreate, use."""
    spark.sql(f"DROP DATABASE IF EXISTS {_ident(db)} CASCADE")
    return create_schema(spark, db)


def list_tables(spark: SparkSession, db: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {_ident(db)}") if db else spark.sql("SHOW TABLES")


def current_database(spark: SparkSession) -> str:
    return spark.sql("SELECT current_database() AS db").first()["db"]


def describe_table(spark: SparkSession, table: str, *, extended: bool = False) -> DataFrame:
    return spark.sql(f"DESCRIBE {'EXTENDED ' if extended else ''}{table}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def schema_ddl(df: DataFrame) -> str:
    """The frame's schema as a DDL string (usable in ``read_csv(schema=...)``)."""
    return df.schema.toDDL()
