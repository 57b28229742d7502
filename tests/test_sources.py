"""Readers and writers on literal edge rows (dirty text, layouts, modes)."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from quarry.sources import readers as RD
from quarry.sources import sinks as SK


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


ZIP_SCHEMA = StructType([StructField("id", IntegerType()), StructField("Zip_Code", IntegerType())])


def test_declared_csv_int_dirty_values(spark, tmp_path):
    path = _write(tmp_path, "z.csv", "id,Zip_Code\n1,94127\n2,nil\n3,\n4,94127.0\n")
    rows = RD.read_csv(spark, path, schema=ZIP_SCHEMA).orderBy("id").collect()
    assert [r.Zip_Code for r in rows] == [94127, None, None, None]
    kept = RD.read_csv(spark, path, schema=ZIP_SCHEMA, mode="DROPMALFORMED").orderBy("id").collect()
    assert [r.id for r in kept] == [1, 3]


def test_string_read_then_try_cast_counts_rejects(spark, tmp_path):
    path = _write(tmp_path, "z.csv", "id,Zip_Code\n1,94127\n2,nil\n3,\n4,94127.0\n")
    raw = RD.read_csv(spark, path)  # untyped: every column a string
    assert all(t == "string" for _, t in raw.dtypes)
    typed, rejects = RD.typed_with_rejects(raw, {"id": "int", "Zip_Code": "int"})
    assert [r.Zip_Code for r in typed.orderBy("id").collect()] == [94127, None, None, None]
    # "nil" and "94127.0" are rejected; the empty field is a real null
    assert typed.agg(rejects).first()["rejected_rows"] == 2


def test_declared_schema_extra_field_positional(spark, tmp_path):
    path = _write(tmp_path, "t.csv", "a,b\n1,x\n")
    schema = "a INT, b STRING, Maintenance INT"
    # positional matching (Spark's default) leaves the extra field null
    row = spark.read.option("header", True).schema(schema).csv(path).first()
    assert row.Maintenance is None and row.a == 1
    # our reader checks header names against the schema and refuses the mismatch
    with pytest.raises(Exception):
        RD.read_csv(spark, path, schema=schema, enforce_header=True).collect()


def test_declared_json_int(spark, tmp_path):
    path = _write(tmp_path, "j.json",
                  '{"Zip_Code": "94127"}\n{"Zip_Code": "nil"}\n{}\n{"Zip_Code": 5}\n')
    vals = [r.Zip_Code for r in RD.read_json(spark, path, schema="Zip_Code INT").collect()]
    assert vals == [None, None, None, 5]


def test_multiline_on_json_lines_reads_first_record_only(spark, tmp_path):
    path = _write(tmp_path, "l.json", "".join(f'{{"a": {i}}}\n' for i in range(4)))
    assert RD.read_json(spark, path, layout="lines").count() == 4
    assert RD.read_json(spark, path, layout="array").count() == 1


def test_multiline_array_reads_all(spark, tmp_path):
    path = _write(tmp_path, "a.json", '[\n {"a": 1},\n {"a": 2}\n]\n')
    assert sorted(r.a for r in RD.read_json(spark, path, layout="array").collect()) == [1, 2]


def test_json_array_layout_round_trip(spark, tmp_dir):
    df = spark.range(0, 57, numPartitions=5).withColumn("s", F.concat(F.lit("v"), F.col("id")))
    SK.write_json(df, tmp_dir, layout="array")
    back = RD.read_json(spark, tmp_dir, layout="array")
    assert sorted(tuple(r) for r in back.select("id", "s").collect()) == \
        sorted(tuple(r) for r in df.collect())


def test_text_sinks_keep_microseconds(spark, tmp_dir):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:07.179575' AS ts")
    SK.write_json(df, tmp_dir + "/j")
    assert RD.read_json(spark, tmp_dir + "/j", schema="ts TIMESTAMP_NTZ").first().ts.microsecond == 179575
    SK.write_csv(df, tmp_dir + "/c")
    assert RD.read_csv(spark, tmp_dir + "/c", schema="ts TIMESTAMP_NTZ").first().ts.microsecond == 179575


def test_default_mode_fails_if_path_exists(spark, tmp_dir):
    df = spark.range(3)
    SK.write_parquet(df, tmp_dir, mode="errorifexists")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        SK.write_parquet(df, tmp_dir, mode="errorifexists")
    SK.write_parquet(df, tmp_dir)  # overwrite by default: reruns succeed
    assert spark.read.parquet(tmp_dir).count() == 3


def test_single_file_option(spark, tmp_path):
    out = str(tmp_path / "one")
    SK.write_csv(spark.range(100).repartition(7), out, single_file=True)
    assert len(glob.glob(os.path.join(out, "part-*"))) == 1
    multi = str(tmp_path / "many")
    SK.write_csv(spark.range(100).repartition(7), multi)
    assert len(glob.glob(os.path.join(multi, "part-*"))) == 7


def test_normalise_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`Trip ID` int, `Bike #` int")
    assert RD.normalise_columns(df).columns == ["Trip_ID", "Bike_#"]


def test_untyped_csv_options_as_kwargs(spark, tmp_path):
    path = _write(tmp_path, "s.csv", "station_id,name\n2,San Jose\n")
    df = spark.read.format("csv").load(path, header=True)
    assert df.dtypes == [("station_id", "string"), ("name", "string")]
    out = df.selectExpr("station_id as Terminal", "name as Maintenance_Station")
    assert out.first().asDict() == {"Terminal": "2", "Maintenance_Station": "San Jose"}


def test_direct_path_sql(spark, tmp_dir):
    SK.write_parquet(spark.range(5), tmp_dir)
    assert RD.read_path_sql(spark, "parquet", tmp_dir).count() == 5
    with pytest.raises(ValueError):
        RD.read_path_sql(spark, "exe", tmp_dir)
