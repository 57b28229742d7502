"""The split reader of multi-line JSON against Python's json."""

import json
import os
import random

import pytest

from quarry.sources.json_array import json_records, read_json_array
from quarry.sources.sinks import write_json

from conftest import SF_SMALL


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _value(rng, depth=0):
    texts = ["", "plain", "a,b", "}", "{", "[x]", 'quote " inside', "back\\slash", 'both \\" }', "é\n{\t", "\\\\", '"', ", {"]
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return rng.choice([None, True, False])
    if kind == 1:
        return rng.choice([0, -5, 1.5, 12345678901])
    if kind in (2, 3):
        return rng.choice(texts) * rng.choice([1, 1, 3])
    if kind == 4:
        return [_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(texts) + str(i): _value(rng, depth + 1) for i in range(rng.randrange(4))}


def _write(tmp_path, files):
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode("utf-8"))
    return "file://" + str(tmp_path)


def _read(spark, path):
    return sorted(json.dumps(json.loads(r["record"]), sort_keys=True) for r in json_records(spark, path).collect())


@pytest.mark.parametrize("seed,indent", [(1, None), (2, 2), (3, 7), (4, None)])
def test_every_record_once_whatever_the_splits(spark, tmp_path, small_splits, seed, indent):
    rng = random.Random(seed)
    records = [{"id": i, "v": _value(rng), "w": _value(rng)} for i in range(120)]
    if seed == 4:  # records longer than several splits
        records[5]["v"] = "long } text, " * 200
        records[6]["v"] = [{"deep": ["}"] * 300}]
    parts = [records[:100], records[100:], []]
    path = _write(tmp_path, {f"p{i}.json": json.dumps(p, indent=indent, ensure_ascii=bool(seed % 2)) for i, p in enumerate(parts)} | {"empty.json": ""})
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 10
    assert _read(spark, path) == sorted(json.dumps(r, sort_keys=True) for r in records)


def test_values_one_after_another_and_single_record(spark, tmp_path, small_splits):
    records = [{"a": i, "t": "x } {" * (i % 30)} for i in range(60)]
    path = _write(tmp_path, {"many.json": "\n".join(json.dumps(r, indent=1) for r in records), "one.json": json.dumps({"a": -1, "t": "y"}, indent=4)})
    assert _read(spark, path) == sorted(json.dumps(r, sort_keys=True) for r in [*records, {"a": -1, "t": "y"}])


def test_arrays_of_plain_values(spark, tmp_path):
    path = _write(tmp_path, {"a.json": '[1, "x, }", [2, {"y": 3}], null , true]'})
    assert _read(spark, path) == sorted(json.dumps(v) for v in [1, "x, }", [2, {"y": 3}], None, True])


def test_typed_rows_equal_sparks_reader(spark, tmp_dir, small_splits):
    src = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    write_json(src, tmp_dir, layout="array", single_file=True)
    whole = spark.read.option("multiLine", True).json(tmp_dir)
    ours = read_json_array(spark, tmp_dir)
    assert sorted(map(repr, ours.select(*sorted(ours.columns)).collect())) == sorted(map(repr, whole.select(*sorted(whole.columns)).collect()))
    declared = read_json_array(spark, tmp_dir, schema=src.schema)
    assert declared.schema == src.schema and sorted(declared.collect()) == sorted(src.collect())


def test_record_of_another_type_has_nulls(spark, tmp_path):
    path = _write(tmp_path, {"a.json": '[{"a": 1}, 7, {"a": "x"}, {}]'})
    rows = [r["a"] for r in read_json_array(spark, path, "a int").collect()]
    assert sorted(rows, key=str) == sorted([1, None, None, None], key=str)
    assert os.path.exists(str(tmp_path))
