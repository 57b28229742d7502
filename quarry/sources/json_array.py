"""Multi-line JSON read by many tasks.

Spark reads a file of one JSON array in one task, since a record may start
anywhere and a bracket may stand inside a string. Here the text source cuts
the file at closing braces (``lineSep``), which it does split over tasks and
for every file system Spark knows, and a scan finds the records:

1. each split is a function from the state before it (inside a string or not,
   bracket depth) to the state after it: the parity of its quotes and the
   change of depth for either start. The functions compose, so a running sum
   over one small row per split gives the state at which each split starts;
2. each split then cuts its text at the commas of the outermost array. What
   lies between its first and last cut are whole records; the two ends are
   joined with the neighbouring splits' ends (two short rows per split).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

QUOTE, BACKSLASH, COMMA = 0x22, 0x5C, 0x2C
STEP = np.zeros(256, dtype=np.int64)
STEP[[0x5B, 0x7B]], STEP[[0x5D, 0x7D]] = 1, -1
BLANK = b" \t\r\n"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between closing braces, in order within a split: file, split (its first byte), piece."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                       (F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length") >= F.col("_metadata.file_size")).alias("last"),
                       F.col("value").alias("piece"))


def _runs(batch: pa.RecordBatch):
    """(file, split, is the file's last split, bytes) of the runs of rows of one split. The brace is put back
    behind every piece; one too many at the end of a file is harmless."""
    files, splits = batch.column("file").to_pylist(), batch.column("split").to_pylist()
    lasts, pieces = batch.column("last").to_pylist(), batch.column("piece").to_pylist()
    at = 0
    while at < len(pieces):
        end = at + 1
        while end < len(pieces) and splits[end] == splits[at] and files[end] == files[at]:
            end += 1
        yield files[at], splits[at], lasts[at], ("}".join(pieces[at:end]) + "}").encode("utf-8")
        at = end


def _quotes(data: np.ndarray) -> np.ndarray:
    """Places of the quotes that open or close a string: those after an even number of backslashes.
    A run of pieces starts behind a brace, so no backslash before it counts."""
    quotes = np.flatnonzero(data == QUOTE)
    slash = np.append(np.diff(np.flatnonzero(np.append(data, 0) != BACKSLASH), prepend=-1) - 1, 0)
    plain = np.flatnonzero(data != BACKSLASH)
    before = np.zeros(len(data), dtype=np.int64)
    before[plain] = slash[:len(plain)]
    return quotes[before[quotes] % 2 == 0]


def _outside(data: np.ndarray, inside: bool) -> np.ndarray:
    """bool per byte: not part of a string, given whether the run starts inside one."""
    toggles = np.zeros(len(data) + 1, dtype=np.int64)
    toggles[_quotes(data) + 1] = 1
    return (np.cumsum(toggles)[:-1] + inside) % 2 == 0


def _summaries(batches):
    """file, split, quotes modulo 2, change of depth if the split starts outside or inside a
    string, and its first byte that is no blank: one row per run of rows (a split has several)."""
    for batch in batches:
        rows = []
        for file, split, _, raw in _runs(batch):
            data = np.frombuffer(raw, np.uint8)
            steps, out = STEP[data], _outside(data, False)
            head = raw.lstrip(BLANK)[:1].decode("latin-1")
            rows.append((file, split, len(_quotes(data)) % 2, int(steps[out].sum()), int(steps[~out].sum()), head))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file", "split", "odd", "outside", "inside", "head"])


def _composed(runs: Column) -> Column:
    """The summaries of a split's runs, in order, as one."""
    def step(f, r):
        odd = f["odd"] == 1
        return F.struct(f["odd"].bitwiseXOR(r["odd"]).alias("odd"),
                        (f["outside"] + F.when(odd, r["inside"]).otherwise(r["outside"])).alias("outside"),
                        (f["inside"] + F.when(odd, r["outside"]).otherwise(r["inside"])).alias("inside"),
                        F.when(f["head"] != "", f["head"]).otherwise(r["head"]).alias("head"))
    zero = F.lit(0).cast("long")
    return F.aggregate(runs, F.struct(zero.alias("odd"), zero.alias("outside"), zero.alias("inside"), F.lit("").alias("head")), step)


def split_states(pieces: DataFrame) -> DataFrame:
    """file, split, in_string, depth, base: the state in which each split starts, and the depth at
    which records lie (1 in an array, 0 for values one after another)."""
    summary = pieces.mapInArrow(_summaries, "file string, split long, odd long, outside long, inside long, head string") \
        .withColumn("at", F.monotonically_increasing_id())
    runs = F.array_sort(F.collect_list(F.struct("at", "odd", "outside", "inside", "head")))
    splits = summary.groupBy("file", "split").agg(runs.alias("runs")).select("file", "split", _composed(F.col("runs")).alias("f")).select("file", "split", "f.*")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    entered = splits.withColumn("in_string", F.coalesce(F.sum("odd").over(before) % 2 == 1, F.lit(False)))
    change = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    whole = Window.partitionBy("file").orderBy("split")
    head = F.first(F.when(F.col("head") != "", F.col("head")), ignorenulls=True).over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return entered.withColumn("change", change).select(
        "file", "split", "in_string", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"),
        F.when(head == "[", 1).otherwise(0).alias("base"))


CUT = "file string, split long, place int, kind string, record string"


class _Cutter:
    """Cuts the text of one split into records; keeps the open end between batches."""

    def __init__(self, in_string: bool, depth: int, base: int):
        self.inside, self.depth, self.base, self.open, self.cuts = in_string, depth, base, [], 0

    def feed(self, raw: bytes):
        """The texts that end in this run, up to the last cut."""
        data = np.frombuffer(raw, np.uint8)
        out = _outside(data, self.inside)
        depth = self.depth + np.cumsum(np.where(out, STEP[data], 0))
        was = np.concatenate([[self.depth], depth[:-1]])
        if self.base:
            cut = out & (((data == COMMA) & (depth == 1)) | (np.minimum(was, depth) == 0) & (np.maximum(was, depth) == 1) & (was != depth))
            ends, begins = np.flatnonzero(cut), np.flatnonzero(cut) + 1
        else:  # a value ends with the bracket that closes it
            ends = begins = np.flatnonzero(out & (depth == 0) & (was == 1)) + 1
        at = 0
        for end, begin in zip(ends.tolist(), begins.tolist()):
            yield b"".join([*self.open, raw[at:end]])
            self.open, at = [], begin
        self.open.append(raw[at:])
        if len(data):
            self.depth, self.inside = int(depth[-1]), bool(self.inside ^ (len(_quotes(data)) % 2 == 1))


def _records(batches):
    """Rows of CUT: kind ``whole`` (between two cuts of a split), ``end`` (up to the first cut), ``start`` (from the last one), ``part`` (no cut)."""
    now, cutter, final = None, None, False

    def close():
        text = b"".join(cutter.open)
        text = text[:-1] if final and text.endswith(b"}") else text  # the brace that was put back after the end
        return (*now, 1, "start" if cutter.cuts else "part", text.decode("utf-8"))

    for batch in batches:
        rows = []
        state = list(zip(*[batch.column(c).to_pylist() for c in ("file", "split", "in_string", "depth", "base")]))
        found = {s[:2]: s[2:] for s in dict.fromkeys(state)}
        for file, split, last, raw in _runs(batch):
            if (file, split) != now:
                if now is not None:
                    rows.append(close())
                now, cutter, final = (file, split), _Cutter(*found[file, split]), last
            for text in cutter.feed(raw):
                rows.append((file, split, 0, "whole" if cutter.cuts else "end", text.decode("utf-8")))
                cutter.cuts += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()))],
                                             names=["file", "split", "place", "kind", "record"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) if i != 2 else pa.array([v], pa.int32()) for i, v in enumerate(close())],
                                         names=["file", "split", "place", "kind", "record"])


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """One text column ``record`` with the elements of the JSON array in each
    file of ``path`` (or its top-level values, if a file is none), whatever
    their layout. Strings may hold brackets, commas, escaped quotes and
    line breaks. A record longer than a split is joined from its parts.
    Empty files and empty arrays give no rows. The order of rows is not that
    of the file. The files are read twice; they must not change in between.
    A run without a closing brace (an array of numbers) is one piece."""
    pieces = _pieces(spark, path)
    states = F.broadcast(split_states(pieces))  # one row per split
    cut = pieces.join(states, ["file", "split"]).mapInArrow(_records, CUT)
    whole = cut.where("kind = 'whole'").select("record")
    ends = cut.where("kind <> 'whole'")
    order = Window.partitionBy("file").orderBy("split", "place")  # two rows per split
    joined = ends.withColumn("value", F.sum((F.col("kind") == "start").cast("int")).over(order)) \
        .groupBy("file", "value").agg(F.array_sort(F.collect_list(F.struct("split", "place", "record"))).alias("parts")) \
        .select(F.array_join(F.col("parts.record"), "").alias("record"))
    return whole.unionByName(joined).where(F.trim(F.regexp_replace("record", r"[\s\x{FEFF}]+", " ")) != "")


def inferred_json_schema(records: DataFrame) -> str:
    """A DDL type that holds every record, by one mergeable aggregate; decimals become doubles, as Spark infers them."""
    ddl = records.select(F.schema_of_variant_agg(F.parse_json("record")).alias("ddl")).first()["ddl"]
    ddl = re.sub(r"DECIMAL\(\d+,\s?\d+\)|FLOAT", "DOUBLE", (ddl or "VOID").replace("OBJECT<", "STRUCT<"))
    return re.sub(r"\bVOID\b", "STRING", ddl)


def read_json_array(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The records of multi-line JSON files as typed rows, read by as many
    tasks as the files have splits. ``schema`` is a struct type or a DDL list
    of columns; without it the type is inferred by one more pass. A record
    that is no JSON of that type has nulls, as in ``spark.read.json``."""
    records = json_records(spark, path)
    if schema is None:
        kind = inferred_json_schema(records)
        if not kind.startswith("STRUCT<"):
            raise ValueError(f"the records are no objects but {kind}")
        return records.select(F.from_json("record", kind).alias("r")).select("r.*")
    return records.select(F.from_json("record", schema).alias("r")).select("r.*")
