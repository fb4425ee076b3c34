"""JSON array files, read in splits rather than one file per task.

A file is cut at every comma, and a task reads the pieces of its splits in order. A split may start
inside a string or outside, at any depth, so a first scan follows it for both cases and notes, for
each depth, how many commas lie there outside strings, and which is the first and the last. A
small table with a row per split carries state, depth and number of elements along each file.

Elements between two such commas of a split are then put together by the task that reads them,
and never leave it. Only the pieces before the first and behind the last comma of a split are
grouped, to be joined with those of its neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions.strict_json import parse_line
from corpusmill.functions.text import strip
from corpusmill.operators.steps import once

SPLIT = ["h", "block"]
QUOTE, ESCAPE = ord('"'), ord("\\")
STEPS = np.zeros(256, np.int64)
STEPS[[*b"[{"]] = 1
STEPS[[*b"]}"]] = -1


def _follow(values: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces with their commas: text, quotes so far (0 or 1) and depth step at each byte, commas."""
    text = b",".join([*values, b""])
    codes = np.frombuffer(text, np.uint8)
    place = np.arange(len(codes))
    other = np.maximum.accumulate(np.where(codes != ESCAPE, place, -1))
    # A quote behind an odd run of escapes opens or closes nothing.
    escapes = place - 1 - np.append(-1, other[:-1])
    odd = np.cumsum((codes == QUOTE) & (escapes % 2 == 0)) % 2
    commas = np.cumsum(np.fromiter(map(len, values), np.int64, len(values)) + 1) - 1
    return text, odd, STEPS[codes], commas


class _Split:
    """A split followed from outside (0) and from inside (1) a string."""

    def __init__(self):
        self.odd = 0
        self.depth = [0, 0]
        # For each start: depth to the number, the first and the last row of commas there.
        self.commas: list[dict[int, list[int]]] = [{}, {}]

    def read(self, values: list[bytes], rows: np.ndarray) -> None:
        _, odd, steps, ends = _follow(values)
        for start in (0, 1):
            outside = odd == start ^ self.odd
            levels = np.cumsum(np.where(outside, steps, 0)) + self.depth[start]
            free = outside[ends]
            at, own = levels[ends[free]], rows[free]
            for level, first, n in zip(*np.unique(at, return_index=True, return_counts=True)):
                last = int(own[np.flatnonzero(at == level)[-1]])
                seen = self.commas[start].setdefault(int(level), [0, int(own[first]), last])
                seen[0], seen[2] = seen[0] + int(n), last
            self.depth[start] = int(levels[-1])
        self.odd ^= int(odd[-1])

    def row(self, name: tuple[int, int]) -> tuple:
        commas = [
            {"start": s, "level": d, "n": n, "first": first, "last": last}
            for s in (0, 1)
            for d, (n, first, last) in self.commas[s].items()
        ]
        return (*name, self.odd, *self.depth, commas)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], slice]]:
    """Rows of a batch that belong to one split, one after the other."""
    h, block = (batch.column(c).to_numpy() for c in SPLIT)
    edges = np.flatnonzero((np.diff(h) != 0) | (np.diff(block) != 0)) + 1
    for a, b in zip([0, *edges], [*edges, len(h)]):
        if a < b:
            yield (int(h[a]), int(block[a])), slice(a, b)


COMMAS = "array<struct<start:int,level:long,n:long,first:long,last:long>>"


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    kinds.append(pa.list_(pa.struct([("start", pa.int32()), *((c, pa.int64()) for c in ("level", "n", "first", "last"))])))
    name, split, done = None, _Split(), []
    for batch in batches:
        values = batch.column("value").cast(pa.binary()).to_pylist()
        rows = batch.column("seq").to_numpy()
        for own, part in _runs(batch):
            if own != name:
                if name:
                    done.append(split.row(name))
                name, split = own, _Split()
            split.read(values[part], rows[part])
    if name:
        done.append(split.row(name))
        columns = [pa.array(c, k) for c, k in zip(zip(*done), kinds)]
        yield pa.record_batch(columns, [*SPLIT, "odd", "if_out", "if_in", "commas"])


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole elements of a split: its rows start behind a comma between elements and end at one."""
    name, held, odd, depth, k = None, [], 0, 0, 0
    for batch in batches:
        pieces = batch.column("value").cast(pa.binary()).to_pylist()
        found = []
        for own, part in _runs(batch):
            if own != name:
                name, held, odd, depth, k = own, [], 0, 0, 0
            text, quotes, steps, commas = _follow(pieces[part])
            outside = quotes == odd
            levels = np.cumsum(np.where(outside, steps, 0)) + depth
            start = 0
            for end in commas[outside[commas] & (levels[commas] == 0)].tolist():
                found.append((*own, k, b"".join([*held, text[start:end]])))
                held, start, k = [], end + 1, k + 1
            if start < len(text):
                held.append(text[start:])
            odd, depth = odd ^ int(quotes[-1]), int(levels[-1])
        if found:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), kinds)], [*SPLIT, "k", "value"])


def _carried(spark: SparkSession, path: str | list[str], pieces: DataFrame) -> DataFrame:
    """A row for each split: what it starts with, and its commas between elements."""
    schema = f"h long, block long, odd long, if_out long, if_in long, commas {COMMAS}"
    profiles = pieces.select(*SPLIT, "seq", "value").mapInArrow(_profiles, schema)
    # The names of files travel here, not with each piece.
    file = F.col("_metadata.file_path")
    names = spark.read.format("binaryFile").load(path).select(file.alias("file"), F.xxhash64(file).alias("h"))
    of_file = Window.partitionBy("file")
    earlier = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(earlier) % 2, F.lit(0))
    change = F.expr("if(inside = 0, if_out, if_in)")
    there = F.filter("commas", lambda c: (c["start"] == F.col("inside")) & (c["level"] + F.col("depth") == 1))
    ends = F.coalesce(F.col("at")["n"], F.lit(0))
    return (
        profiles.join(names, "h")
        .withColumn("inside", inside)
        .withColumn("depth", F.coalesce(F.sum(change).over(earlier), F.lit(0)))
        .withColumn("end_depth", F.sum(change).over(of_file))
        .withColumn("at", F.get(there, F.lit(0)))
        .select(
            *SPLIT,
            "file",
            "end_depth",
            F.coalesce(F.sum(ends).over(earlier), F.lit(0)).alias("base"),
            F.sum(ends).over(of_file).alias("last_idx"),
            ends.alias("n"),
            "at.first",
            "at.last",
        )
    )


def array_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Source text of each top-level element: ``(file, idx, last_idx, end_depth, value)``.

    ``idx`` counts from 0; ``end_depth`` is the bracket depth at the end of the file. The table of
    splits (some 200 bytes for 128 MB of text) is sent to every task.
    """
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    pieces = spark.read.text(path, lineSep=",").select(
        F.xxhash64(file).alias("h"), block.alias("block"), F.monotonically_increasing_id().alias("seq"), "value"
    )
    carried = F.broadcast(_carried(spark, path, pieces))
    placed = pieces.join(carried, SPLIT, "left")
    rows = ["file", "idx", "last_idx", "end_depth", "value"]

    between = F.col("seq").between(F.col("first") + 1, F.col("last"))
    whole = placed.filter(between).select(*SPLIT, "value").mapInArrow(
        _elements, "h long, block long, k long, value binary"
    )
    whole = whole.join(carried, SPLIT).withColumn("idx", F.col("base") + 1 + F.col("k"))
    whole = whole.withColumn("value", F.col("value").cast("string")).select(*rows)

    lost = F.raise_error("input splits changed while they were read").cast("bigint")
    behind = F.when(F.col("seq") > F.col("last"), F.col("n")).otherwise(0)
    idx = F.when(F.col("base").isNull(), lost).otherwise(F.col("base") + behind)
    crossing = (
        placed.filter(~F.coalesce(between, F.lit(False)))
        .withColumn("idx", idx)
        .groupBy("file", "idx", "last_idx", "end_depth")
        .agg(F.sort_array(F.collect_list(F.struct("block", "seq", "value"))).alias("parts"))
    )
    text = F.array_join(F.transform("parts", lambda p: p["value"]), ",")
    return crossing.withColumn("value", text).select(*rows).unionByName(whole)


def read_json_array(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per element of each JSON array file: ``(file, idx, v VARIANT)``.

    A file that is not one valid JSON array fails the query.
    """
    text = strip(F.col("value"))
    bare = F.when(F.col("idx") == 0, F.regexp_replace(text, r"\A\[", "")).otherwise(text)
    bare = F.when(
        F.col("idx") == F.col("last_idx"), F.regexp_replace(bare, r"\]\z", "")
    ).otherwise(bare)
    closed = ((F.col("idx") > 0) | F.startswith(text, F.lit("["))) & (
        (F.col("idx") < F.col("last_idx")) | F.endswith(text, F.lit("]"))
    ) & ((F.col("last_idx") > 0) | (F.length(text) > 1)) & (F.col("end_depth") == 0)
    empty = (F.col("last_idx") == 0) & (strip(F.col("bare")) == "")
    listed = (
        array_elements(spark, path)
        .withColumn("closed", closed)
        .withColumn("bare", bare)
        .filter(~(F.col("closed") & empty))
    )
    broken = F.raise_error(F.concat(F.lit("not a JSON array: "), "file", F.lit(", element "), "idx"))
    return once(listed, "parsed", parse_line(F.col("bare"))).select(
        "file",
        "idx",
        F.when(F.col("closed") & F.col("parsed").isNotNull(), F.col("parsed"))
        .otherwise(broken)
        .alias("v"),
    )
