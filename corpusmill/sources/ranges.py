"""Bounded reads of single files: their first bytes, and rows by byte range.

Tasks open files by :mod:`pyarrow.fs` and read only the bytes they need. A store that only
Spark can open is not reached this way; :func:`reachable` tells, and callers then scan.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes read at a time while nothing but white space was seen.
HEAD = 1 << 12
BYTE_ORDER_MARK = "\ufeff"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address as Spark writes it."""
    return fs.FileSystem.from_uri(path.replace("file:///", "/").replace("file:/", "/"))


def reachable(path: str) -> bool:
    try:
        system, own = opened(path)
        return system.get_file_info(own).type == fs.FileType.File
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False


def first_char(path: str) -> tuple[str | None, int]:
    """First character that is no white space, and the bytes read to find it."""
    system, own = opened(path)
    decoder, read, start = codecs.getincrementaldecoder("utf-8")("replace"), 0, True
    with system.open_input_stream(own, compression="detect") as file:
        while block := file.read(HEAD):
            read += len(block)
            text = decoder.decode(block)
            if start and text:
                text, start = text.removeprefix(BYTE_ORDER_MARK), False
            if text := text.lstrip():
                return text[0], read
    return None, read


def _first_chars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [first_char(f) for f in batch.column("file").to_pylist()]
        yield pa.record_batch(
            [
                batch.column("file"),
                pa.array([c for c, _ in found], pa.string()),
                pa.array([n for _, n in found], pa.int64()),
            ],
            ["file", "first_char", "bytes_read"],
        )


def first_chars(spark: SparkSession, files: list[str]) -> DataFrame:
    """``(file, first_char, bytes_read)``; a task for some files, each read as far as it is blank."""
    names = spark.createDataFrame([(f,) for f in files], "file string")
    dealt = names.repartition(max(1, min(len(files), spark.sparkContext.defaultParallelism * 4)))
    return dealt.mapInArrow(_first_chars, "file string, first_char string, bytes_read long")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, file = None, None
    try:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                values = []
                for row in part.select(["file", "byte_offset", "byte_len"]).to_pylist():
                    if row["file"] != name:
                        if file:
                            file.close()
                        name = row["file"]
                        system, own = opened(name)
                        file = system.open_input_file(own)
                    line = file.read_at(row["byte_len"], row["byte_offset"])
                    if len(line) < row["byte_len"]:
                        raise ValueError(f"{name} ends before byte {row['byte_offset'] + row['byte_len']}")
                    values.append(line.removesuffix(b"\n"))
                yield pa.record_batch(
                    [part.column("file"), part.column("row_id"), pa.array(values, pa.binary())],
                    ["file", "row_id", "value"],
                )
    finally:
        if file:
            file.close()


def lookup_lines(index: DataFrame, ids: DataFrame) -> DataFrame:
    """``(file, row_id, value)`` of the asked lines, read by their byte ranges alone.

    ``index`` is :func:`~corpusmill.sources.lines.line_index` or a stored copy of it; ``ids`` has
    ``row_id``, and ``file`` where row numbers are asked for in some files only. A line asked for
    twice comes once; one that is not there gives no row. Rows are dealt by file and offset, so
    that the lines of a large file are read by many tasks, each from front to back.
    """
    keys = [c for c in ("file", "row_id") if c in ids.columns]
    asked = index.join(ids.select(*keys).distinct(), keys).select("file", "row_id", "byte_offset", "byte_len")
    dealt = asked.repartitionByRange("file", "byte_offset").sortWithinPartitions("file", "byte_offset")
    found = dealt.mapInArrow(_rows, "file string, row_id long, value binary")
    return found.withColumn("value", F.make_valid_utf8(F.col("value").cast("string")))
