"""Line-oriented text input."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions.text import nonblank, strip
from corpusmill.operators.ranks import block_offsets
from corpusmill.sources.ranges import first_chars, reachable

BLOCK = ["file", "block"]


def _scan(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """``seq`` follows the line order inside a file block; it is taken on the scan itself."""
    return spark.read.options(**options).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of a corpus as ``(file, block, seq, value)``, cut at ``\\n``, ``\\r\\n`` or ``\\r``."""
    return _scan(spark, path)


def number_lines(lines: DataFrame, out: str = "line_no") -> DataFrame:
    """Add the 1-based line number over all files in path order.

    Lines and the table of their blocks are parts of one lazy plan, so they see the same
    splits whenever it runs; a line whose block is not in the table fails the query. The table
    has one row per input split (some 150 bytes for 128 MB of text, 120 MB for 100 TB) and is
    sent to every task; the text is not shuffled.
    """
    blocks = lines.groupBy(*BLOCK).agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq")
    )
    offsets = block_offsets(blocks, BLOCK, "n", "before").drop("n")
    lost = F.raise_error(F.concat(F.lit("input splits changed while it was read: "), "file"))
    number = F.col("before") + F.col("seq") - F.col("first_seq") + 1
    return (
        lines.join(F.broadcast(offsets), BLOCK, "left")
        .withColumn(out, F.when(F.col("before").isNotNull(), number).otherwise(lost.cast("bigint")))
        .drop("before", "first_seq")
    )


def line_index(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Start of every line: ``(file, row_id, byte_offset, byte_len)``, rows counted from 0.

    Lines end at ``\\n`` only. ``byte_len`` counts the newline; a last line without one is
    found by the file length.
    """
    sizes = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("seq"),
        (F.octet_length("value") + 1).cast("bigint").alias("byte_len"),
    )
    blocks = sizes.groupBy(*BLOCK).agg(
        F.count(F.lit(1)).alias("n"), F.sum("byte_len").alias("bytes")
    )
    by_file = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = blocks.select(
        *BLOCK,
        F.coalesce(F.sum("n").over(by_file), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("bytes").over(by_file), F.lit(0)).alias("bytes_before"),
    )
    # A block is at most one input split, so its window partition is bounded; text stays out.
    in_block = Window.partitionBy(*BLOCK).orderBy("seq")
    earlier = in_block.rowsBetween(Window.unboundedPreceding, -1)
    byte_offset = F.col("bytes_before") + F.col("bytes_local")
    return (
        sizes.withColumn("rows_local", F.row_number().over(in_block) - 1)
        .withColumn("bytes_local", F.coalesce(F.sum("byte_len").over(earlier), F.lit(0)))
        .join(offsets, BLOCK)
        .select(
            "file",
            (F.col("rows_before") + F.col("rows_local")).alias("row_id"),
            byte_offset.alias("byte_offset"),
            F.least("byte_len", F.col("file_size") - byte_offset).alias("byte_len"),
        )
    )


def _layout(first_char: Column) -> Column:
    return F.when(first_char == "[", "array").otherwise("jsonl")


def _input_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files of an input, an empty one included; the driver lists them anyway."""
    return [re.sub("^file:/+", "file:/", f) for f in spark.read.text(path).inputFiles()]


def _scanned_chars(spark: SparkSession, files: list[str]) -> DataFrame:
    """``(file, first_char)`` by a scan, for stores that only Spark opens."""
    char = F.substring(strip(F.col("value")), 1, 1)
    filled = nonblank(F.col("value"))
    return (
        read_lines(spark, files)
        .groupBy("file")
        .agg(F.min_by(F.when(filled, char), F.when(filled, F.struct("block", "seq"))).alias("first_char"))
    )


def layouts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, layout)`` of every file, an empty one included.

    ``array`` when the first non-blank character is ``[``, else ``jsonl``. Of each file the first
    bytes are read; a file is read on only as far as it is blank.
    """
    files = _input_files(spark, path)
    if files and reachable(files[0]):
        seen = first_chars(spark, files)
    else:
        names = spark.createDataFrame([(f,) for f in files], "file string")
        seen = names.join(_scanned_chars(spark, files), "file", "left") if files else names.withColumn("first_char", F.lit(None))
    return seen.select("file", _layout(F.col("first_char")).alias("layout"))


def files_by_layout(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Paths of the files of each layout, from one look at their first bytes."""
    found: dict[str, list[str]] = {"array": [], "jsonl": []}
    for row in layouts(spark, path).collect():
        found[row.layout].append(row.file)
    return found


def detect_layout(spark: SparkSession, path: str) -> str:
    """Layout of one file."""
    found = [row.layout for row in layouts(spark, path).collect()]
    return found[0] if found else "jsonl"
