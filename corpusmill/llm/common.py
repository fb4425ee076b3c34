"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import drop_path, scratch_path


def whole_text(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    ``lower`` would also change letters outside ASCII; it is used where there are none.
    """
    plain = F.octet_length(col) == F.length(col)
    by_letter = F.translate(col, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(col)).otherwise(by_letter)


def remainder(name: str, by: int) -> Column:
    """crc32 of an id as text, modulo ``by``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))) % by


def kept(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it back: it survives lost executors.

    The path comes along, so that a caller who has done with the table can remove it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(df: DataFrame, path: str) -> None:
    drop_path(df.sparkSession, path)


class Scratch:
    """Tables written on the way to a result; they go together at the end, after an error too."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        for path in self.paths:
            drop_path(self.spark, path)


class WordIds(dict):
    """64-bit hashes of words, each made once while it is remembered."""

    def __init__(self, most: int = 100_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def byte_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """Texts of a batch as UTF-8 bytes; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that what a batch needs in memory stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
