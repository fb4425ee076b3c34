"""Writers for prepared records and training samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, record: str, mode: str = "errorifexists") -> None:
    """One JSON value per line from a struct or array column; null fields are kept."""
    df.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value")).write.mode(
        mode
    ).text(path)


def write_samples(
    df: DataFrame,
    path: str,
    shards: int | None = None,
    batch: str = "batch_id",
    mode: str = "errorifexists",
) -> None:
    """Write samples as Parquet in batch order.

    Rows from ``epoch_batches`` already lie in that order and are written as they are; with
    ``shards`` they are spread by batch range into that many files.
    """
    if shards:
        df = df.repartitionByRange(shards, batch).sortWithinPartitions(batch)
    df.write.mode(mode).parquet(path)
