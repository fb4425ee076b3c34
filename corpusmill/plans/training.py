"""Prepared records to batched training samples.

Rows are put in epoch order before they are encoded: the one shuffle carries the text, and
encoding, padding, masking and shifting follow in the same stage as the write.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.ranks import EPOCH_SEED, batch_columns, epoch_batches, epoch_order
from corpusmill.operators.records import render_records, valid_texts
from corpusmill.operators.tokenizer import Tokenizer
from corpusmill.operators.training_samples import MAX_LENGTH, pretrain_samples, sft_samples
from corpusmill.session import drop_path, prepare_session
from corpusmill.sources.lines import number_lines, read_lines


def pretrain_batches(
    texts: DataFrame,
    tok: Tokenizer,
    batch_size: int,
    max_length: int = MAX_LENGTH,
    row_id: str = "row_id",
    accumulation: int = 1,
    max_steps: int | None = None,
    seed: int = EPOCH_SEED,
    epoch: int = 0,
    bucket_digits: int | None = None,
) -> DataFrame:
    """Batched samples of ``(row_id, text)`` rows for one epoch."""
    ordered = epoch_batches(
        texts, batch_size, accumulation, max_steps, row_id, seed, epoch, bucket_digits=bucket_digits
    )
    return pretrain_samples(ordered, tok, max_length)


def sft_batches(
    rendered: DataFrame,
    tok: Tokenizer,
    batch_size: int,
    max_length: int = MAX_LENGTH,
    mask: str = "pad_value",
    row_id: str = "row_id",
    accumulation: int = 1,
    max_steps: int | None = None,
    seed: int = EPOCH_SEED,
    epoch: int = 0,
    bucket_digits: int | None = None,
) -> DataFrame:
    """Batched samples of ``(row_id, rendered)`` rows for one epoch."""
    ordered = epoch_batches(
        rendered, batch_size, accumulation, max_steps, row_id, seed, epoch, bucket_digits=bucket_digits
    )
    return sft_samples(ordered, tok, max_length, mask)


def _done(spark: SparkSession, path: str) -> set[int]:
    """Shards that an earlier run has finished; -1 stands for the ordered rows."""
    try:
        return {row.shard for row in spark.read.schema("shard int").parquet(path).collect()}
    except AnalysisException:
        return set()


def write_file_batches(
    spark: SparkSession,
    src: str | list[str],
    tok: Tokenizer,
    dst: str,
    batch_size: int,
    kind: str = "pretrain",
    max_length: int = MAX_LENGTH,
    mask: str = "pad_value",
    accumulation: int = 1,
    max_steps: int | None = None,
    seed: int = EPOCH_SEED,
    epoch: int = 0,
    shards: int = 64,
    shards_per_job: int = 16,
) -> DataFrame:
    """JSON-lines files to the batched samples of one epoch, in ``dst/shard=k``.

    Rows are named by their line number over all files, put in epoch order once, and kept by
    shard next to ``dst``; then some shards at a time are encoded and written. A shard holds
    consecutive whole batches. What a run has finished, the next one leaves as it is: an ended
    run is taken up by the same call. ``kind`` is ``pretrain`` or ``sft``.
    """
    prepare_session(spark)
    if kind not in ("pretrain", "sft"):
        raise ValueError(f"unknown kind {kind!r}")
    ordered, marks = f"{dst.rstrip('/')}-ordered", f"{dst.rstrip('/')}-done"
    done = _done(spark, marks)

    def mark(finished: list[int]) -> None:
        rows = spark.createDataFrame([(k,) for k in finished], "shard int")
        rows.coalesce(1).write.mode("append").parquet(marks)

    if -1 not in done:
        lines = number_lines(read_lines(spark, src), "row_id").select("row_id", "value")
        rows = valid_texts(lines).select("row_id", "text") if kind == "pretrain" else render_records(lines).select("row_id", "rendered")
        ranked = epoch_order(rows, "row_id", seed, epoch)
        batches = F.ceil(F.col("total") / batch_size)
        batched = batch_columns(ranked, F.col("total"), batch_size, accumulation, max_steps)
        per_shard = F.greatest(F.ceil(batches / shards), F.lit(1))
        shard = F.floor(F.col("batch_id") / per_shard).cast("int")
        batched.withColumn("shard", shard).drop("total").write.mode("overwrite").partitionBy("shard").parquet(ordered)
        mark([-1])
    left = [k for k in range(shards) if k not in done]
    for start in range(0, len(left), shards_per_job):
        own = left[start : start + shards_per_job]
        rows = spark.read.parquet(ordered).filter(F.col("shard").isin(own))
        made = (
            pretrain_samples(rows, tok, max_length)
            if kind == "pretrain"
            else sft_samples(rows, tok, max_length, mask)
        )
        made = made.sortWithinPartitions("shard", "rank")
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(dst)
        mark(own)
    drop_path(spark, ordered)
    return spark.read.parquet(dst)
