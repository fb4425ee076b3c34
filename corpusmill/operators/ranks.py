"""Global ranks, row lookup, epoch order and batches.

A global rank never sorts the whole table in one task. Rows fall into buckets whose order
agrees with the row order; the buckets are counted, the small count table is summed up in
order, and each row adds its place inside its bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.session import scratch_path

# Rows of a bucket that one task sorts for a rank.
BUCKET_ROWS = 50_000
# With more digits the table of buckets would be too large to send to every task.
MOST_DIGITS = 5

# Fixed values -------------------------------------------------------------
DEFAULT_MAX_LINES = 100_000
TRAINING_BATCH = 10_000
EPOCH_SEED = 42
# --------------------------------------------------------------------------


def block_offsets(counts: DataFrame, keys: list[str], n: str, out: str) -> DataFrame:
    """Rows before each bucket. The only unpartitioned window; it sees one row per bucket."""
    earlier = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(n).over(earlier), F.lit(0)))


def global_rank(
    df: DataFrame, buckets: list[str], within: list[str], out: str = "rank"
) -> DataFrame:
    """Add the 0-based rank by ``buckets`` then ``within``.

    The bucket columns must bound the bucket size (an input split, an id range, a hash
    prefix), so no task sorts more than one bucket at a time. The join on the bucket columns
    reuses the partitioning of the ranking window.
    """
    counts = df.groupBy(*buckets).agg(F.count(F.lit(1)).alias("_n"))
    offsets = block_offsets(counts, buckets, "_n", "_before").drop("_n")
    place = F.row_number().over(Window.partitionBy(*buckets).orderBy(*within))
    return (
        df.withColumn("_place", place)
        .join(offsets, buckets)
        .withColumn(out, F.col("_before") + F.col("_place") - 1)
        .drop("_before", "_place")
    )


def _div(value: Column, by: int) -> Column:
    """Whole-number quotient without a detour over doubles."""
    return F.call_function("div", value, F.lit(by))


def id_parts(df: DataFrame, id_col: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(id, _n, _part)``: distinct ids with their rows, in ranges that follow the ids' quantiles.

    Only ids move. They are written to the shared folder, since a range partition that is made a
    second time may have other bounds.
    """
    spark = df.sparkSession
    ids = df.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"))
    parts = max(1, -(-(df.agg(F.count(id_col)).first()[0]) // bucket_rows))
    ranged = ids.repartitionByRange(parts, id_col).withColumn("_part", F.spark_partition_id())
    path = scratch_path(spark, "ids")
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def rank_by_id(
    df: DataFrame, id_col: str, out: str = "rank", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """0-based rank by an integer id; rows of one id follow each other in any order.

    Ids are ranked in ranges of about ``bucket_rows``, however they are spread, and the rows get
    their ranks by a join on the id. Rows with a null id are left out.
    """
    parts = id_parts(df, id_col, bucket_rows)
    counts = parts.groupBy("_part").agg(F.sum("_n").alias("_rows"))
    offsets = block_offsets(counts, ["_part"], "_rows", "_before").drop("_rows")
    earlier = Window.partitionBy("_part").orderBy(id_col).rowsBetween(Window.unboundedPreceding, -1)
    first = (
        parts.withColumn("_inner", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .join(offsets, "_part")
        .select(id_col, (F.col("_before") + F.col("_inner")).alias("_first"))
    )
    rank = F.col("_first")
    if (parts.agg(F.max("_n")).first()[0] or 0) > 1:
        rank = rank + F.row_number().over(Window.partitionBy(id_col).orderBy(id_col)) - 1
    return df.join(first, id_col).withColumn(out, rank).drop("_first")


def take_lines(
    lines: DataFrame,
    max_lines: int | None = None,
    test_mode: bool = False,
    line_no: str = "line_no",
) -> DataFrame:
    """Rows of the first ``max_lines`` raw lines; blank and malformed lines count too.

    No limit means all lines, or 100,000 in test mode.
    """
    if max_lines is None and test_mode:
        max_lines = DEFAULT_MAX_LINES
    return lines.filter(F.col(line_no) <= max_lines) if max_lines else lines


def lookup_rows(df: DataFrame, ids: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows whose number is asked for."""
    return df.join(ids.select(key), key, "left_semi")


def epoch_key(row_id: Column, seed: int, epoch: int | Column) -> Column:
    epoch = epoch if isinstance(epoch, Column) else F.lit(epoch)
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), row_id.cast("string")))


def epoch_digits(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Hex digits of a bucket, so that it holds ``bucket_rows`` rows or, at the most digits, more."""
    return next((d for d in range(1, MOST_DIGITS) if 16**d * bucket_rows >= rows), MOST_DIGITS)


def epoch_order(
    df: DataFrame,
    row_id: str = "row_id",
    seed: int = EPOCH_SEED,
    epoch: int = 0,
    bucket_digits: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``rank``, a repeatable random permutation of the rows, and ``total``, their number.

    Rows are put in the order of ``md5(seed:epoch:row_id)``. The leading hex digits are the
    bucket, so buckets are even whatever the data; how many digits follows from the number of
    rows, which is counted unless they are given. The rank does not depend on it. Range
    partitioning by bucket serves the ranking window and leaves the output in rank order: rows
    move once.
    """
    digits = bucket_digits or epoch_digits(df.count())
    shuffled = df.withColumn("_key", epoch_key(F.col(row_id), seed, epoch)).withColumn(
        "_bucket", F.substring("_key", 1, digits)
    )
    # Rows before a bucket: those of the buckets with other first digits, and those of its own.
    counts = shuffled.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_top", F.substring("_bucket", 1, 2)
    )
    everything = Window.orderBy("_top").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    tops = block_offsets(counts.groupBy("_top").agg(F.sum("_n").alias("_n")), ["_top"], "_n", "_outer")
    tops = tops.withColumn("total", F.sum("_n").over(everything)).drop("_n")
    earlier = Window.partitionBy("_top").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    # At most 16 ** MOST_DIGITS rows.
    before = F.broadcast(
        counts.withColumn("_inner", inner)
        .join(F.broadcast(tops), "_top")
        .select("_bucket", "total", (F.col("_outer") + F.col("_inner")).alias("_before"))
    )
    spread = (
        shuffled.repartitionByRange(partitions, "_bucket")
        if partitions
        else shuffled.repartitionByRange("_bucket")
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key", row_id))
    return (
        spread.withColumn("_place", place)
        .join(before, "_bucket")
        .withColumn("rank", F.col("_before") + F.col("_place") - 1)
        .drop("_key", "_bucket", "_before", "_place")
    )


def batch_columns(
    df: DataFrame,
    total: Column,
    batch_size: int,
    accumulation: int = 1,
    max_steps: int | None = None,
) -> DataFrame:
    """Batch and update numbers from ``rank``; the last short batch is kept.

    ``applied`` tells whether the update's group of batches is complete: an epoch only steps
    on a multiple of ``accumulation``. ``max_steps`` ends the epoch after that many batches.
    """
    batches = _div(total + (batch_size - 1), batch_size)
    if max_steps is not None:
        batches = F.least(batches, F.lit(max_steps))
    full_groups = _div(batches, accumulation)
    numbered = df.withColumn("batch_id", _div(F.col("rank"), batch_size)).withColumn(
        "update_id", _div(F.col("batch_id"), accumulation)
    )
    kept = numbered.withColumn("applied", F.col("update_id") < full_groups)
    return kept if max_steps is None else kept.filter(F.col("batch_id") < max_steps)


def epoch_batches(
    df: DataFrame,
    batch_size: int,
    accumulation: int = 1,
    max_steps: int | None = None,
    row_id: str = "row_id",
    seed: int = EPOCH_SEED,
    epoch: int = 0,
    partitions: int | None = None,
    bucket_digits: int | None = None,
) -> DataFrame:
    """Epoch order with ``batch_id``, ``update_id`` and ``applied``."""
    ordered = epoch_order(df, row_id, seed, epoch, bucket_digits, partitions)
    return batch_columns(
        ordered, F.col("total"), batch_size, accumulation, max_steps
    ).drop("total")


def text_batches(
    valid: DataFrame,
    batch_size: int = TRAINING_BATCH,
    buckets: list[str] | None = None,
    within: list[str] | None = None,
) -> DataFrame:
    """Number consecutive batches over the valid texts; the last may be short."""
    ranked = (
        global_rank(valid, buckets, within, "rank")
        if buckets
        else rank_by_id(valid, (within or ["line_no"])[0], "rank")
    )
    return ranked.withColumn("batch_id", _div(F.col("rank"), batch_size))
