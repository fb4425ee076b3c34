"""Stateless preparation of text files as they arrive."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.operators.records import prepare_lines, prepared_counts
from corpusmill.session import prepare_session


def stream_prepare(
    spark: SparkSession, src_dir: str, kind: str, out: str, checkpoint: str
) -> StreamingQuery:
    """Prepare the files not seen before and stop; call again for later arrivals.

    Each batch's progress has what was read, lost by reason and written: ``observedMetrics`` of
    the query's ``recentProgress``, under ``read`` and ``written``; see :func:`stream_counts`.
    """
    prepare_session(spark)
    lines = spark.readStream.text(src_dir)
    observe = lambda df, reason: df.observe("read", *prepared_counts(F.col(reason)))
    prepared = prepare_lines(lines, kind, observe)
    return (
        prepared.observe("written", F.count(F.lit(1)).alias("written"))
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_counts(query: StreamingQuery) -> dict[str, int]:
    """Sums over the batches of a query: lines read, by what became of them, and rows written."""
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        for metrics in progress.observedMetrics.values():
            for name, n in metrics.asDict().items():
                totals[name] = totals.get(name, 0) + n
    return {name: n for name, n in totals.items() if n}
