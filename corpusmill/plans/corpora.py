"""Raw corpora to prepared JSON lines."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.records import prepare_lines, prepared_counts, to_chat
from corpusmill.session import prepare_session
from corpusmill.sources.arrays import read_json_array
from corpusmill.sources.lines import files_by_layout, read_lines
from corpusmill.sources.sinks import write_jsonl

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class JobReport:
    """What a preparation did: records read, those lost by reason, and records written.

    The counts are taken while the job runs; nothing is scanned for them.
    """

    done: bool
    read: int = 0
    written: int = 0
    lost: dict[str, int] = field(default_factory=dict)


class _Counts:
    """Observations along a plan; their values are there when the plan has been written."""

    def __init__(self):
        self.inputs: list[Observation] = []
        self.output = Observation()

    def of_input(self, df: DataFrame, reason: str) -> DataFrame:
        """Count records by ``reason``, a column that is ``kept`` for those that go on."""
        self.inputs.append(Observation())
        return df.observe(self.inputs[-1], *prepared_counts(F.col(reason)))

    def of_output(self, df: DataFrame) -> DataFrame:
        return df.observe(self.output, F.count(F.lit(1)).alias("written"))

    def report(self) -> JobReport:
        totals: dict[str, int] = {}
        for seen in self.inputs:
            for name, n in seen.get.items():
                totals[name] = totals.get(name, 0) + n
        read = totals.pop("read", 0)
        totals.pop("kept", 0)
        return JobReport(True, read, self.output.get["written"], {k: n for k, n in totals.items() if n})


def pretrain_chunks(spark: SparkSession, src: str, counts: _Counts | None = None) -> DataFrame:
    """Chunks of a JSON-lines corpus: one narrow stage, no shuffle."""
    prepare_session(spark)
    return prepare_lines(read_lines(spark, src), "pretrain", counts and counts.of_input)


def chat_records(spark: SparkSession, src: str, counts: _Counts | None = None) -> DataFrame:
    """Chat records of conversation files; each is read as a JSON array or as JSON lines."""
    prepare_session(spark)
    files = files_by_layout(spark, src)
    observe = counts and counts.of_input
    parts = []
    if files["array"]:
        parts.append(to_chat(read_json_array(spark, files["array"]), observe=observe).select("messages"))
    if files["jsonl"] or not parts:
        lines = read_lines(spark, files["jsonl"] or src)
        parts.append(prepare_lines(lines, "chat", observe).select("messages"))
    return reduce(DataFrame.unionByName, parts)


def prepare_pretrain(spark: SparkSession, src: str, dst: str) -> JobReport:
    counts = _Counts()
    chunks = counts.of_output(pretrain_chunks(spark, src, counts))
    write_jsonl(chunks.select(F.struct("text").alias("r")), dst, "r")
    return counts.report()


def prepare_chat(spark: SparkSession, src: str, dst: str) -> JobReport:
    counts = _Counts()
    write_jsonl(counts.of_output(chat_records(spark, src, counts)), dst, "messages")
    return counts.report()


def prepare_all(
    spark: SparkSession, pretrain_src: str, pretrain_dst: str, chat_src: str, chat_dst: str
) -> dict[str, JobReport]:
    """Run both preparations; one failing does not stop the other."""
    reports = {}
    for name, job, src, dst in (
        ("pretrain", prepare_pretrain, pretrain_src, pretrain_dst),
        ("chat", prepare_chat, chat_src, chat_dst),
    ):
        try:
            reports[name] = job(spark, src, dst)
        except Exception:  # noqa: BLE001 - the other job still has to run
            log.exception("%s preparation failed", name)
            reports[name] = JobReport(False)
    return reports
