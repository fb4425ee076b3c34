"""Headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from corpusmill.functions.chat import render_chat
from corpusmill.operators import ranks, records, training_samples, vocabulary
from corpusmill.operators.tokenizer import Tokenizer, encode
from corpusmill.plans.training import pretrain_batches

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MERGES = 64


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    docs = inputs.documents(spark, SF_DIR).select("doc_id", "text")
    lines = inputs.conversation_lines(spark, SF_DIR)
    chars = docs.agg(F.sum(F.length("text"))).first()[0]
    trained: dict[str, Tokenizer] = {}

    def train_bpe_64() -> None:
        trained["tok"] = vocabulary.train_bpe(vocabulary.word_counts(docs), 261 + MERGES)

    def chat_prepare() -> None:
        chats = records.to_chat(records.parse_json_strict(lines))
        run(chats.select("conv_id", render_chat(F.col("messages")).alias("rendered")))

    jobs = {
        "chunk_text": lambda: run(records.chunk_text(docs)),
        "chat_prepare": chat_prepare,
        "word_counts": lambda: run(vocabulary.word_counts(docs)),
        "train_bpe_64": train_bpe_64,
        "encode": lambda: run(encode(docs, trained["tok"])),
        "pretrain_samples": lambda: run(training_samples.pretrain_samples(docs, trained["tok"])),
        "epoch_batches": lambda: run(ranks.epoch_batches(docs, 256, 2, row_id="doc_id")),
        "pretrain_batches": lambda: run(
            pretrain_batches(docs, trained["tok"], 256, row_id="doc_id", accumulation=2)
        ),
    }
    spent: dict[str, float] = {}
    for name, job in jobs.items():
        start = time.perf_counter()
        job()
        spent[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "headline jobs, total wall time",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": float(scale.group(1)) if scale else SF_DIR,
                "chars": chars,
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
