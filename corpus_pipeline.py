"""A corpus made ready for training: five stages, each over all that the one before has kept.

1. Documents that the quality classifier scores below 0.7 go.
2. Of each group of near copies (five-word shingles, Jaccard similarity of 0.8 or more) the
   document of the smallest id stays.
3. Documents that hold a window of a benchmark item go.
4. Secrets are masked.
5. Documents are packed into sequences of 2,048 tokens.

Stages 1 to 4 return the columns of their input; the last returns packed pieces. A null text
counts as empty; extra columns pass through, whatever their names; an empty table gives an empty
table. Of repeated rows one is left by the second stage, the others keep each row. Of near copies
of one id that differ, the one of least text hash stays; a null id comes after all others. A
text of any length is read whole by every stage.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusmill.llm import decontaminate, nbsvm, packing, secrets, sketch_join  # noqa: E402
from corpusmill.llm.common import kept  # noqa: E402

LEAST_SCORE = 0.7
NEAR_COPIES = sketch_join.Similarity(words=5, part=4, whole=5)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = nbsvm.quality_model(docs, _table(spark, sf_dir, "labels"))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    scored = nbsvm.scored(docs.select(row, "text"), model)
    return scored.filter(F.col("score") >= LEAST_SCORE).select("row.*")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sketch_join.one_of_each(docs, NEAR_COPIES)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

# The first stage is a trained model: the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs, _ = kept(docs, "stage-" + name.replace(" ", "-"))
    return docs
