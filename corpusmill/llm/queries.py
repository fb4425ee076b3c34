"""The registered queries of this subpackage; each gets its rows through its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import (
    decontaminate,
    id_files,
    line_crf,
    middle,
    nbsvm,
    packing,
    ppm,
    repeats,
    secrets,
    sketch_join,
    super_kmers,
    url_rules,
    variants,
)
from corpusmill.llm.common import remainder
from corpusmill.llm.oracle import all_sql  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha_text(col: Column) -> Column:
    return F.sha2(col.cast("binary"), 256)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_join.similar_components(table(spark, sf_dir, "documents")).drop("text_hash")


def op2_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = nbsvm.quality_model(docs, labels, lambda rows: rows.filter(remainder("doc_id", 4) != 2))
    return nbsvm.scored(docs, model).select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


# The host and path rules of the URL query.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    found = url_rules.judged(pages, pages.join(labels, "page_id"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = ppm.score_texts(docs, docs.filter(remainder("doc_id", 10) != 0))
    held_out = (remainder("doc_id", 10) == 0).alias("held_out")
    return found.select("doc_id", held_out, *[c for c in found.columns if c != "doc_id"])


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(
        F.filter("base", lambda s: s["kind"] == secrets.KINDS.index(kind))
    ).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        sha_text(secrets.listed(F.col("base"))).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = line_crf.fit(docs, table(spark, sf_dir, "labels"))
    return line_crf.line_rules(docs, model).drop("text")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    n_hit = decontaminate.covered(F.col("spans")).cast("long")
    return hits.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        sha_text(F.array_join(F.sort_array("items"), ",")).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op9_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = id_files.write_ids(table(spark, sf_dir, "documents"))
    return id_files.read_ids(manifest).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op11_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = super_kmers.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return left.select("doc_id", "n_words", removed.alias("n_removed"), sha_text(F.col("kept")).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.fill_in_middle(table(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Query]:
    return {
        "op1_jaccard_join": op1_jaccard_join,
        "op2_repeated_strings": op2_repeated_strings,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_url_filters": op4_url_filters,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_secret_scans": op6_secret_scans,
        "op7_quality_rules": op7_quality_rules,
        "op8_decontaminate": op8_decontaminate,
        "op9_token_id_files": op9_token_id_files,
        "op10_best_fit_packing": op10_best_fit_packing,
        "op11_repeated_windows": op11_repeated_windows,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_fill_in_middle": op13_fill_in_middle,
    }
