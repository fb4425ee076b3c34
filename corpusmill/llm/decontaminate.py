"""Benchmark decontamination: word windows of test items found in training documents.

All work is in DataFrame functions. The windows of the test items are a broadcast hash set;
each document's windows are hashed in its own row and looked up there, so no window of the
corpus becomes a row unless its hash is in the set. Those few are compared as text.

Defined cases: a null text has no words and no hits; null ids stay null; repeated rows give a
row each; extra columns are ignored by :func:`benchmark_hits` and kept by
:func:`drop_contaminated`; an empty benchmark hits nothing; an item without words has no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import ascii_lower, whole_text
from corpusmill.operators.steps import once

# Word pattern and window size.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10

# Up to this many distinct test windows their hashes travel as a set with the expression, and
# their texts as a broadcast table. Beyond it, every window is joined by its text.
MAX_SET = 100_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(gram, n, items)``: distinct windows, their word count and the items that hold them."""
    item = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    cut = benchmark.select(item.alias("item"), words(whole_text()).alias("w"))
    grams = (
        once(cut, "n", F.least(F.lit(window), F.size("w")))
        .filter("n > 0")
        .select(
            "item",
            "n",
            F.explode(
                F.expr("transform(sequence(0, size(w) - n), i -> array_join(slice(w, i + 1, n), ' '))")
            ).alias("gram"),
        )
    )
    return grams.groupBy("gram", "n").agg(F.collect_set("item").alias("items"))


def _candidates(n: int, hashes: list[int] | None) -> Column:
    """Windows of ``n`` words as ``(at, n, gram)``; with ``hashes``, only those in the set."""
    places = f"sequence(0, size(w) - {n})"
    if hashes is not None:
        listed = ", ".join(f"{h}L" if h >= 0 else f"({h}L)" for h in hashes)
        places = f"filter({places}, i -> xxhash64(slice(w, i + 1, {n})) in ({listed}))"
    found = (
        f"transform({places}, i -> struct(i as at, {n} as n, "
        f"array_join(slice(w, i + 1, {n}), ' ') as gram))"
    )
    none = f"filter(array(struct(0 as at, {n} as n, '' as gram)), x -> false)"
    return F.expr(f"if(size(w) >= {n}, {found}, {none})")


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_set: int = MAX_SET
) -> DataFrame:
    """Per document ``(doc_id, text_hash, n_words, spans, items)``.

    ``spans`` are the hit windows as ``(at, n)`` in words, ``items`` the ids of their test items.
    """
    grams = test_windows(benchmark, window)
    rows = grams.select("n", F.xxhash64(F.split("gram", " ")).alias("h")).limit(max_set + 1).collect()
    small = len(rows) <= max_set
    if small:
        by_length: dict[int, list[int] | None] = {}
        for row in rows:
            by_length.setdefault(row.n, []).append(row.h)
        known = F.broadcast(grams.drop("n"))
    else:
        by_length = {r.n: None for r in grams.select("n").distinct().collect()}
        known = grams.drop("n")

    cut = docs.select(
        "doc_id", F.xxhash64(whole_text()).alias("text_hash"), words(whole_text()).alias("w")
    )
    found = [_candidates(n, hashes) for n, hashes in sorted(by_length.items())]
    hits = F.concat(*found) if found else _candidates(1, [0])
    windows = cut.select(
        "doc_id", "text_hash", F.size("w").alias("n_words"), F.posexplode_outer(hits).alias("k", "hit")
    ).select("doc_id", "text_hash", "n_words", "k", "hit.at", "hit.n", "hit.gram")
    matched = windows.join(known, "gram", "left")
    # Equal rows fall into one group, which afterwards gives as many rows again.
    grouped = matched.groupBy("doc_id", "text_hash", "n_words").agg(
        F.collect_set(F.when(F.col("items").isNotNull(), F.struct("at", "n"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        F.count_if(F.coalesce("k", F.lit(0)) == 0).alias("copies"),
    )
    return grouped.select(
        "doc_id",
        "text_hash",
        "n_words",
        F.sort_array("spans").alias("spans"),
        "items",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def covered(spans: Column) -> Column:
    """Words inside any of the sorted ``(at, n)`` spans."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("total"))

    def step(seen: Column, span: Column) -> Column:
        end = span["at"] + span["n"]
        fresh = F.greatest(F.lit(0), end - F.greatest(seen["upto"], span["at"]))
        return F.struct(
            F.greatest(seen["upto"], end).alias("upto"), (seen["total"] + fresh).alias("total")
        )

    return F.aggregate(spans, start, step)["total"]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any test window; all their columns stay."""
    hit = (
        benchmark_hits(docs, benchmark, window)
        .filter(F.size("spans") > 0)
        .select(F.col("doc_id").alias("_hit_id"), F.col("text_hash").alias("_hit_text"))
        .distinct()
    )
    same = docs["doc_id"].eqNullSafe(hit["_hit_id"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == hit["_hit_text"]
    )
    return docs.join(hit, same, "left_anti")
