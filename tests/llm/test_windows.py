"""Repeated word windows against a plain version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import super_kmers
from tests.llm import brute
from tests.llm.conftest import prose, tuples


def removed(df):
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    found = df.select("doc_id", "n_words", gone.alias("gone"), F.sha2(F.col("kept").cast("binary"), 256).alias("digest"))
    return tuples(found, "doc_id", "n_words", "gone", "digest")


@pytest.mark.parametrize(("window", "gram", "bucket"), [(20, 5, 256), (20, 5, 2), (20, 20, 256), (8, 3, 4), (3, 1, 2)])
def test_windows_equal_brute_force(docs, pairs, window, gram, bucket):
    found = removed(super_kmers.without_repeats(docs, window, gram, bucket))
    assert found == sorted(brute.without_repeated_windows(pairs, window), key=repr)
    assert sum(row[2] > 0 for row in found) > 10


def test_windows_across_pieces_of_long_texts(docs, pairs, monkeypatch):
    monkeypatch.setattr(super_kmers, "PIECE", 50)
    found = removed(super_kmers.without_repeats(docs))
    assert found == sorted(brute.without_repeated_windows(pairs), key=repr)


def test_a_common_passage_in_many_surroundings(spark):
    """One bucket of nearly all strings, as a whole and cut up; ids as strings."""
    passage = prose(7, 15)
    rows = [(f"d{i:03}", prose(1000 + i, 25) + " " + passage + " " + prose(2000 + i % 90, 25)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(5)
    expected = sorted(brute.without_repeated_windows(rows), key=repr)
    assert sum(row[2] > 0 for row in expected) == 210
    for bucket in (256, 1000):
        assert removed(super_kmers.without_repeats(df, bucket=bucket)) == expected


def test_rows_of_one_id_and_different_texts(spark):
    text = prose(5, 60)
    rows = [(1, text), (1, text), (1, text + " and more"), (None, text), (None, text), (2, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = removed(super_kmers.without_repeats(df))
    # The null id comes first; its rows are one document.
    assert [(d, gone) for d, _, gone, _ in found] == [(1, 60), (1, 60), (1, 60), (2, 60), (None, 0), (None, 0)]


def test_clashing_columns_and_empty_tables(docs, empty, pairs):
    more = docs.withColumns({c: F.lit(1) for c in ("text_hash", "cells", "first", "_id", "at", "content")})
    assert removed(super_kmers.without_repeats(more)) == sorted(brute.without_repeated_windows(pairs), key=repr)
    assert super_kmers.without_repeats(empty).count() == 0


def test_super_kmers_cover_each_window_once():
    rng = np.random.default_rng(3)
    for window, gram in ((20, 5), (4, 4), (5, 1)):
        sizes = rng.integers(0, 90, 12)
        ids = rng.integers(0, 6, sizes.sum()).astype(np.uint64)
        begins = np.cumsum(sizes) - sizes
        first, count, key, content = super_kmers.Cutter(window, gram).cut(ids, begins)
        starts = [s for f, c in zip(first, count) for s in range(f, f + c)]
        expected = [s for b, n in zip(begins, sizes) for s in range(b, b + n - window + 1)]
        assert starts == expected
        keys = np.repeat(key, count)
        named = {}
        for s, k in zip(starts, keys):
            assert named.setdefault(tuple(ids[s : s + window]), k) == k
        contents = {}
        for f, c, k, v in zip(first, count, key, content):
            assert contents.setdefault((k, v), tuple(ids[f : f + c + window - 1])) == tuple(ids[f : f + c + window - 1])
        for f, c in zip(first, count):
            own = [tuple(ids[s : s + window]) for s in range(f, f + c)]
            assert len(set(own)) == len(own)
