"""Jaccard join and repeated strings against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import repeats, sketch_join
from tests.llm import brute
from tests.llm.conftest import tuples

COLUMNS = ["doc_id", "n_shingles", "component_id"]


def with_ids(pairs):
    return [p for p in pairs if p[0] is not None]


@pytest.mark.parametrize(("words", "part", "whole", "block"), [(3, 9, 10, 1024), (3, 9, 10, 8), (5, 4, 5, 1024)])
def test_components_equal_brute_force(docs, pairs, words, part, whole, block):
    near = sketch_join.Similarity(words, part, whole)
    found = sketch_join.similar_components(docs, near, block).filter("doc_id is not null")
    assert tuples(found, *COLUMNS) == sorted(brute.jaccard_components(with_ids(pairs), words, part, whole), key=repr)


def test_chains_and_borders(spark):
    """Sets of 10 to 30 shingles whose similarities lie at and around the threshold."""
    rng = np.random.default_rng(5)
    texts = []
    for k in range(60):
        words = [f"w{k}_{i}" for i in range(rng.integers(10, 80))]
        texts.append(words)
        for _ in range(6):
            words = list(words)
            cut = rng.integers(0, 3)
            words = words[cut:] if rng.random() < 0.5 else [*words, *[f"n{rng.integers(1 << 30)}"] * cut]
            if rng.random() < 0.3:
                words[rng.integers(len(words))] = "edit"
            texts.append(words)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for near in (sketch_join.Similarity(), sketch_join.Similarity(1, 9, 10), sketch_join.Similarity(2, 4, 5)):
        expected = brute.jaccard_components(rows, near.words, near.part, near.whole)
        assert tuples(sketch_join.similar_components(df, near), *COLUMNS) == sorted(expected, key=repr)
        assert len({c for *_, c in expected}) < len(rows) - 60


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for n in (3, 50, 700):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate([a[n // 4 :], rng.integers(0, 1 << 63, n // 3, dtype=np.uint64)])
        x, y = sketch_join.sketch(a), sketch_join.sketch(b)
        for width in (4, 2, 1):
            x, y = (sketch_join.folded(v, min(width * 8, len(v))) for v in (x, y))
            shorter = min(len(x), len(y))
            apart = np.bitwise_count(sketch_join.folded(x, shorter) ^ sketch_join.folded(y, shorter)).sum()
            assert apart <= len(np.setxor1d(a, b))


def test_similar_sets_share_a_piece():
    rng = np.random.default_rng(4)
    for near in (sketch_join.Similarity(), sketch_join.Similarity(5, 4, 5)):
        for n in (10, 12, 19, 40, 300, 2000):
            for _ in range(20):
                a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
                cut = int(near.difference(n, n)) // 2
                b = np.concatenate([a[cut:], rng.integers(0, 1 << 63, cut, dtype=np.uint64)])
                both = len(np.intersect1d(a, b))
                if both * near.whole < (2 * n - both) * near.part:
                    continue
                met = set()
                for keys in (a, b):
                    own = {
                        (band, k, w)
                        for band in near.bands(n)
                        for k, w in zip(*map(np.ndarray.tolist, sketch_join.pieces(keys, *near.pieces(band))))
                    }
                    assert not met or met & own
                    met = own


def test_failed_forest_edges_open_the_pairs_across():
    far = np.iinfo(np.int32).max
    distance = np.array([[far, 1, 2, far], [1, far, 2, far], [2, 2, far, 1], [far, far, 1, far]], np.int32)
    assert sorted(map(sorted, sketch_join._forest(distance))) == [[0, 1], [0, 2], [2, 3]]
    assert sketch_join._across(distance, [(0, 1), (2, 3)], [(0, 2)]) == [(1, 2)]


def test_one_of_each_group_stays(docs, pairs):
    left = sketch_join.one_of_each(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    groups = brute.jaccard_components(with_ids(pairs))
    assert sorted(i for i in ids if i is not None) == sorted({c for *_, c in groups})
    assert ids.count(None) == 1
    assert sketch_join.one_of_each(docs.filter("false")).count() == 0


def test_components_of_an_empty_table(empty):
    assert sketch_join.similar_components(empty).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    found = dict(tuples(sketch_join.components(edges), "node", "root"))
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def removed(df):
    return tuples(
        df.select(
            "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("gone"),
            F.size("spans").alias("n_spans"), F.sha2("kept", 256).alias("digest"),
        ), "doc_id", "n_bytes", "gone", "n_spans", "digest",
    )


@pytest.mark.parametrize(("length", "gram", "short"), [(400, 64, 352), (50, 16, 40), (24, 8, 20)])
def test_repeats_equal_brute_force(docs, pairs, length, gram, short):
    found = removed(repeats.without_repeats(docs, length, gram, short))
    assert found == sorted(brute.without_repeats(pairs, length), key=repr)
    assert sum(row[2] > 0 for row in found) > 10


def test_repeats_across_pieces_of_long_texts(docs, pairs, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 700)
    found = removed(repeats.without_repeats(docs))
    assert found == sorted(brute.without_repeats(pairs), key=repr)


def test_repeats_of_an_empty_table(empty):
    assert repeats.without_repeats(empty).count() == 0
