"""Spelling variants against a comparison of all words with all."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import variants
from tests.llm import brute
from tests.llm.conftest import tuples

COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def edited(word, rng):
    at, letter = rng.randrange(len(word) + 1), rng.choice("abcdeéà")
    return rng.choice([word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :], word[:at] + word[at + 1 :]])


def crowd(seed, n):
    """Rows of words in families, of a small alphabet: many are near, many are anagrams."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéà") for _ in range(rng.randint(4, 9))) for _ in range(n)]
    words += [edited(w, rng) for w in words for _ in range(2)]
    words += ["".join(rng.sample(w, len(w))) for w in words[:n]]
    rows = []
    for i in range(60):
        own = [w for w in rng.choices(words, k=200) for _ in range(rng.choice([1, 1, 2, 5]))]
        rows.append((i, " ".join(w.capitalize() if rng.random() < 0.2 else w for w in own)))
    return rows


@pytest.mark.parametrize("parts", [4, 5, 3])
def test_variants_equal_brute_force(spark, parts):
    rows = crowd(parts, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = tuples(variants.spelling_variants(df, parts=parts), *COLUMNS)
    assert found == sorted(brute.spelling_variants(rows), key=repr)
    assert sum(r[2] > 0 for r in found) > 200 and any(r[5] not in (r[0], r[3]) for r in found)


def test_hard_texts(docs, pairs, empty):
    rows = [(i, t) for i, t in pairs]
    assert tuples(variants.spelling_variants(docs), *COLUMNS) == sorted(brute.spelling_variants(rows), key=repr)
    more = docs.withColumns({c: F.lit(1) for c in ("word", "n", "key", "other", "root", "form")})
    assert tuples(variants.spelling_variants(more), *COLUMNS) == sorted(brute.spelling_variants(rows), key=repr)
    assert variants.spelling_variants(empty).count() == 0


def test_ties_and_chains(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "zzzzz": 3, "zzzzy": 8, "zzzzx": 8, "qqqqq": 4, "qqqqr": 7}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    forms = variants.with_forms(words, variants.near_words(words))
    found = {r.word: (r.n_near, r.form, r.form_n) for r in forms.collect()}
    assert found["zzzzz"] == (2, "zzzzx", 8) and found["zzzzy"] == (2, None, None)
    assert found["qqqqq"] == (1, None, None)
    roots = {r.word: r.root for r in variants.roots(forms).collect()}
    assert roots == {"aaaaa": "aabbb", "aaaab": "aabbb", "aaabb": "aabbb", "zzzzz": "zzzzx"}


def test_near_words_share_a_signature():
    rng = random.Random(8)
    for parts in (3, 4, 6):
        for _ in range(300):
            a = "".join(rng.choice("abcÿ") for _ in range(rng.randint(2, 12)))
            b = edited(a, rng)
            if len(b) < 2 or not brute.one_edit_apart(a, b):
                continue
            short, other = variants.signatures(sorted((a, b), key=len), parts)
            half = len(short) // 2
            assert np.intersect1d(short[:half], other[:half] if len(a) == len(b) else other[half:]).size


def test_counts_passed_on_early(spark, monkeypatch):
    rows = crowd(1, 40)
    monkeypatch.setattr(variants, "HELD", 10)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = tuples(variants.word_counts(df), "word", "n")
    assert found == sorted(((w, n) for w, n, *_ in brute.spelling_variants(rows)), key=repr)
