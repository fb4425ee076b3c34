"""Spelling variants: words one edit apart, found by PartEnum signatures.

A word's letters are a multiset, and a multiset is a binary vector: one dimension for each letter
and number of its occurrence. One inserted, deleted or replaced letter changes at most two
dimensions. The dimensions are dealt to ``PARTS`` parts; of any two changed dimensions there is a
choice of two parts that holds both, so two near words agree on the other parts for one of the
choices. A signature is the content of the parts that are left, for each choice of two that go.

Signatures forget the order of the letters, and words of common letters would crowd their buckets.
Near words also share the first or the second half of the shorter one's letters, in order, so a
signature is extended by either half. Nothing is lost by that, and buckets stay small. Words that
share an extended signature are joined by it and verified by their edit distance.

A word's form is the near word of largest count that has at least ``RATIO`` times its own count;
counts grow along the forms, so they end in a root. Roots are found by doubling the steps taken.

Defined cases: a null or empty text has no words; a null id counts as empty text; repeated rows
are counted as often as they are there; a text of any length is cut whole; extra columns are
ignored; near words of equal count are ordered by code points; an empty table gives no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import byte_texts, dropped, kept, slices

# Letters of a word, how often a letter is lost, and what counts as a word.
LETTERS = re.compile("[a-zÀ-ÿ]+")
LOST_IN = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
# Four parts give six choices of two that go; more parts make more rows and smaller buckets.
PARTS = 4
# Words held by a task before it passes its counts on.
HELD = 400_000

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(32))) * _MIX
    keys ^= keys >> np.uint64(29)
    keys *= _STEP
    return keys ^ (keys >> np.uint64(32))


def damaged(word: str, before: int) -> str:
    """The word, or the word without a letter; ``before`` is the crc32 of what precedes it."""
    h = zlib.crc32(word.encode(), before)
    if h % LOST_IN:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count_words(least: int):
    """Words of a task with their counts, passed on before they become too many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.record_batch(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
            )
            held.clear()
            return rows

        for batch in slices(batches, 500):
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, byte_texts(batch)):
                before = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
                before = zlib.crc32(b":", before)
                # The same word has the same fate in all of a document.
                for word, n in Counter(LETTERS.findall(text.lower().decode())).items():
                    word = damaged(word, before)
                    if len(word) >= least:
                        held[word] += n
                if len(held) > HELD:
                    yield out()
        yield out()

    return run


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)`` of all words of at least this length and count."""
    counted = docs.select("doc_id", "text").mapInArrow(_count_words(least_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def signatures(words: list[str], parts: int = PARTS) -> np.ndarray:
    """For each word a row of keys; near words of two or more letters share one at least.

    The keys of the first half take the word for the shorter one of a pair, or one of two of a
    length; those of the second half take it for the longer one.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    from_end = lengths[owner] - 1 - place

    # The dimension of a letter: the letter and how many equal ones precede it.
    both = owner.astype(np.uint64) << np.uint64(32) | letters
    order = np.argsort(both, kind="stable")
    fresh = np.append(True, both[order][1:] != both[order][:-1])
    start = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = np.arange(len(order)) - start
    dimension = _mixed(letters * _STEP + occurrence)
    content = np.zeros((len(words), parts), np.uint64)
    part = (dimension >> np.uint64(33)) % np.uint64(parts)
    np.add.at(content, (owner, part.astype(np.int64)), dimension)
    whole = content.sum(axis=1)
    chosen = [whole - content[:, i] - content[:, j] for i, j in combinations(range(parts), 2)]

    # Halves of the shorter word of a pair: a word is that itself, or one letter longer.
    ahead = _mixed(letters * _STEP + place.astype(np.uint64) * _MIX)
    behind = _mixed(letters * _MIX + from_end.astype(np.uint64) * _STEP)
    keys = []
    for longer in (0, 1):
        shorter = lengths - longer
        half = shorter // 2
        for side, (hashes, where, size) in enumerate(
            ((ahead, place, half), (behind, from_end, shorter - half))
        ):
            sums = np.zeros(len(words), np.uint64)
            inside = where < size[owner]
            np.add.at(sums, owner[inside], hashes[inside])
            label = _mixed(sums + (shorter * 2 + side).astype(np.uint64) * _STEP)
            keys += [_mixed(_mixed(c + np.uint64(k)) + label) for k, c in enumerate(chosen)]
    return np.stack(keys, axis=1)


def _signature_rows(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 5_000):
            if not batch.num_rows:
                continue
            keys = signatures(batch.column("word").to_pylist(), parts)
            each = keys.shape[1]
            take = pa.array(np.repeat(np.arange(batch.num_rows), each))
            longer = np.tile(np.arange(each) >= each // 2, batch.num_rows)
            columns = [batch.column("word").take(take), batch.column("n").take(take), pa.array(longer)]
            yield pa.record_batch([pa.array(keys.ravel().view(np.int64)), *columns], ["key", "word", "n", "longer"])

    return run


def near_words(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """``(word, n, other, other_n)``: all pairs of words one edit apart, in both directions.

    ``words`` has distinct words of two or more letters with their counts.
    """
    schema = "key long, word string, n long, longer boolean"
    # Both sides are the same rows, so that they are dealt out once.
    left = words.select("word", "n").mapInArrow(_signature_rows(parts), schema)
    right = left.withColumnsRenamed({"word": "other", "n": "other_n", "longer": "other_longer"})
    # The sizes that Spark estimates are those of the words, not of their many keys.
    met = left.join(right.hint("merge"), "key").filter("not longer and (other_longer or word < other)")
    once = met.filter("levenshtein(word, other, 1) = 1").select("word", "n", "other", "other_n").distinct()
    back = F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return once.select(F.explode(F.array(F.struct("word", "n", "other", "other_n"), back)).alias("p")).select("p.*")


def with_forms(words: DataFrame, near: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``(word, n, n_near, form, form_n)`` of all words."""
    best: Column = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    found = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    return words.join(found, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words that have a form: the last word along the forms."""
    steps, path = kept(forms.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = steps.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        following, next_path = kept(longer, "roots")
        dropped(steps, path)
        steps, path = following, next_path
        if not steps.filter("moved").limit(1).count():
            return steps.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    parts: int = PARTS,
) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of all words; ``least_length`` is 2 or more."""
    words, words_path = kept(word_counts(docs, least_length, least_count), "words")
    near, near_path = kept(near_words(words, parts), "near-words")
    forms, _ = kept(with_forms(words, near, ratio), "forms")
    dropped(words, words_path)
    dropped(near, near_path)
    found = forms.join(roots(forms), "word", "left")
    return found.withColumn("root", F.coalesce("root", "word"))
