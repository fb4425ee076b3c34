"""Repeated word windows by super-k-mers.

A word goes if a window of ``window`` words over it also starts earlier. Of the ``gram``-word
strings in a window the least by its hash, the first of equal ones, is the window's minimiser.
Consecutive windows with one minimiser are a super-k-mer: the string from the first word of the
first window to the last word of the last. Equal windows have equal minimisers, so they meet in
the minimiser's bucket; and no two windows of one super-k-mer are equal, since their minimiser
lies at different distances from their starts.

1. Super-k-mers are named by their minimiser and their content. Only those whose minimiser occurs
   twice or more go on; of each content the earliest occurrence stands for all, and all windows
   of the other occurrences are repeats.
2. Where a bucket has several contents, the earliest occurrence of each travels to the bucket as
   one packed string. Its windows are sorted there, and all but the first of equal ones are
   repeats.
3. A bucket of more than ``BUCKET`` contents, that of a passage in very many surroundings, is cut
   up: each window travels by itself under a digest of its words, and the first place of each
   digest is found by partial minima.

Windows are judged on the input: what is removed does not change what is repeated.

Defined cases: a null or empty text has no words; a text of fewer words than a window has no
window and stays; documents are ordered by id, a null id first, and those of one id by the hash
of their text; repeated rows are one document and give a row each; a text of any length is read
whole, in pieces; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import WordIds, byte_texts, dropped, kept, slices, whole_text

# Fixed value: the words of a window.
WINDOW = 20
GRAM = 5
BUCKET = 256
# Words that are worked on at a time.
PIECE = 1 << 18

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x2545F4914F6CDD1D


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(32))) * _MIX
    keys ^= keys >> np.uint64(29)
    keys *= _STEP
    return keys ^ (keys >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(n, base, np.uint64)), dtype=np.uint64)


def _first_least(keys: np.ndarray, window: int) -> np.ndarray:
    """For each run of ``window`` keys the place of the least, the first of equal ones."""
    place, width = np.arange(len(keys)), 1
    while width < window:
        step = min(width, window - width)
        left, right = place[:-step], place[step:]
        place = np.where(keys[left] <= keys[right], left, right)
        width += step
    return place


class Cutter:
    """Cuts the words of several texts, one after the other in one array, into super-k-mers."""

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram
        self.up = self.down = np.empty(0, np.uint64)

    def cut(self, ids: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
        """First words, numbers of windows, minimisers and contents; texts begin at ``begins``."""
        window, n = self.window, len(ids)
        none = np.empty(0, np.int64)
        if n < window:
            return none, none, none.view(np.uint64), none.view(np.uint64)
        if len(self.up) <= n:
            self.up = _powers(_BASE, 2 * n)
            self.down = _powers(pow(_BASE, -1, 1 << 64), 2 * n)
        grams = np.full(n - self.gram + 1, self.gram, np.uint64)
        for k in range(self.gram):
            grams = _mixed(grams * _STEP + ids[k : n - self.gram + 1 + k])
        least = _first_least(grams, window - self.gram + 1)
        # The text of a window's first word is also that of its last.
        text = np.zeros(n, np.int64)
        np.add.at(text, begins[begins < n], 1)
        text = np.cumsum(text)
        inside = text[: n - window + 1] == text[window - 1 :]
        starts = np.flatnonzero(inside)
        if not len(starts):
            return none, none, none.view(np.uint64), none.view(np.uint64)
        own = least[starts]
        fresh = (np.diff(own) != 0) | (np.diff(starts) != 1)
        edges = np.append(0, np.flatnonzero(fresh) + 1)
        first = starts[edges]
        count = np.diff(np.append(edges, len(starts)))
        sums = np.append(np.uint64(0), np.cumsum(_mixed(ids) * self.up[:n], dtype=np.uint64))
        content = (sums[first + count + window - 1] - sums[first]) * self.down[first]
        return first, count, grams[own[edges]], _mixed(content + count.astype(np.uint64))


CELL = "key long, content long, first int, count int"


def _cells(window: int, gram: int):
    """A row for each super-k-mer of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, cutter = WordIds(), Cutter(window, gram)
        owners, parts, offsets, held = [], [], [], 0

        def out(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            nonlocal held
            sizes = np.array([len(p) for p in parts])
            begins = np.cumsum(sizes) - sizes
            first, count, key, content = cutter.cut(np.concatenate(parts), begins)
            part = np.searchsorted(begins, first, side="right") - 1
            take = pa.array(np.array(owners)[part])
            first = first - begins[part] + np.array(offsets)[part]
            owners.clear(), parts.clear(), offsets.clear()
            held = 0
            yield pa.record_batch(
                [
                    batch.column("doc_id").take(take),
                    batch.column("text_hash").take(take),
                    pa.array(key.view(np.int64)),
                    pa.array(content.view(np.int64)),
                    pa.array(first.astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                ],
                ["doc_id", "text_hash", "key", "content", "first", "count"],
            )

        for batch in slices(batches, 1000):
            for i, text in enumerate(byte_texts(batch)):
                words = text.split()
                for start in range(0, max(0, len(words) - window + 1), PIECE):
                    own = words[start : start + PIECE + window - 1]
                    parts.append(np.fromiter(map(memo.__getitem__, own), np.uint64, len(own)))
                    owners.append(i)
                    offsets.append(start)
                    held += len(own)
                    if held >= PIECE:
                        yield from out(batch)
            if parts:
                yield from out(batch)

    return run


def _packed(window: int):
    """Super-k-mers as strings: their words joined by spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in slices(batches, 200):
            owner, key, size, first, packed = [], [], [], [], []
            names = zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist())
            rows = zip(names, byte_texts(batch), batch.column("cells").to_pylist())
            for i, (name, text, cells) in enumerate(rows):
                if name == before:
                    continue  # repeated rows come one after the other
                before, words = name, text.split()
                for cell in cells:
                    owner.append(i)
                    key.append(cell["key"])
                    size.append(cell["size"])
                    first.append(cell["first"])
                    packed.append(b" ".join(words[cell["first"] : cell["first"] + cell["count"] + window - 1]))
            take = pa.array(owner, pa.int64())
            yield pa.record_batch(
                [
                    batch.column("doc_id").take(take),
                    batch.column("text_hash").take(take),
                    pa.array(key, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(first, pa.int32()),
                    pa.array(packed, pa.binary()),
                ],
                ["doc_id", "text_hash", "key", "size", "first", "packed"],
            )

    return run


def _windows(packed: bytes, window: int) -> list[bytes]:
    words = packed.split(b" ")
    return [b" ".join(words[k : k + window]) for k in range(len(words) - window + 1)]


def repeated_places(strings: list[bytes], window: int) -> list[tuple[int, int]]:
    """``(string, window)`` of the windows that an earlier string of the bucket has too."""
    places = sorted((w, i, k) for i, s in enumerate(strings) for k, w in enumerate(_windows(s, window)))
    return [(i, k) for (w, i, k), (before, *_) in zip(places[1:], places) if w == before]


def _sorted_buckets(window: int):
    """Repeats inside each bucket; rows come sorted by bucket and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, bucket = None, []

        def out(rows: list[dict]) -> Iterator[pa.RecordBatch]:
            if found := [
                (r["doc_id"], r["text_hash"], r["first"] + k, r["first"] + k)
                for i, k in repeated_places([r["packed"] for r in rows], window)
                for r in [rows[i]]
            ]:
                columns = zip(zip(*found), [id_type, pa.int64(), pa.int32(), pa.int32()])
                yield pa.record_batch([pa.array(c, t) for c, t in columns], SPAN_NAMES)

        for batch in slices(batches, 1000):
            id_type = batch.schema.field("doc_id").type
            for row in batch.to_pylist():
                if row["key"] != name:
                    yield from out(bucket)
                    name, bucket = row["key"], []
                if not bucket or any(row[c] != bucket[-1][c] for c in SPAN_NAMES[:3]):
                    bucket.append(row)
        yield from out(bucket)

    return run


def _digests(window: int):
    """Each window by itself, under a digest of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            owner, digest, place = [], [], []
            rows = zip(batch.column("packed").to_pylist(), batch.column("first").to_pylist())
            for i, (packed, first) in enumerate(rows):
                for k, own in enumerate(_windows(packed, window)):
                    owner.append(i)
                    digest.append(hashlib.blake2b(own, digest_size=16).digest())
                    place.append(first + k)
            take = pa.array(owner, pa.int64())
            yield pa.record_batch(
                [
                    pa.array(digest, pa.binary()),
                    batch.column("doc_id").take(take),
                    batch.column("text_hash").take(take),
                    pa.array(place, pa.int32()),
                ],
                ["digest", "doc_id", "text_hash", "first"],
            )

    return run


SPAN_NAMES = ["doc_id", "text_hash", "first", "last"]


def _by_text(rows: DataFrame, what, name: str) -> DataFrame:
    """Lists for each text; equal rows of repeated documents count once."""
    return rows.groupBy("doc_id", "text_hash").agg(F.collect_set(what).alias(name))


def _joined(texts: DataFrame, lists: DataFrame, how: str, name: str) -> DataFrame:
    lists = lists.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    same = texts["doc_id"].eqNullSafe(lists["_id"]) & (texts["text_hash"] == lists["_hash"])
    return texts.join(lists, same, how).select(*texts.columns, name)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", whole_text().alias("text")).withColumn("text_hash", F.xxhash64("text"))


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """``(doc_id, text_hash, spans)``: starts of repeated windows as ``(first, last)``.

    Texts without any are left out. Needs ``gram <= window``.
    """
    texts = _texts(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    owner = f"doc_id {id_type}, text_hash long"
    cells, cells_path = kept(texts.mapInArrow(_cells(window, gram), f"{owner}, {CELL}"), "super-kmers")
    met, met_path = kept(
        cells.groupBy("key").agg(F.count("*").alias("times")).filter("times > 1").select("key"), "super-kmer-keys"
    )
    # Tables are written before they are joined: so a join can split a hot bucket.
    shared, shared_path = kept(cells.join(met, "key", "left_semi"), "super-kmers-met")
    dropped(cells, cells_path)
    dropped(met, met_path)

    place = F.struct("doc_id", "text_hash", "first")
    strings, strings_path = kept(
        shared.groupBy("key", "content").agg(F.min(place).alias("at"), F.first("count").alias("count")),
        "super-kmer-contents",
    )
    sizes, sizes_path = kept(
        strings.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "super-kmer-buckets"
    )
    copies = (
        shared.join(strings.select("key", "content", "at"), ["key", "content"])
        .filter(~place.eqNullSafe(F.col("at")))
        .select("doc_id", "text_hash", "first", (F.col("first") + F.col("count") - 1).alias("last"))
    )
    found = [kept(copies, "repeats-of-strings")]

    open_cells = strings.join(sizes, "key").select(
        "at.doc_id", "at.text_hash", F.struct("key", "size", "at.first", "count").alias("cell")
    )
    open_texts = _joined(texts, _by_text(open_cells, F.col("cell"), "cells"), "inner", "cells")
    packed, packed_path = kept(
        open_texts.mapInArrow(_packed(window), f"{owner}, key long, size long, first int, packed binary"),
        "super-kmer-strings",
    )
    for path in (shared_path, strings_path, sizes_path):
        dropped(docs, path)
    order = ["key", "doc_id", "text_hash", "first"]
    small = packed.filter(F.col("size") <= bucket).repartition("key").sortWithinPartitions(*order)
    found.append(kept(small.mapInArrow(_sorted_buckets(window), f"{owner}, first int, last int"), "repeats-in-buckets"))

    single, single_path = kept(
        packed.filter(F.col("size") > bucket).mapInArrow(_digests(window), f"digest binary, {owner}, first int"),
        "single-windows",
    )
    dropped(packed, packed_path)
    firsts, firsts_path = kept(
        single.groupBy("digest").agg(F.min(place).alias("at"), F.count("*").alias("times")).filter("times > 1"),
        "first-windows",
    )
    later = single.join(firsts, "digest").filter(~place.eqNullSafe(F.col("at")))
    found.append(kept(later.select("doc_id", "text_hash", "first", F.col("first").alias("last")), "repeats-of-windows"))
    for path in (single_path, firsts_path):
        dropped(docs, path)

    spans = found[0][0]
    for more, _ in found[1:]:
        spans = spans.unionByName(more)
    spans, _ = kept(_by_text(spans, F.struct("first", "last"), "spans"), "repeated-windows")
    for _, path in found:
        dropped(docs, path)
    return spans


def cut_out(words: list[bytes], spans: list[dict] | None, window: int) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The words that stay, and the maximal removed runs ``(start, stop)``."""
    runs: list[tuple[int, int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in spans or ()):
        if runs and first <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(runs[-1][1], last + window)
        else:
            runs.append((first, last + window))
    edges = [0, *(e for run in runs for e in run), len(words)]
    return [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]], runs


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """``(doc_id, n_words, kept, spans)``: remaining words, and removed ``(start, stop)`` in words."""
    spans = repeated_windows(docs, window, gram, bucket)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            n, left, runs = [], [], []
            for text, own in zip(byte_texts(batch), batch.column("spans").to_pylist()):
                words = text.split()
                n.append(len(words))
                stay, gone = cut_out(words, own, window)
                left.append(b" ".join(stay))
                runs.append([{"start": a, "stop": b} for a, b in gone])
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(left, pa.binary()).cast(pa.string()),
                    pa.array(runs, run_type),
                ],
                ["doc_id", "n_words", "kept", "spans"],
            )

    return _joined(_texts(docs), spans, "left", "spans").mapInArrow(
        run, f"doc_id {id_type}, n_words long, kept string, spans array<struct<start:long,stop:long>>"
    )
