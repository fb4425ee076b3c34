"""Suffix-array deduplication: bytes inside long strings that occur twice or more.

A byte goes if a string of ``length`` bytes over it also starts anywhere else. The strings
starting at all places are sorted into buckets, and buckets are refined with the identifiers
that later places have in the same round: the identifier of 2k bytes at p is made of those of
k bytes at p and at p + k, and each level is used again by the next. Identifiers are mixed from
contents, so they mean the same in every task. Places are followed only as far as needed:

1. Of the q-grams in each string the least is its anchor. Strings in a row with one anchor form
   a cell, and a cell is one row: its fine bucket is that of the anchor's q-gram, its coarse
   bucket that of all bytes of the cell.
2. The cells of step 1 that are left are cut into ranges of a few places. A range's fine bucket
   is that of the bytes all its strings share, its coarse bucket that of all its bytes.
3. The ranges that are left are cut into single strings.

After each step, places that share a coarse bucket are repeats, all strings of them. A fine
bucket of one coarse bucket ends there; of each coarse bucket in the others, one place goes on.

No pair of places is ever formed, and a bucket is only counted, with a partial count per task.
A bucket is named by two 64-bit identifiers, of the anchor's q-gram and of the content.

Defined cases: a null or short text has no string and stays; repeated rows are repeats of one
another; null ids stay null; a text of any length is read in pieces of bounded memory; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import byte_texts, dropped, kept, slices, whole_text

# Fixed value: the length of a repeated string.
LENGTH = 400
GRAM = 64
# Strings of this length are tried before those of the full length.
SHORT = 352
PIECE = 1 << 20

_rng = np.random.default_rng(20240229)
BYTE_IDS = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FACTORS = _rng.integers(0, 1 << 63, (16, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def refined(left: np.ndarray, right: np.ndarray, level: int) -> np.ndarray:
    """Identifiers of the joined strings from those of their halves."""
    a, b = FACTORS[level]
    mixed = left * a + right * b
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    return mixed


class Buckets:
    """Bucket identifiers of the strings at all places of a text, for any length asked for."""

    def __init__(self, text: np.ndarray):
        self.n = len(text)
        self.levels = [BYTE_IDS[text]]  # level k: strings of 2**k bytes

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            below, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(refined(below[:-half], below[half:], len(self.levels)))
        return self.levels[k]

    def at(self, places: np.ndarray | None, length: int) -> np.ndarray:
        """Identifiers of ``length`` bytes at ``places``, or at all places."""
        out, offset = None, 0
        for k in range(length.bit_length() - 1, -1, -1):
            if length >> k & 1:
                ids = self.level(k)
                if places is None:
                    part = ids[offset : offset + self.n - length + 1]
                else:
                    part = ids[places + offset]
                out = part if out is None else refined(out, part, 12)
                offset += 1 << k
        return out


def _least_in_window(keys: np.ndarray, window: int) -> np.ndarray:
    least, width = keys, 1
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = window - width
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def anchors(grams: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For each string its anchor: the place of its least q-gram, the first of equal ones."""
    bits = np.uint64(len(grams).bit_length())
    place = np.arange(len(grams), dtype=np.uint64)
    keys = (grams >> bits << bits) | place
    least = _least_in_window(keys, length - gram + 1)
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def cells(text: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Cells of a text, piece by piece, in the columns of ``PLACES``."""
    codes = np.frombuffer(text, np.uint8)
    for start in range(0, max(0, len(codes) - length + 1), PIECE):
        own = codes[start : start + PIECE + length - 1]
        buckets = Buckets(own)
        grams = buckets.at(None, gram)
        anchor = anchors(grams, length, gram)
        first = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
        last = np.append(first[1:] - 1, len(anchor) - 1)
        anchor = anchor[first]
        # The strings at the first and the last place cover the cell.
        ends = refined(buckets.at(first, length), buckets.at(last, length), 13)
        shape = ((anchor - first) * length + (last - first)).astype(np.uint64)
        content = refined(ends, BYTE_IDS[0] + shape, 14)
        yield grams[anchor], grams[anchor], content, first + start, last + start, anchor + start


PLACES = "bucket long, fine long, coarse long, first int, last int, anchor int"
_NAMES = [c.split()[0] for c in PLACES.split(", ")]


def ranges_of(buckets: Buckets, begin: int, cell: dict, length: int, gram: int, short: int):
    """Ranges of a cell. ``buckets`` are those of the text from ``begin`` on.

    All strings that start between ``t`` and ``t + length - short`` bytes before the anchor
    share the ``short`` bytes that start ``t`` before it.
    """
    step = length - short
    low, high = cell["anchor"] - cell["last"], cell["anchor"] - cell["first"]
    starts = np.arange(0, length - gram + 1, step + 1)
    starts = starts[(starts <= high) & (starts + step >= low)]
    least, most = np.maximum(starts, low), np.minimum(starts + step, high)
    first, last = cell["anchor"] - most, cell["anchor"] - least
    shared = buckets.at(cell["anchor"] - starts - begin, short)
    fine = refined(shared, BYTE_IDS[1] + starts.astype(np.uint64), 14)
    ends = refined(buckets.at(first - begin, length), buckets.at(last - begin, length), 13)
    shape = (least * length + most).astype(np.uint64)
    return fine, refined(ends, BYTE_IDS[2] + shape, 14), first, last


def strings_of(buckets: Buckets, begin: int, cell: dict, length: int):
    """The single strings of a range."""
    places = np.arange(cell["first"], cell["last"] + 1)
    before = (cell["anchor"] - places).astype(np.uint64)
    ids = refined(buckets.at(places - begin, length), BYTE_IDS[3] + before, 14)
    return ids, ids, places, places


def _nearby(cells_of_text: list[dict], length: int) -> Iterator[list[dict]]:
    """Cells in order, those close together in one list: they share the text between them."""
    together: list[dict] = []
    for cell in sorted(cells_of_text, key=lambda c: (c["first"], c["last"])):
        far = together and (
            cell["first"] > together[-1]["last"] + length
            or cell["last"] - together[0]["first"] > PIECE
        )
        if far:
            yield together
            together = []
        together.append(cell)
    if together:
        yield together


def _rows(batch: pa.RecordBatch, owner: list[np.ndarray], found: list[tuple]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*found)]
    take = pa.array(np.concatenate(owner))
    return pa.record_batch(
        [
            batch.column("doc_id").take(take),
            batch.column("text_hash").take(take),
            *[pa.array(c.view(np.int64)) for c in columns[:3]],
            *[pa.array(c.astype(np.int32)) for c in columns[3:]],
        ],
        ["doc_id", "text_hash", *_NAMES],
    )


def _cut_texts(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            found, owner = [], []
            for i, text in enumerate(byte_texts(batch)):
                for part in cells(text, length, gram):
                    found.append(part)
                    owner.append(np.full(len(part[0]), i))
            if found:
                yield _rows(batch, owner, found)

    return run


def _cut_cells(length: int, gram: int, short: int | None):
    """Cells into ranges; with no ``short``, ranges into strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            found, owner = [], []
            open_cells = batch.column("cells").to_pylist()
            for i, text in enumerate(byte_texts(batch)):
                codes = np.frombuffer(text, np.uint8)
                for group in _nearby(open_cells[i], length):
                    begin = group[0]["first"]
                    buckets = Buckets(codes[begin : max(c["last"] for c in group) + length])
                    for cell in group:
                        fine, coarse, first, last = (
                            ranges_of(buckets, begin, cell, length, gram, short)
                            if short
                            else strings_of(buckets, begin, cell, length)
                        )
                        n = len(fine)
                        bucket = np.full(n, cell["bucket"], np.int64).view(np.uint64)
                        found.append((bucket, fine, coarse, first, last, np.full(n, cell["anchor"])))
                        owner.append(np.full(n, i))
            if found:
                yield _rows(batch, owner, found)

    return run


def _settled(places: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Repeated places, and those that go on: one of each coarse bucket of the open fine ones."""
    fine, coarse = ["bucket", "fine"], ["bucket", "fine", "coarse"]
    counted = places.groupBy(*fine).agg(
        F.count("*").alias("n"), F.min("coarse").alias("least"), F.max("coarse").alias("most")
    )
    shared = counted.filter("n > 1").select(*fine, (F.col("least") != F.col("most")).alias("open"))
    # Written first: a join with a counted side as it stands cannot split a hot bucket.
    shared, path = kept(shared, f"{label}-counted")
    own, _ = kept(places.join(shared, fine), f"{label}-shared")
    dropped(shared, path)
    rest = [c for c in own.columns if c not in coarse]
    one, _ = kept(
        own.groupBy(*coarse).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in rest]),
        f"{label}-one",
    )
    repeated = own.join(one.filter("n > 1").select(*coarse), coarse, "left_semi")
    return repeated.select("doc_id", "text_hash", "first", "last"), one.filter("open")


def _by_text(places: DataFrame) -> DataFrame:
    cell = F.struct("bucket", "first", "last", "anchor")
    return places.groupBy("doc_id", "text_hash").agg(F.collect_list(cell).alias("cells"))


def _joined(texts: DataFrame, lists: DataFrame, how: str, names: list[str]) -> DataFrame:
    """Texts with what belongs to their id and text; null ids are equal."""
    lists = lists.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    same = texts["doc_id"].eqNullSafe(lists["_id"]) & (texts["text_hash"] == lists["_hash"])
    return texts.join(lists, same, how).select(*texts.columns, *names)


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, short: int = SHORT
) -> DataFrame:
    """``(doc_id, text_hash, spans)``: places of repeated strings as ``(first, last)`` starts.

    Texts without any are left out. Needs ``gram <= short < length``.
    """
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text_hash long, {PLACES}"
    long_enough = texts.filter(F.octet_length("text") >= length)
    first_cut, path = kept(long_enough.mapInArrow(_cut_texts(length, gram), schema), "repeat-cells")
    whole_cells, open_cells = _settled(first_cut, "repeat-cells")
    open_texts, _ = kept(_joined(texts, _by_text(open_cells), "inner", ["cells"]), "repeat-texts")
    ranges, _ = kept(open_texts.mapInArrow(_cut_cells(length, gram, short), schema), "repeat-ranges")
    whole_ranges, open_ranges = _settled(ranges, "repeat-ranges")
    again = _joined(open_texts.drop("cells"), _by_text(open_ranges), "inner", ["cells"])
    strings, _ = kept(again.mapInArrow(_cut_cells(length, gram, None), schema), "repeat-strings")
    whole_strings, _ = _settled(strings, "repeat-strings")
    dropped(first_cut, path)
    found = whole_cells.unionByName(whole_ranges).unionByName(whole_strings)
    return found.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("first", "last")).alias("spans")
    )


def cut_out(text: bytes, spans: list[dict] | None, length: int) -> tuple[bytes, list[tuple[int, int]]]:
    """What stays of a text, and the maximal removed runs."""
    runs: list[tuple[int, int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in spans or ()):
        if runs and first <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(runs[-1][1], last + length)
        else:
            runs.append((first, last + length))
    edges = [0, *(e for run in runs for e in run), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])), runs


def without_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, short: int = SHORT
) -> DataFrame:
    """``(doc_id, n_bytes, kept, spans)``: the remaining bytes and the removed ``(start, stop)``."""
    spans = repeated_spans(docs, length, gram, short)
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            texts = byte_texts(batch)
            found = [cut_out(t, s, length) for t, s in zip(texts, batch.column("spans").to_pylist())]
            runs = [[{"start": a, "stop": b} for a, b in r] for _, r in found]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([k for k, _ in found], pa.binary()),
                    pa.array(runs, run_type),
                ],
                ["doc_id", "n_bytes", "kept", "spans"],
            )

    return _joined(texts, spans, "left", ["spans"]).mapInArrow(
        run, f"doc_id {id_type}, n_bytes long, kept binary, spans array<struct<start:long,stop:long>>"
    )
