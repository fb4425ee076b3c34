"""Which words hold which pairs of neighbouring tokens, through all rounds of merging.

The index is a log. A round writes, for each word its merges touch, the pairs that the word lost
or got: ``(left, right, word, freq, times)``. A word holds a pair since the round that made one of
its two tokens, so the words of a pair are looked up in the entries of those rounds alone. An entry
may be out of date, since a later merge may have taken the pair away; then the word is looked at
in vain. The state of a word is not stored: it follows from its bytes and the merges so far.

Counts of pairs are sums over the log. The driver follows the best pairs, down to a last one; those
behind it only lose, unless a token is made a second time, so they stay behind. When the pairs that
are followed are used up, or after a number of rounds, the log is folded: rounds become one sorted
segment, and all counts are summed again. The index may start after some merges.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.merging import OrderedMerger
from corpusmill.session import drop_path, scratch_path

ENTRY = "left int, right int, word string, freq long, times int"
_NAMES = [c.split()[0] for c in ENTRY.split(", ")]
# Words that a task works on at a time.
WORDS = 20_000

Merge = tuple[int, int, int]


def _neighbours(merger: OrderedMerger | None, words: list[bytes]) -> tuple[np.ndarray, ...]:
    if merger is None:
        return (np.empty(0, np.int64),) * 3
    ids, owner = merger.run(words)
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    return owner[inside], ids[inside], ids[inside + 1]


def _changes(before: OrderedMerger | None, after: OrderedMerger):
    """Pairs that each word has more or less often after the merges than before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, WORDS):
                batch = whole.slice(start, WORDS)
                words = batch.column("word").cast(pa.binary()).to_pylist()
                was, now = _neighbours(before, words), _neighbours(after, words)
                owner, left, right = (np.concatenate(c) for c in zip(was, now))
                sign = np.repeat([-1, 1], [len(was[0]), len(now[0])])
                order = np.lexsort((right, left, owner))
                owner, left, right, sign = owner[order], left[order], right[order], sign[order]
                edge = (np.diff(owner) != 0) | (np.diff(left) != 0) | (np.diff(right) != 0)
                first = np.append(0, np.flatnonzero(edge) + 1)[: len(owner)]
                times = np.add.reduceat(sign, first) if len(first) else sign
                first, times = first[times != 0], times[times != 0]
                take = pa.array(owner[first])
                yield pa.record_batch(
                    [
                        pa.array(left[first].astype(np.int32)),
                        pa.array(right[first].astype(np.int32)),
                        batch.column("word").take(take),
                        batch.column("freq").take(take),
                        pa.array(times.astype(np.int32)),
                    ],
                    _NAMES,
                )

    return run


class PairIndex:
    """The log of a training run, in the shared folder; :meth:`close` removes it."""

    def __init__(
        self,
        words: DataFrame,
        first_byte: list[int],
        later_byte: list[int],
        hot_pairs: int,
        merges: list[Merge] | None = None,
    ):
        self.spark = words.sparkSession
        self.bytes = first_byte, later_byte
        self.hot_pairs = hot_pairs
        self.run = scratch_path(self.spark, "pairs")
        self.merges: list[Merge] = list(merges or [])
        # The folder of each round's entries, the first round of each folder, and the rounds that
        # made each token; bytes and earlier merges are there from the start.
        self.folder: list[str] = []
        self.made: dict[int, list[int]] = {merged: [0] for _, _, merged in self.merges}
        self.counts: DataFrame | None = None
        self.to_fold: list[str] = []
        self.hot: dict[tuple[int, int], int] = {}
        self.last: tuple[int, int, int] | None = None
        start = words.select("word", "freq").mapInArrow(_changes(None, self._merger()), ENTRY)
        # The word is part of the order, so that a pair of very many words is cut as well.
        self._write(start.repartitionByRange("left", "right", "word").sortWithinPartitions("left", "right"))
        self.fold()

    @property
    def floor(self) -> int:
        """No pair that is not followed has a greater count."""
        return -self.last[0] if self.last else 0

    @property
    def rounds_to_fold(self) -> int:
        return len(self.to_fold)

    def _merger(self) -> OrderedMerger:
        return OrderedMerger(*self.bytes, self.merges)

    def _write(self, entries: DataFrame) -> str:
        path = f"{self.run}/round-{len(self.folder)}"
        entries.write.parquet(path)
        self.folder.append(path)
        self.to_fold.append(path)
        return path

    def _read(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(*paths)

    def best(self, most: int, least: int) -> tuple[list[tuple[int, int, int]], bool]:
        """The best pairs with their counts, and whether there are no others of ``least``."""
        found = [(-n, *pair) for pair, n in self.hot.items() if n >= least]
        if not found and self.floor >= least:
            self.fold()
            found = [(-n, *pair) for pair, n in self.hot.items() if n >= least]
        top = heapq.nsmallest(most, found)
        return [(left, right, -n) for n, left, right in top], len(top) == len(found) and self.floor < least

    def _touched(self, pairs: list[tuple[int, int]]) -> DataFrame:
        """``(word, freq)`` of the words that hold one of the pairs."""
        paths = {
            self.folder[k]
            for born in [(self.made.get(left, [0]), self.made.get(right, [0])) for left, right in pairs]
            for k in {*born[0], *born[1]}
            if k >= max(born[0][0], born[1][0])
        }
        left, right = F.col("left"), F.col("right")
        asked = (
            left.isin(*{p[0] for p in pairs})
            & right.isin(*{p[1] for p in pairs})
            & F.array_contains(F.lit([p[0] << 32 | p[1] for p in pairs]), left.cast("long") * (1 << 32) + right)
        )
        held = self._read(*sorted(paths)).filter(asked & (F.col("times") > 0))
        return held.groupBy("word").agg(F.first("freq").alias("freq"))

    def look_ahead(self, ranked: list[tuple[int, int, int]], bound: tuple[int, int, int] | None, first_new: int):
        """Merges that follow each other, as :class:`Following` finds them in the pairs' words."""
        words = self._touched([(left, right) for left, right, _ in ranked]).collect()
        ids, owner = self._merger().run([r.word.encode() for r in words])
        return Following(ids, owner, [r.freq for r in words], ranked, bound, first_new)

    def merge(self, batch: list[Merge], fold: bool = False) -> None:
        """Apply merges, one after the other, to the words that hold their pairs.

        A pair with a token of the same batch is in words that an earlier merge has touched.
        """
        fresh: set[int] = set()
        there = []
        for left, right, merged in batch:
            if not {left, right} & fresh:
                there.append((left, right))
            if merged not in self.made and merged not in fresh:
                fresh.add(merged)
        touched = self._touched(there)
        before = self._merger()
        self.merges += batch
        path = self._write(touched.mapInArrow(_changes(before, self._merger()), ENTRY))
        for merged in {m for _, _, m in batch}:
            self.made.setdefault(merged, []).append(len(self.folder) - 1)
        if fold:
            self.fold()
            return
        changed = self._summed(self._read(path)).filter(f"n < 0 or n >= {self.floor}")
        for row in changed.collect():
            pair = row.left, row.right
            n = self.hot.pop(pair, 0) + row.n
            if n > 0 and (self.last is None or (-n, *pair) <= self.last):
                self.hot[pair] = n

    @staticmethod
    def _summed(entries: DataFrame) -> DataFrame:
        n = F.sum(F.col("times") * F.col("freq"))
        return entries.groupBy("left", "right").agg(n.alias("n"))

    def fold(self) -> None:
        """Sum all counts, and make one segment of the rounds since the last time."""
        counts = self._summed(self._read(*self.to_fold))
        if self.counts is not None:
            counts = self.counts.unionByName(counts).groupBy("left", "right").agg(F.sum("n").alias("n"))
        path = f"{self.run}/counts-{len(self.folder)}"
        counts.filter("n > 0").write.parquet(path)
        self.counts = self.spark.read.schema("left int, right int, n long").parquet(path)
        top = self.counts.orderBy(F.desc("n"), "left", "right").limit(self.hot_pairs + 1).collect()
        more = len(top) > self.hot_pairs
        top = top[: self.hot_pairs]
        self.last = (-top[-1].n, top[-1].left, top[-1].right) if more else None
        self.hot = {(r.left, r.right): r.n for r in top}
        if len(self.to_fold) > 1:
            whole = f"{self.run}/segment-{len(self.folder)}"
            entries = self._read(*self.to_fold).filter("times > 0")
            entries.repartitionByRange("left", "right", "word").sortWithinPartitions("left", "right").write.parquet(whole)
            old = set(self.to_fold)
            self.folder = [whole if f in old else f for f in self.folder]
            for folder in old:
                drop_path(self.spark, folder)
        self.to_fold = []

    def close(self) -> None:
        drop_path(self.spark, self.run)


class Following:
    """The next merges, from all words that hold the best pairs.

    Those words have all occurrences of the best pairs and of the pairs that merging them makes.
    Any other pair has a count of ``bound`` at most, and only loses. So the next merge is known
    as long as the best of the known pairs comes before ``bound``, ``(-n, left, right)``.
    """

    def __init__(self, ids: np.ndarray, owner: np.ndarray, freqs: list[int], ranked, bound, first_new: int):
        edges = np.searchsorted(owner, np.arange(len(freqs) + 1))
        flat = ids.tolist()
        self.words = [flat[a:b] for a, b in zip(edges, edges[1:])]
        self.freqs, self.bound, self.first_new = freqs, bound, first_new
        self.counts = {(left, right): n for left, right, n in ranked}
        self.where: dict[tuple[int, int], set[int]] = {pair: set() for pair in self.counts}
        for i, word in enumerate(self.words):
            for pair in zip(word, word[1:]):
                if pair in self.where:
                    self.where[pair].add(i)
        self.queue = [(-n, *pair) for pair, n in self.counts.items()]
        heapq.heapify(self.queue)

    def best(self, least: int) -> tuple[int, int] | None:
        """The pair to be merged next, or None where that is not known or there is none."""
        while self.queue:
            n, *pair = self.queue[0]
            pair = tuple(pair)
            if self.counts.get(pair) != -n:
                heapq.heappop(self.queue)
                if self.counts.get(pair, 0) > 0 and -self.counts[pair] > n:
                    heapq.heappush(self.queue, (-self.counts[pair], *pair))
                continue
            known = self.bound is None or self.queue[0] < self.bound
            return pair if known and -n >= least else None
        return None

    def merge(self, pair: tuple[int, int], merged: int) -> None:
        left, right = pair
        for i in sorted(self.where[pair]):
            word, freq, new, k = self.words[i], self.freqs[i], [], 0
            while k < len(word):
                if word[k] == left and k + 1 < len(word) and word[k + 1] == right:
                    new.append(merged)
                    k += 2
                else:
                    new.append(word[k])
                    k += 1
            if len(new) == len(word):
                continue
            self.words[i] = new
            for one in zip(word, word[1:]):
                if one in self.counts:
                    self.counts[one] -= freq
            for one in zip(new, new[1:]):
                # Pairs with a token made here occur in these words alone.
                if one not in self.counts and max(one) >= self.first_new:
                    self.counts[one], self.where[one] = 0, set()
                if one in self.counts:
                    self.counts[one] += freq
                    self.where[one].add(i)
            for one in {*zip(new, new[1:])}:
                if one in self.counts and max(one) >= self.first_new:
                    heapq.heappush(self.queue, (-self.counts[one], *one))
