"""The most frequent merges, foretold on the driver and checked over all words.

The driver follows the exact counts of all pairs, and keeps a sample of words: all frequent ones,
and rarer ones in proportion to their frequency, weighted for those left out. On these it plays the
next merges through. One pass over all words then applies them, one after the other, and brings back
how each of them changed the counts. The driver replays these changes: a merge stands as long as it
was the best pair by exact counts. The first one always does, so a wrong forecast costs a pass and
never changes a merge.

A word takes part in a round of merging for each merge it holds, so a pass costs about as much as
encoding all words once. What comes back is bounded by the vocabulary: of each merge, the pairs
that have one of its tokens.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.merging import OrderedMerger
from corpusmill.operators.pair_index import Following, Merge
from corpusmill.session import drop_path, scratch_path

CHANGE = "step int, left int, right int, n long"
# Words and bytes that a task works on at a time.
WORDS = 50_000
BYTES = 1 << 20
# Merges foretold for the first pass, and for any.
FIRST_STEPS = 64
MOST_STEPS = 256
# Bits of a token id, and buckets of priorities per power of two.
ID_BITS = 20
BUCKETS = 8

Pair = tuple[int, int]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of words, their lengths and frequencies, some words at a time."""
    kept, rows = [], 0

    def joined() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        words = pa.concat_arrays([b.column(0).cast(pa.binary()) for b in kept])
        freqs = pa.concat_arrays([b.column(1) for b in kept]).to_numpy()
        ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1].astype(np.int64)
        codes = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        # A group ends before the word that would make it longer than BYTES.
        start = 0
        while start < len(words):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + BYTES, "right")) - 1)
            yield codes[ends[start] : ends[stop]], np.diff(ends[start : stop + 1]), freqs[start:stop]
            start = stop

    for batch in batches:
        kept.append(batch)
        rows += batch.num_rows
        if rows >= WORDS:
            yield from joined()
            kept, rows = [], 0
    if rows:
        yield from joined()


def _summed(step: np.ndarray, left: np.ndarray, right: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    key = (step << ID_BITS | left) << ID_BITS | right
    whole = pa.table({"key": key, "n": n}).group_by("key").aggregate([("n", "sum")])
    key, n = whole["key"].to_numpy(), whole["n_sum"].to_numpy()
    key, n = key[n != 0], n[n != 0]
    low = (1 << ID_BITS) - 1
    columns = [key >> 2 * ID_BITS, key >> ID_BITS & low, key & low]
    return pa.record_batch([*[pa.array(c.astype(np.int32)) for c in columns], pa.array(n)], ["step", "left", "right", "n"])


def _counts(merger: OrderedMerger):
    """Neighbouring tokens after all merges, as changes of step 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, sizes, freqs in _groups(batches):
            ids, owner = merger.run_codes(codes, sizes)
            at = np.flatnonzero(owner[1:] == owner[:-1])
            yield _summed(np.zeros(len(at), np.int64), ids[at], ids[at + 1], freqs[owner[at]])

    return run


def _changes(merger: OrderedMerger, first: int):
    """What each merge from ``first`` on changes in the counts of pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, sizes, freqs in _groups(batches):
            found: list[tuple[np.ndarray, ...]] = []
            merger.run_codes(codes, sizes, lambda *change: found.append(change), first)
            if found:
                rank, left, right, owner, sign = (np.concatenate(c) for c in zip(*found))
                yield _summed(rank - first, left, right, sign * freqs[owner])

    return run


class MergePasses:
    """Counts of all pairs over ``(word, freq)``; :meth:`close` removes the stored words."""

    def __init__(self, words: DataFrame, first_byte: list[int], later_byte: list[int], sample_words: int):
        self.spark = words.sparkSession
        self.bytes = first_byte, later_byte
        self.merges: list[Merge] = []
        self.steps = FIRST_STEPS
        self.path = scratch_path(self.spark, "words")
        # Several files for each core, as a few large ones would leave cores idle.
        tasks = 3 * self.spark.sparkContext.defaultParallelism
        words.select("word", "freq").repartition(tasks, "word").write.parquet(self.path)
        self.words = self.spark.read.schema("word string, freq long").parquet(self.path)
        self.counts: dict[Pair, int] = {}
        for _, pair, n in self._collected(_counts(OrderedMerger(*self.bytes, []))):
            self.counts[pair] = n
        self.sample, self.weights = self._sampled(sample_words)

    def _collected(self, function) -> Iterator[tuple[int, Pair, int]]:
        made = self.words.mapInArrow(function, CHANGE).groupBy("step", "left", "right").agg(F.sum("n").alias("n"))
        for batch in made.filter("n != 0").toArrow().to_batches():
            columns = (c.to_pylist() for c in batch.columns)
            for step, left, right, n in zip(*columns):
                yield step, (left, right), n

    def _sampled(self, most: int) -> tuple[list[bytes], list[int]]:
        """At most so many words, those of greatest ``freq / hash``, and what each of them stands for."""
        part = (F.pmod(F.xxhash64("word"), F.lit(1 << 31)) + 1) / F.lit(float(1 << 31))
        ranked = self.words.withColumn("bucket", F.floor(F.log2(F.col("freq") / part) * BUCKETS))
        total, least = 0, None
        for row in sorted(ranked.groupBy("bucket").count().collect(), key=lambda r: -r["bucket"]):
            total += row["count"]
            if total > most:
                break
            least = row["bucket"]
        if least is None:
            return [], []
        complete = total <= most
        kept = ranked.filter(F.col("bucket") >= least).select("word", "freq").collect()
        stands = 0 if complete else round(2 ** (least / BUCKETS))
        return [r.word.encode() for r in kept], [max(r.freq, stands) for r in kept]

    def best(self, least: int) -> Pair | None:
        n, pair = min(((-n, pair) for pair, n in self.counts.items()), default=(0, None))
        return pair if pair and -n >= least else None

    def forecast(self, first_new: int) -> Following:
        """The next merges by the sample. Those after the first may turn out to be others."""
        ids, owner = OrderedMerger(*self.bytes, self.merges).run(self.sample)
        ranked = [(*pair, n) for pair, n in self.counts.items()]
        return Following(ids, owner, self.weights, ranked, None, first_new)

    def confirm(self, planned: list[Merge], least: int) -> int:
        """Apply the merges up to the first one that is not the best; the number of those applied."""
        first = len(self.merges)
        changes: list[list[tuple[Pair, int]]] = [[] for _ in planned]
        for step, pair, n in self._collected(_changes(OrderedMerger(*self.bytes, [*self.merges, *planned]), first)):
            changes[step].append((pair, n))
        queue = [(-n, pair) for pair, n in self.counts.items()]
        heapq.heapify(queue)
        for step, merge in enumerate(planned):
            while queue and self.counts.get(queue[0][1]) != -queue[0][0]:
                heapq.heappop(queue)
            if not queue or queue[0][1] != merge[:2] or -queue[0][0] < least:
                break
            self.merges.append(merge)
            for pair, change in changes[step]:
                n = self.counts.pop(pair, 0) + change
                if n > 0:
                    self.counts[pair] = n
                    heapq.heappush(queue, (-n, pair))
        applied = len(self.merges) - first
        self.steps = min(2 * applied + 16, MOST_STEPS)
        return applied

    def close(self) -> None:
        drop_path(self.spark, self.path)
