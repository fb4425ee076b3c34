"""Language-model scoring by prediction by partial matching over bytes.

The training texts give the counts of all byte strings of five (four bytes of context and the
next), and with them those of all shorter ones. They form a context trie: a node of depth k
holds the counts of what follows k bytes. Symbols not seen in a node are reached by an escape
(its number of distinct symbols against its total, method C) to the node without the first
byte, and symbols seen higher up are excluded there. A text's score is the log10 probability
of all its bytes and of its end. No node is left out: the model grows with the corpus.

Strings with at least a share of 1 / ``nodes`` of all training bytes (so at most ``nodes``) are
looked up inside the task. The others of a text, seen in training or not, are counted per text;
the distinct ones meet the counts of their two longest contexts in joins, whose keys have at
most 2^16 of them, and the nodes of at most two bytes (2^24 counts at most) in the task. Their
probabilities then meet the texts by a shuffle.

Word counts for the base score are joined to the words of each text. Words with at least a
share of 1 / ``frequent`` of all tokens (so at most ``frequent``, of 48 bytes at most) are
looked up inside the task; the rest, none of which is hot, meet their counts by a shuffle.

Defined cases: a null text is empty and scores its end alone; a null id counts as empty text
for the split; without training texts every byte has the same probability and all counts are
zero; repeated rows are scored each (and counted each); extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import byte_texts, kept, slices

ORDER = 4
NODES = 1 << 21
FREQUENT = 1 << 20
FREQUENT_BYTES = 48
SMOOTH = 0.1

_START = b"\0" * ORDER
_CHUNK = 4 << 20
_SLOT = np.uint64(0x9E3779B97F4A7C15)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts, each between a start of zero bytes and a zero byte as its end; text lengths."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    glue = b"\0" + _START
    return np.frombuffer(_START + glue.join(texts) + b"\0", np.uint8), sizes


def _grams(codes: np.ndarray) -> np.ndarray:
    keys = codes[ORDER:].astype(np.int64)
    for k in range(1, ORDER + 1):
        keys |= codes[ORDER - k : len(codes) - k].astype(np.int64) << (8 * k)
    return keys


def _scored_places(sizes: np.ndarray) -> np.ndarray:
    """Start and end of each text's own bytes (its end included) among the grams, in turn."""
    width = sizes + 1
    starts = np.concatenate([[0], np.cumsum(width + ORDER)[:-1]])
    return np.stack([starts, starts + width], axis=1).ravel()


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(place, np.concatenate(counts)).astype(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, times = np.empty(0, np.int64), np.empty(0, np.int64)

    def out():
        return pa.record_batch([pa.array(seen), pa.array(times)], ["gram", "n"])

    for batch in slices(batches, 1000):
        waiting, size = [], 0
        texts = byte_texts(batch)
        for i, text in enumerate(texts):
            waiting.append(text)
            size += len(text)
            if size < _CHUNK and i + 1 < len(texts):
                continue
            codes, sizes = _joined(waiting)
            keys = _grams(codes)
            inside = np.zeros(len(keys) + 1, np.int8)
            places = _scored_places(sizes)
            np.add.at(inside, places[::2], 1)
            np.add.at(inside, places[1::2], -1)
            own = keys[np.cumsum(inside[:-1], dtype=np.int8) > 0]
            fresh, n = np.unique(own, return_counts=True)
            seen, times = _merged([seen, fresh], [times, n])
            waiting, size = [], 0
            if len(seen) > 4_000_000:
                yield out()
                seen, times = np.empty(0, np.int64), np.empty(0, np.int64)
    if len(seen):
        yield out()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def out():
        words, n = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
        return pa.record_batch([pa.array(words, pa.binary()), pa.array(n)], ["word", "n"])

    for batch in slices(batches, 1000):
        for text in byte_texts(batch):
            counts.update(text.lower().split())
        if len(counts) > 500_000:
            yield out()
            counts.clear()
    if counts:
        yield out()


class Frequent:
    """Log10 probabilities of strings in a table of open addresses, at most half full."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.logs = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]
            there = self.keys[slots] == keys
            self.logs[slots[there]] = logs[there]
            keys, logs, slots = keys[~there], logs[~there], slots[~there] + 1 & self.last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _SLOT >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probability of each key, zero where it is not in the table; and where it is."""
        slots = self._slots(keys)
        found = self.keys[slots]
        there = found == keys
        logs = np.where(there, self.logs[slots], 0.0)
        open_ = np.flatnonzero(~there & (found >= 0))
        slots = slots[open_]
        while len(open_):
            slots = slots + 1 & self.last
            found = self.keys[slots]
            hit = found == keys[open_]
            there[open_[hit]] = True
            logs[open_[hit]] = self.logs[slots[hit]]
            go = ~hit & (found >= 0)
            open_, slots = open_[go], slots[go]
        return logs, there

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sums per text; number of the text, string and count of the strings not in the table."""
        codes, sizes = _joined(texts)
        keys = _grams(codes)
        inside = np.zeros(len(keys) + 1, np.int8)
        places = _scored_places(sizes)
        np.add.at(inside, places[::2], 1)
        np.add.at(inside, places[1::2], -1)
        own = keys[np.cumsum(inside[:-1], dtype=np.int8) > 0]
        logs, there = self.find(own)
        sums = np.add.reduceat(logs, np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]))
        rest = np.flatnonzero(~there)
        text = np.repeat(np.arange(len(texts)), sizes + 1)[rest]
        rest, times = np.unique(text << 40 | own[rest], return_counts=True)
        return sums, rest >> 40, rest & ((1 << 40) - 1), times


def _tail(parts: list[tuple], texts: int) -> pa.ListArray:
    """Lists of ``(gram, times)`` per text from ``(text, gram, times)`` arrays, ordered by text."""
    text, grams, times = (np.concatenate([p[k] for p in parts]) for k in range(3))
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(text, np.arange(texts + 1)), pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(grams, pa.int64()), pa.array(times, pa.int64())], ["gram", "times"]
        ),
    )


def _blocks(texts: list[bytes], least: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of at least so many bytes, but for the last, and where they start."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= least or i + 1 == len(texts):
            yield start, texts[start : i + 1]
            start, size = i + 1, 0


def _step(p: np.ndarray, done: np.ndarray, n, node, above) -> tuple[np.ndarray, np.ndarray]:
    """One depth down: ``node`` and ``above`` are (total, kinds, under) here and one byte deeper."""
    total = node[0] - above[2]
    kinds = np.where(node[1] == 256, 0, node[1] - above[1])  # nothing is left to escape to
    whole = np.maximum(total + kinds, 1)
    seen = ~done & (n > 0)
    part = np.where(seen, n, np.where(done | (total == 0), whole, kinds)) / whole
    return p + np.log10(part), done | seen


@dataclass(frozen=True)
class Short:
    """Nodes of at most two bytes: per depth the strings with their counts, and the contexts
    with total, kinds, and the sum of the counts their symbols have one byte less deep."""

    strings: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray) -> Short:
        strings, contexts = [], []
        for k in range(3):
            strings.append(_merged([keys & ((1 << 8 * (k + 1)) - 1)], [counts]))
            own, n = strings[k]
            under = np.zeros(len(own), np.int64)
            if k:
                under = _looked_up(*strings[k - 1], own & ((1 << 8 * k) - 1))
            nodes, place = np.unique(own >> 8, return_inverse=True)
            sums = [np.bincount(place, w, len(nodes)) for w in (n, np.ones(len(own)), under)]
            contexts.append((nodes, np.stack(sums).astype(np.int64)))
        return cls(strings, contexts)

    def logs(self, grams: np.ndarray, deep: list[tuple]) -> np.ndarray:
        """Log10 probabilities; ``deep`` has ``(n, (total, kinds, under))`` for depths 4 and 3."""
        p, done = np.zeros(len(grams)), np.zeros(len(grams), bool)
        above = (0, 0, 0)
        for n, node in deep:
            p, done = _step(p, done, n, node, above)
            above = node
        for k in (2, 1, 0):
            n = _looked_up(*self.strings[k], grams & ((1 << 8 * (k + 1)) - 1))
            nodes, sums = self.contexts[k]
            node = [_looked_up(nodes, s, grams >> 8 & ((1 << 8 * k) - 1)) for s in sums]
            p, done = _step(p, done, n, node, above)
            above = node
        return p - np.where(done, 0, np.log10(np.maximum(256 - above[1], 1)))


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of the wanted keys among the sorted ones; zero for others."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], 0)


@dataclass(frozen=True)
class Trie:
    """All counts as tables, the frequent strings and the short nodes as arrays."""

    grams: DataFrame
    shorter: DataFrame
    contexts: list[DataFrame]
    frequent: tuple[np.ndarray, np.ndarray]
    short: Short

    def logs(self, grams: DataFrame) -> DataFrame:
        """``(gram, log)`` of distinct strings."""
        context = F.shiftright("gram", 8)
        wanted = grams.select(
            "gram", context.alias("c4"), _low("gram", 4).alias("s3"), _low(context, 3).alias("c3")
        )
        joined = (
            wanted.join(self.grams.withColumnRenamed("n", "n4"), "gram", "left")
            .join(self.contexts[0].toDF("c4", "t4", "d4", "x4"), "c4", "left")
            .join(self.shorter.toDF("s3", "n3"), "s3", "left")
            .join(self.contexts[1].toDF("c3", "t3", "d3", "x3"), "c3", "left")
        )
        names = ["n4", "t4", "d4", "x4", "n3", "t3", "d3", "x3"]
        short = self.short

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own, *c = (column.to_numpy() for column in batch.columns)
                logs = short.logs(own, [(c[0], c[1:4]), (c[4], c[5:8])])
                yield pa.record_batch([pa.array(own), pa.array(logs)], ["gram", "log"])

        filled = joined.select("gram", *[F.coalesce(c, F.lit(0)).alias(c) for c in names])
        return filled.mapInArrow(run, "gram long, log double")


def _low(gram, size: int):
    return (F.col(gram) if isinstance(gram, str) else gram).bitwiseAND(F.lit((1 << 8 * size) - 1))


def _shorter(grams: DataFrame, size: int) -> DataFrame:
    return grams.groupBy(_low("gram", size).alias("gram")).agg(F.sum("n").alias("n"))


def _contexts(grams: DataFrame, shorter: DataFrame, size: int) -> DataFrame:
    """``(context, total, kinds, under)`` of strings of ``size`` bytes and those one byte shorter."""
    below = shorter.toDF("part", "lower")
    return (
        grams.withColumn("part", _low("gram", size - 1))
        .join(below, "part")
        .groupBy(F.shiftright("gram", 8).alias("context"))
        .agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("lower").alias("under"))
    )


def train_trie(texts: DataFrame, nodes: int = NODES) -> Trie:
    """The trie of all rows of ``texts``; what comes to the driver is at most ``nodes`` strings
    and the 2^24 counts of three bytes."""
    counted = texts.select("text").mapInArrow(_count_grams, "gram long, n long")
    grams, _ = kept(counted.groupBy("gram").agg(F.sum("n").alias("n")), "ppm-grams")
    everything = grams.agg(F.sum("n")).first()[0] or 0
    four, _ = kept(_shorter(grams, 4), "ppm-grams-4")
    three = _shorter(four, 3)
    deep, _ = kept(_contexts(grams, four, 5), "ppm-contexts-4")
    middle, _ = kept(_contexts(four, three, 4), "ppm-contexts-3")
    arrays = lambda df: tuple(c.to_numpy() for c in df.toArrow().columns)
    # A string seen after its four bytes needs no escape.
    heavy = grams.filter(F.col("n") * nodes >= everything)
    heavy = heavy.withColumn("context", F.shiftright("gram", 8)).join(deep, "context")
    whole = F.col("total") + F.when(F.col("kinds") == 256, 0).otherwise(F.col("kinds"))
    frequent = arrays(heavy.select("gram", F.log10(F.col("n") / whole)))
    return Trie(grams, four, [deep, middle], frequent, Short.of(*arrays(three)))


def score_texts(
    docs: DataFrame,
    learn_from: DataFrame,
    nodes: int = NODES,
    frequent: int = FREQUENT,
) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of every document.

    ``learn_from`` holds the rows of the training texts.
    """
    trie = train_trie(learn_from, nodes)
    counted = learn_from.select("text").mapInArrow(_count_words, "word binary, n long")
    words, _ = kept(counted.groupBy("word").agg(F.sum("n").alias("n")), "ppm-words")
    ends = learn_from.count()
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums.n + ends, sums.v + (ends > 0)
    below = float(total + SMOOTH * (distinct + 1))
    hot = (F.col("n") * frequent >= total) & (F.octet_length("word") <= FREQUENT_BYTES)
    top = words.filter(hot).toArrow()
    top_words = top.column("word").to_pylist()
    top_logs = np.log10((top.column("n").to_numpy() + SMOOTH) / below)
    end_log = float(np.log10((ends + SMOOTH) / below))
    end_known = int(ends > 0)
    tail_type = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int32())]))
    keys, key_logs = trie.frequent
    untrained = not ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = dict(zip(top_words, top_logs.tolist()))
        table = Frequent(keys, key_logs)
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, 500):
            texts = byte_texts(batch)
            sizes, known, base = [], [], []
            tail_words, tail_times, offsets = [], [], [0]
            for text in texts:
                own = text.lower().split()
                found = list(map(logs.get, own))
                rest = Counter(w for w, v in zip(own, found) if v is None)
                sizes.append(len(own) + 1)
                known.append(len(own) - rest.total() + end_known)
                base.append(sum(v for v in found if v is not None) + end_log)
                tail_words.extend(rest)
                tail_times.extend(rest.values())
                offsets.append(len(tail_words))
            tail = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(tail_words, pa.binary()), pa.array(tail_times, pa.int32())],
                    fields=list(tail_type.value_type),
                ),
            )
            score, rest = np.empty(len(texts)), [(np.empty(0, np.int64),) * 3]
            for start, part in _blocks(texts):
                if untrained:
                    score[start : start + len(part)] = [-(len(t) + 1) * np.log10(256) for t in part]
                    continue
                sums, text, grams, times = table.scores(part)
                score[start : start + len(part)] = sums
                rest.append((text + start, grams, times))
            yield pa.record_batch(
                [
                    pa.array(np.arange(row, row + len(texts))),
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(base, pa.float64()),
                    pa.array(score),
                    tail,
                    _tail(rest, len(texts)),
                ],
                ["row", "doc_id", "n_tokens", "known", "base", "score", "tail", "grams"],
            )
            row += len(texts)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    partial = docs.select("doc_id", "text").mapInArrow(
        run,
        f"row long, doc_id {id_type}, n_tokens long, known long, base double, score double, "
        "tail array<struct<word:binary,times:int>>, grams array<struct<gram:long,times:long>>",
    )
    # The row numbers hold once they are written.
    rows, _ = kept(partial, "ppm-rows")
    rare = rows.select("row", F.inline("tail"))
    cold = words.filter(~hot)
    log = F.log10((F.coalesce("n", F.lit(0)) + SMOOTH) / below)
    words_added = rare.join(cold, "word", "left").select(
        "row",
        (F.col("times") * log).alias("rare_log"),
        F.when(F.col("n").isNotNull(), F.col("times")).cast("long").alias("rare_known"),
        F.lit(0.0).alias("rare_score"),
    )
    found = rows.select("row", F.inline("grams"))
    logs, _ = kept(trie.logs(found.select("gram").distinct()), "ppm-logs")
    grams_added = found.join(logs, "gram").select(
        "row",
        F.lit(0.0).alias("rare_log"),
        F.lit(None).cast("long").alias("rare_known"),
        (F.col("times") * F.col("log")).alias("rare_score"),
    )
    sums = [F.sum(c).alias(c) for c in ("rare_log", "rare_known", "rare_score")]
    added = words_added.unionByName(grams_added).groupBy("row").agg(*sums)
    return (
        rows.drop("tail", "grams")
        .join(added, "row", "left")
        .select(
            "doc_id",
            "n_tokens",
            (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("rare_log", F.lit(0.0))).alias("base_score"),
            (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
        )
    )
