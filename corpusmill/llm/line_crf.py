"""Quality rules: repetition and length rules, and a conditional random field over lines.

A linear-chain model with two states, content and boilerplate, reads the lines of a document.
It is trained here by gradient steps on its log-likelihood over at most ``max_rows`` labelled
documents (those of smallest id hash). All lines of a bad document are boilerplate, and so are
lines of a good one that it has had before. With ``common``, so are also lines that stand behind
that many different lines in the whole corpus: a licence line does, while the lines of a copied
text stand behind the same line in every copy. This is left out unless asked for: it teaches
something only where shared lines look different from others. Viterbi decoding marks every
line; a document stays if content lines hold at least half of its words.

Defined cases: a null or empty text has no words and fails the base rules; lines without a word
are no part of the chain; a tie in decoding goes to content; repeated rows give a row each;
without labels of both classes every line is content; extra columns are kept by
:func:`line_rules` unless they have one of its column names, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.common import Scratch, byte_texts, slices, whole_text

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MAX_REPEAT_PERCENT = 30

MAX_TRAIN_ROWS = 3_000
CONTENT_SHARE = 0.5
N_FEATURES = 20

_SPACE = b" \t\n\x0b\x0c\r"
_NO_START = bytes(range(0x80, 0xC0))
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"


def _pair_ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    keys = left.astype(np.int64) * (int(right.max()) + 1) + right
    return np.unique(keys, return_inverse=True)[1]


def repeat_words(words: list[bytes]) -> int:
    """Words inside any window of eight words that the text holds twice or more."""
    n = len(words)
    if n <= WINDOW:
        return 0
    ids: dict[bytes, int] = {}
    ranks = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    mixed = ranks[: n - 7].astype(np.uint64)
    for k in range(1, WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ranks[k : n - 7 + k].astype(np.uint64)
    if len(np.unique(mixed)) == len(mixed):
        return 0
    # Equal hashes: compare exactly, by ranks of pairs, of fours and of eights.
    two = _pair_ranks(ranks[:-1], ranks[1:])
    four = _pair_ranks(two[:-2], two[2:])
    eight = _pair_ranks(four[:-4], four[4:])
    again = np.bincount(eight)[eight] > 1
    edge = np.zeros(n + 1, np.int64)
    edge[: n - 7] += again
    edge[WINDOW : n + 1] -= again
    return int((np.cumsum(edge)[:n] > 0).sum())


def line_features(line: bytes, words: list[bytes], seen: bool) -> list[int]:
    """Numbers of the binary features that hold for a line."""
    n, size = len(words), len(line)
    found = [0]
    symbols = size - len(line.translate(None, SYMBOLS))
    if symbols:
        found.append(1 if symbols * 50 < size else 2 if symbols * 16 < size else 3)
    marks = line.count(b"!")
    if marks * 25 >= size:
        found.append(4)
    upper = size - len(line.translate(None, _UPPER))
    if upper * 5 >= size:
        found.append(5 if upper * 2 < size else 6)
    digits = size - len(line.translate(None, _DIGITS))
    if digits * 5 >= size:
        found.append(7)
    alike = sum(map(bytes.__eq__, words[1:], words[:-1]))
    if alike:
        found.append(8 if alike * 4 < n else 9)
    if n >= 8:
        distinct = len(set(words))
        if distinct * 3 < n * 2:
            found.append(10 if distinct * 3 >= n else 11)
    found.append(12 if n < 3 else 13 if n < 10 else 14)
    if not line.rstrip().endswith((b".", b"!", b"?")):
        found.append(15)
    if seen:
        found.append(16)
    mean = size / n
    if mean > 14 or mean < 4:
        found.append(17 if mean > 14 else 18)
    if marks and marks * 25 < size:
        found.append(19)
    return found


def read(text: bytes) -> tuple[list[bytes], list[tuple[list[int], int]], int]:
    """Words; per line with a word its features and word count; lines seen before."""
    words: list[bytes] = []
    lines, seen, again = [], set(), 0
    for line in text.split(b"\n"):
        own = line.split()
        if own:
            known = line in seen
            again += known
            seen.add(line)
            lines.append((line_features(line, own, known), len(own)))
            words += own
    return words, lines, again


@dataclass(frozen=True)
class LineModel:
    """``emit`` per feature: weight of content against boilerplate; ``move[from, to]``."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def decode(self, scores: list[float]) -> list[bool]:
        """Viterbi: whether each line is content (state 1)."""
        (a, b), (c, d) = self.move.tolist()
        low, high = self.start.tolist()
        high += scores[0]
        back = []
        for s in scores[1:]:
            from_high0, from_high1 = high + c >= low + a, high + d >= low + b
            back.append((from_high0, from_high1))
            low, high = max(high + c, low + a), max(high + d, low + b) + s
        state = high >= low
        out = [state]
        for step in reversed(back):
            state = step[state]
            out.append(state)
        return out[::-1]

    def content_share(self, lines: list[tuple[list[int], int]]) -> float:
        if not lines:
            return 0.0
        weight = self.emit.tolist()
        marks = self.decode([sum(map(weight.__getitem__, f)) for f, _ in lines])
        return sum(n for mark, (_, n) in zip(marks, lines) if mark) / sum(n for _, n in lines)


EVEN = LineModel(np.zeros(N_FEATURES), np.zeros((2, 2)), np.zeros(2))


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def train(
    chains: list[np.ndarray],
    labels: list[np.ndarray] | np.ndarray,
    rounds: int = 200,
    rate: float = 0.1,
    decay: float = 1e-3,
) -> LineModel:
    """Maximum likelihood by Adam steps; ``chains`` hold a 0/1 feature row per line.

    ``labels`` has the states of the lines of each chain, or one state for all of them. All chains
    run together: sorted by length, step t works on those with more than t lines.
    """
    states = [np.broadcast_to(y, len(c)) for c, y in zip(chains, labels)]
    if len({int(y) for own in states for y in own}) < 2:
        return EVEN
    order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
    chains, states = [chains[i] for i in order], [states[i] for i in order]
    length = np.array([len(c) for c in chains])
    active = [int((length > t).sum()) for t in range(length[0])]
    rows = [np.stack([c[t] for c in chains[:n]]) for t, n in enumerate(active)]
    truth = [np.array([y[t] for y in states[:n]]) for t, n in enumerate(active)]
    params = np.zeros(N_FEATURES + 6)
    first, second = np.zeros_like(params), np.zeros_like(params)
    for k in range(1, rounds + 1):
        emit, move, start = params[:N_FEATURES], params[N_FEATURES:-2].reshape(2, 2), params[-2:]
        scores = [r @ emit for r in rows]
        alpha = [np.stack([np.full(active[0], start[0]), start[1] + scores[0]])]
        for t in range(1, len(rows)):
            a = alpha[-1][:, : active[t]]
            low = _log_add(a[0] + move[0, 0], a[1] + move[1, 0])
            high = _log_add(a[0] + move[0, 1], a[1] + move[1, 1]) + scores[t]
            alpha.append(np.stack([low, high]))
        total = np.zeros(len(chains))
        for t, n in enumerate(active):
            rest = active[t + 1] if t + 1 < len(active) else 0
            total[rest:n] = _log_add(alpha[t][0, rest:], alpha[t][1, rest:])
        grad_emit, grad_move, grad_start = np.zeros(N_FEATURES), np.zeros((2, 2)), np.zeros(2)
        beta = np.zeros((2, 0))
        for t in range(len(rows) - 1, -1, -1):
            n = active[t]
            back = np.zeros((2, n))
            later = beta.shape[1]
            if later:
                s = scores[t + 1]
                out = np.stack([beta[0], beta[1] + s])
                a = alpha[t][:, :later]
                y, z = truth[t][:later], truth[t + 1]
                for i in range(2):
                    for j in range(2):
                        p = np.exp(a[i] + move[i, j] + out[j] - total[:later])
                        grad_move[i, j] += ((y == i) & (z == j)).sum() - p.sum()
                    back[i, :later] = _log_add(move[i, 0] + out[0], move[i, 1] + out[1])
            high = np.exp(alpha[t][1] + back[1] - total[:n])
            grad_emit += rows[t].T @ (truth[t] - high)
            if t == 0:
                grad_start += [(truth[0] == 0).sum() - (1 - high).sum(), truth[0].sum() - high.sum()]
            beta = back
        grad = np.concatenate([grad_emit, grad_move.ravel(), grad_start]) / len(chains) - decay * params
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        params = params + rate * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    return LineModel(params[:N_FEATURES], params[N_FEATURES:-2].reshape(2, 2), params[-2:])


def _chain_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of each line with a word, its hash, and whether the text has had it before."""
    kinds = [pa.list_(pa.list_(pa.int32())), pa.list_(pa.int64()), pa.list_(pa.bool_())]
    for batch in slices(batches, 1000):
        found = []
        for text in byte_texts(batch):
            own = [line for line in text.split(b"\n") if line.split()]
            # The hash of Spark's xxhash64.
            hashes = [xxhash.xxh64_intdigest(line, seed=42) for line in own]
            hashes = [h - (1 << 64) if h >> 63 else h for h in hashes]
            first: dict[int, int] = {}
            again = [first.setdefault(h, k) < k for k, h in enumerate(hashes)]
            found.append(([f for f, _ in read(text)[1]], hashes, again))
        columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
        yield pa.record_batch([batch.column("label"), *columns], ["label", "lines", "hashes", "again"])


def common_lines(docs: DataFrame, hashes: DataFrame, least: int) -> DataFrame:
    """Those ``hash`` values whose lines stand behind ``least`` or more different lines of ``docs``."""
    lines = F.split(F.concat(F.lit("\n"), whole_text()), "\n")
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("lines") - 1),
        lambda i: F.struct(F.xxhash64(F.get("lines", i)).alias("hash"), F.xxhash64(F.get("lines", i - 1)).alias("behind")),
    )
    every = docs.select(lines.alias("lines")).select(F.inline(pairs))
    known = every.join(hashes.select("hash").distinct(), "hash", "left_semi").distinct()
    return known.groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("hash")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    max_rows: int = MAX_TRAIN_ROWS,
    common: int | None = None,
) -> LineModel:
    """Fit on labelled documents; ``labels`` has ``doc_id`` and the 0/1 column ``label``.

    With ``common`` their lines are counted over all of ``docs``.
    """
    chosen = (
        labels.filter(F.col(label).isin(0, 1))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "label")
        .limit(max_rows)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").drop("doc_id")
    schema = "label int, lines array<array<int>>, hashes array<long>, again array<boolean>"
    # Repeated ids make more rows than labels: of those too the ones of smallest hash are taken.
    chains = texts.mapInArrow(_chain_rows, schema).orderBy(F.xxhash64("hashes"), "label").limit(max_rows)
    with Scratch(docs.sparkSession) as scratch:
        chains = scratch.keep(chains, "line-chains")
        found = chains.filter("size(lines) > 0").collect()
        hashes = chains.filter("label = 1").select(F.explode("hashes").alias("hash"))
        shared = {r.hash for r in common_lines(docs, hashes, common).collect()} if found and common else set()
    found = sorted(found, key=lambda r: (r.hashes, r.label))
    rows, states = [], []
    for r in found:
        chain = np.zeros((len(r.lines), N_FEATURES))
        for t, on in enumerate(r.lines):
            chain[t, list(on)] = 1
        rows.append(chain)
        content = [r.label == 1 and not again and h not in shared for h, again in zip(r.hashes, r.again)]
        states.append(np.array(content, np.int64))
    return train(rows, states) if len({r.label for r in found}) > 1 else EVEN


def judge(text: bytes, model: LineModel) -> tuple:
    """One result row, in the order of ``RESULT``."""
    words, lines, again = read(text)
    n = len(words)
    chars = len(text.translate(None, _SPACE + _NO_START))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    repeat = repeat_words(words)
    failed = n < LEAST_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    share = model.content_share(lines)
    return n, chars, symbols, again, repeat, failed, share, not failed and share >= CONTENT_SHARE


def line_rules(docs: DataFrame, model: LineModel) -> DataFrame:
    """Add the columns of ``RESULT``."""
    added = T._parse_datatype_string(RESULT)
    docs = docs.drop(*added.names)
    schema = T.StructType([*docs.schema.fields, *added.fields])
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            rows = [judge(t, model) for t in byte_texts(batch)]
            found = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.record_batch([*batch.columns, *found], schema.names)

    return docs.mapInArrow(run, schema)
