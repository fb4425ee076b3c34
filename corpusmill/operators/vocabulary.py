"""Byte-pair vocabulary training as Spark jobs (Sennrich et al. 2016)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.byte_symbols import SYMBOLS, to_symbols
from corpusmill.functions.text import normalize_nfkc, pretokenize
from corpusmill.operators.merge_passes import MergePasses
from corpusmill.operators.pair_index import PairIndex
from corpusmill.operators.tokenizer import SPECIAL_TOKENS, Tokenizer

# Fixed values -------------------------------------------------------------
VOCAB_SIZE = 8192
MIN_FREQUENCY = 2
# --------------------------------------------------------------------------

# Best pairs looked at per round, pairs whose counts the driver follows, and rounds after which
# the log of pairs is folded.
TOP_PAIRS = 256
HOT_PAIRS = 20_000
REFRESH_ROUNDS = 64
# Merges found in passes over all words; the following ones touch fewer words and use the index.
PASS_MERGES = 512
# Words that come to the driver for a forecast at most.
SAMPLE_WORDS = 50_000
# Words that come to the driver for a round at most, and pairs that are looked for in them.
LOOK_WORDS = 50_000
LOOK_PAIRS = 2048


def word_counts(
    df: DataFrame,
    col: str = "text",
    add_prefix_space: bool = False,
    normalize: bool = True,
) -> DataFrame:
    """Distinct pre-tokens with their frequency: ``(word, freq)``."""
    text = normalize_nfkc(F.col(col)) if normalize else F.col(col)
    return (
        df.select(F.explode(pretokenize(text, add_prefix_space)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def _neighbours(symbols: Column) -> Column:
    n = F.size(symbols) - 1
    return F.arrays_zip(F.slice(symbols, F.lit(1), n), F.slice(symbols, F.lit(2), n))


def _pairs_of(words: DataFrame, seg: Column, weight: Column) -> DataFrame:
    """Neighbouring symbols of words written with one character per symbol."""
    several = words.filter(F.length(seg) > 1)
    return several.select(
        weight.alias("n"), F.inline(_neighbours(F.split(seg, ""))).alias("l", "r")
    )


def pair_counts(words: DataFrame) -> DataFrame:
    """Neighbouring byte symbols over all words, weighted by frequency: ``(l, r, n)``."""
    return (
        _pairs_of(words, to_symbols(F.col("word")), F.col("freq"))
        .groupBy("l", "r")
        .agg(F.sum("n").alias("n"))
    )


def independent_prefix(ranked: Sequence[tuple[int, int, int]], complete: bool) -> int:
    """How many of the best pairs can be merged before the counts must be taken again.

    Merging ``(l, r)`` changes only pairs that start with ``r`` or end with ``l``, and a new
    pair is never more frequent than such a pair was. So the next pair is still the best one
    when it is none of those and strictly more frequent than all of those.
    """
    starts, ends = set(), set()
    for k, (left, right, n) in enumerate(ranked):
        rivals = [(p, q) for p, q, m in ranked[: k + 1] if m >= n]
        tied = [(p, q) for p, q, m in ranked[k + 1 :] if m == n]
        cut_off = not complete and ranked[-1][2] == n
        if k and (cut_off or any(p in ends or q in starts for p, q in rivals + tied)):
            return k
        starts.add(left)
        ends.add(right)
    return len(ranked)


def _later_symbols(words: DataFrame, prefix: str) -> list[str]:
    """Tokens of the bytes that stand behind the first one of a word: at most 256."""
    text = F.decode(F.encode("word", "UTF-8"), "ISO-8859-1")
    later = words.select(F.explode(F.split(F.substring(text, 2, 1 << 30), "")).alias("b"))
    found = later.filter("b != ''").distinct().collect()
    return [prefix + s for s in sorted(SYMBOLS[ord(row.b)] for row in found)]


def _foretold(
    passes: MergePasses, tokens: list[str], ids: dict[str, int], prefix: str, vocab_size: int, least: int
) -> list[tuple[int, int, int]]:
    """Merges for the next pass, with the ids that their tokens have or would get."""
    names, fresh = list(tokens), {}
    following = passes.forecast(len(tokens))
    planned = []
    while len(planned) < passes.steps and len(names) < vocab_size and (pair := following.best(least)):
        token = names[pair[0]] + names[pair[1]][len(prefix) :]
        known = ids.get(token, fresh.get(token))
        if known is None:
            fresh[token] = len(names)
            names.append(token)
        planned.append((*pair, fresh[token] if known is None else known))
        # A token made a second time adds to pairs that the forecast does not follow.
        if known is not None:
            break
        following.merge(pair, planned[-1][2])
    return planned


def train_bpe(
    words: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    min_frequency: int = MIN_FREQUENCY,
    specials: Sequence[str] = SPECIAL_TOKENS,
    continuing_prefix: str = "",
    add_prefix_space: bool = False,
    refresh: int = REFRESH_ROUNDS,
    top_pairs: int = TOP_PAIRS,
    hot_pairs: int = HOT_PAIRS,
    look_words: int = LOOK_WORDS,
    pass_merges: int = PASS_MERGES,
    sample_words: int = SAMPLE_WORDS,
) -> Tokenizer:
    """Learn merges from ``(word, freq)`` until ``vocab_size`` or ``min_frequency`` stops it.

    The best pair is the most frequent one, then the one with the lower token ids. The first
    ``pass_merges`` lie in a large share of all words: they are foretold on ``sample_words`` words
    and checked in passes over all. For the following ones the driver
    follows the counts of the ``hot_pairs`` most frequent pairs. A round merges those that are
    provably next in line: the words that hold them are found in an index, give up their old
    pairs and get their new ones, and the changes of counts come back. What reaches the driver
    is bounded by the vocabulary: of a round, the pairs that have a token of its merges.

    Where the best pairs are rare enough to lie in ``look_words`` words at most, those words come
    to the driver and tell many merges in a row; the tasks apply them as any others. This
    changes the number of rounds and not the merges.
    """
    tokens = [*specials, *sorted(SYMBOLS)]
    if continuing_prefix:
        tokens += _later_symbols(words, continuing_prefix)
    ids = {token: i for i, token in enumerate(tokens)}
    merges: list[tuple[str, str]] = []
    least = max(min_frequency, 1)

    def add(left: int, right: int) -> tuple[int, bool]:
        """Id of the merged token, and whether it was there before."""
        pair = tokens[left], tokens[right]
        token = pair[0] + pair[1][len(continuing_prefix) :]
        merges.append(pair)
        known = token in ids
        if not known:
            ids[token] = len(tokens)
            tokens.append(token)
        return ids[token], known

    def trained() -> Tokenizer:
        return Tokenizer(
            tokens=tuple(tokens),
            merges=tuple(merges),
            specials=tuple(specials),
            add_prefix_space=add_prefix_space,
            continuing_prefix=continuing_prefix,
        )

    start = [ids[s] for s in SYMBOLS], [ids.get(continuing_prefix + s, -1) for s in SYMBOLS]
    passes = MergePasses(words, *start, sample_words)
    while len(tokens) < vocab_size and len(merges) < pass_merges and passes.best(least):
        planned = _foretold(passes, tokens, ids, continuing_prefix, vocab_size, least)
        for left, right, _ in planned[: passes.confirm(planned, least)]:
            add(left, right)
    if len(tokens) >= vocab_size or not passes.best(least):
        passes.close()
        return trained()

    index = PairIndex(passes.words, *start, hot_pairs, passes.merges)
    passes.close()
    while len(tokens) < vocab_size:
        ranked, complete = index.best(max(top_pairs, LOOK_PAIRS), least)
        if not ranked:
            break
        first = ranked[:top_pairs]
        sure = first[: independent_prefix(first, complete and len(ranked) <= top_pairs)]
        # A pair is in as many words as its count at most.
        look = sum(n <= look_words for n in accumulate(n for *_, n in ranked))
        if look == len(ranked) and not complete:
            look -= 1
        batch, known = [], False
        if look > 2 * len(sure) + 16:
            left, right, n = ranked[look] if look < len(ranked) else (0, 0, 0)
            following = index.look_ahead(ranked[:look], (-n, left, right) if n else None, len(tokens))
            while len(tokens) < vocab_size and not known and (pair := following.best(least)):
                merged, known = add(*pair)
                batch.append((*pair, merged))
                following.merge(pair, merged)
        else:
            for left, right, _ in sure:
                merged, known = add(left, right)
                batch.append((left, right, merged))
                # A token made a second time adds to the pairs it is already part of.
                if known or len(tokens) >= vocab_size:
                    break
        if len(tokens) < vocab_size:
            index.merge(batch, fold=known or index.rounds_to_fold >= refresh)
    index.close()
    return trained()
