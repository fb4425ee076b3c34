"""Token ids of pre-tokens, as an Arrow function over arrays of words."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Longer words, in bytes, are merged with a queue of their own.
LONG_WORD = 256
# Words of a batch that are encoded at a time, and distinct words merged together.
WORDS = 1 << 18
MERGED_WORDS = 1 << 14
# Above every pair of ids and every rank.
NO_PAIR = (1 << 63) - 1


def merge_symbols(
    ids: list[int], ranks: Mapping[tuple[int, int], tuple[int, int]]
) -> list[int]:
    """Merge the lowest-ranked neighbouring pair until none is left.

    ``ranks`` maps a pair of ids to its rank and the id of the merged token.
    """
    ids = list(ids)
    end = len(ids)
    after = list(range(1, end + 1))
    before = list(range(-1, end - 1))
    queue = [
        (ranks[pair], at, pair) for at, pair in enumerate(zip(ids, ids[1:])) if pair in ranks
    ]
    heapq.heapify(queue)
    while queue:
        (_, merged), at, pair = heapq.heappop(queue)
        right = after[at]
        if ids[at] is None or right == end or (ids[at], ids[right]) != pair:
            continue
        ids[at], ids[right] = merged, None
        after[at] = after[right]
        if after[at] != end:
            before[after[at]] = at
        for left in (before[at], at):
            if left >= 0 and after[left] != end:
                fresh = (ids[left], ids[after[left]])
                if fresh in ranks:
                    heapq.heappush(queue, (ranks[fresh], left, fresh))
    return [i for i in ids if i is not None]


class WordMerger:
    """Merges many words at once.

    The symbols of all words lie in one array. A round looks up the rank of every neighbouring
    pair, merges the best pair of each word, the first of equal ones, and goes on with the
    words that changed. A few very long words are merged one by one.
    """

    def __init__(
        self,
        whole_words: Mapping[str, int],
        first_byte: list[int],
        later_byte: list[int],
        ranks: Mapping[tuple[int, int], tuple[int, int]],
    ):
        self.whole_words, self.ranks = dict(whole_words), dict(ranks)
        self.first, self.later = np.array(first_byte, np.int64), np.array(later_byte, np.int64)
        order = sorted((left << 32 | right, rank, merged) for (left, right), (rank, merged) in ranks.items())
        table = np.array(order, np.int64).reshape(-1, 3)
        # A last row that no pair equals and that is never the best.
        self.pairs, self.rank, self.merged = np.append(table, [[NO_PAIR] * 3], axis=0).T.copy()

    def encode(self, words: list[str]) -> pa.ListArray:
        """Ids of each word; whole words are never cut (special tokens)."""
        plain, numbers, ids, owner = [], [], [], []
        for i, word in enumerate(words):
            data = word.encode("utf-8")
            if word in self.whole_words:
                own = [self.whole_words[word]]
            elif len(data) > LONG_WORD:
                codes = np.frombuffer(data, np.uint8)
                own = [*self.first[codes[:1]].tolist(), *self.later[codes[1:]].tolist()]
                own = merge_symbols(own, self.ranks)
            else:
                plain.append(data)
                numbers.append(i)
                continue
            ids += own
            owner += [i] * len(own)
        merged = [(np.array(ids, np.int32), np.array(owner, np.int64))]
        numbers = np.array(numbers, np.int64)
        for start in range(0, len(plain), MERGED_WORDS):
            own, of = self._merged(plain[start : start + MERGED_WORDS])
            merged.append((own.astype(np.int32), numbers[start + of]))
        flat, of = (np.concatenate(c) for c in zip(*merged))
        flat = flat[np.argsort(of, kind="stable")]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(words)))])
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))

    def _merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, those of a word in order, and the word of each."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        owner = np.repeat(np.arange(len(words)), sizes)
        codes = np.frombuffer(b"".join(words), np.uint8)
        ids = self.later[codes]
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        ids[starts] = self.first[codes[starts]]
        rank = np.full(len(ids), NO_PAIR)
        into = np.zeros(len(ids), np.int64)
        fresh = np.arange(len(ids))
        done_ids, done_owner = [], []
        while len(ids):
            # Pairs that begin at the places where a symbol or its neighbour is new.
            pair = fresh[fresh + 1 < len(ids)]
            pair = pair[owner[pair] == owner[pair + 1]]
            keys = ids[pair] << 32 | ids[pair + 1]
            place = np.searchsorted(self.pairs, keys)
            place = np.where(self.pairs[place] == keys, place, len(self.pairs) - 1)
            rank[fresh] = NO_PAIR
            rank[pair], into[pair] = self.rank[place], self.merged[place]

            begins = np.append(True, owner[1:] != owner[:-1])
            best = np.minimum.reduceat(rank, np.flatnonzero(begins))
            word = np.cumsum(begins) - 1
            stay = (best < NO_PAIR)[word]
            done_ids.append(ids[~stay])
            done_owner.append(owner[~stay])
            hits = np.flatnonzero(stay & (rank == best[word]))
            hits = hits[np.append(True, word[hits[1:]] != word[hits[:-1]])[: len(hits)]]
            ids[hits] = into[hits]
            stay[hits + 1] = False
            new_place = np.cumsum(stay) - 1
            ids, owner, rank, into = ids[stay], owner[stay], rank[stay], into[stay]
            fresh = np.concatenate([new_place[hits], new_place[hits] - 1])
            fresh = fresh[fresh >= 0]
        return np.concatenate([*done_ids, ids]), np.concatenate([*done_owner, owner])


class OrderedMerger:
    """Merges applied one after the other to many words, as training applies them.

    :class:`WordMerger` takes the lowest rank that a word offers; here the ranks of a word only
    rise. The two differ where a token is made by a second pair after its own merges were
    applied, and where a pair is merged a second time.
    """

    def __init__(self, first_byte: list[int], later_byte: list[int], merges: list[tuple[int, int, int]]):
        """``merges`` are ``(left, right, merged)`` ids in the order they are applied."""
        self.first, self.later = np.array(first_byte, np.int64), np.array(later_byte, np.int64)
        table = np.array(merges, np.int64).reshape(-1, 3)
        keys = table[:, 0] << 32 | table[:, 1]
        order = np.argsort(keys, kind="stable")
        self.pairs = np.append(keys[order], NO_PAIR)
        self.rank = np.append(order, NO_PAIR)
        self.merged = np.append(table[order, 2], 0)

    def _places(self, keys: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Rows of the table: the first of each pair that is not below its floor."""
        last = len(self.pairs) - 1
        place = np.searchsorted(self.pairs, keys)
        while True:
            known = self.pairs[place] == keys
            low = known & (self.rank[place] < floor)
            if not low.any():
                return np.where(known, place, last)
            place = np.where(low, place + 1, place)

    def run(
        self, words: list[bytes], changed: Callable[..., None] | None = None, since: int = 0
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, those of a word in order, and the word of each.

        ``changed`` is told the pairs that the merges of rank ``since`` and above take and make:
        ``(rank, left, right, word, sign)``.
        """

        sizes = np.fromiter(map(len, words), np.int64, len(words))
        return self.run_codes(np.frombuffer(b"".join(words), np.uint8), sizes, changed, since)

    def run_codes(
        self, codes: np.ndarray, sizes: np.ndarray, changed: Callable[..., None] | None = None, since: int = 0
    ) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`run` over the bytes of all words and the length of each."""

        def tell(at: np.ndarray, ranks: np.ndarray, sign: int) -> None:
            pairs = np.zeros(len(ids), bool)
            pairs[at[(at >= 0) & (at + 1 < len(ids))]] = True
            at = np.flatnonzero(pairs)
            at = at[owner[at] == owner[at + 1]]
            changed(ranks[at], ids[at], ids[at + 1], owner[at], np.full(len(at), sign))

        owner = np.repeat(np.arange(len(sizes)), sizes)
        ids = self.later[codes]
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        ids[starts] = self.first[codes[starts]]
        rank, into = np.full(len(ids), NO_PAIR), np.zeros(len(ids), np.int64)
        floor, fresh = np.zeros(len(sizes), np.int64), np.arange(len(ids))
        done = []
        while len(ids):
            pair = fresh[fresh + 1 < len(ids)]
            pair = pair[owner[pair] == owner[pair + 1]]
            place = self._places(ids[pair] << 32 | ids[pair + 1], floor[owner[pair]])
            rank[fresh] = NO_PAIR
            rank[pair], into[pair] = self.rank[place], self.merged[place]
            begins = np.append(True, owner[1:] != owner[:-1])
            best = np.minimum.reduceat(rank, np.flatnonzero(begins))[np.cumsum(begins) - 1]
            stay = best < NO_PAIR
            done.append((ids[~stay], owner[~stay]))
            hits = np.flatnonzero(stay & (rank == best))
            # Of pairs that overlap every second one is merged, from the left.
            alone = np.append(True, (np.diff(hits) != 1) | (owner[hits[1:]] != owner[hits[:-1]]))[: len(hits)]
            run = np.maximum.accumulate(np.where(alone, np.arange(len(hits)), 0))
            hits = hits[(np.arange(len(hits)) - run) % 2 == 0]
            told = hits[rank[hits] >= since] if changed else hits[:0]
            if len(told):
                tell(np.concatenate([told - 1, told, told + 1]), best, -1)
            ids[hits] = into[hits]
            floor[owner[hits]] = rank[hits]
            stay[hits + 1] = False
            new_place = np.cumsum(stay) - 1
            ids, owner, rank, into = ids[stay], owner[stay], rank[stay], into[stay]
            if len(told):
                tell(np.concatenate([new_place[told] - 1, new_place[told]]), best[stay], 1)
            near = np.concatenate([new_place[hits], new_place[hits] - 1])
            changing = np.zeros(len(ids), bool)
            changing[near[near >= 0]] = True
            fresh = np.flatnonzero(changing)
        if not done:
            return ids, owner
        ids, owner = (np.concatenate(c) for c in zip(*done))
        order = np.argsort(owner, kind="stable")
        return ids[order], owner[order]


def array_encoder(merger: WordMerger) -> Callable[[pa.Array], pa.Array]:
    """Lift the merger to Arrow lists of words.

    A batch may hold the words of many long texts, so it is worked on some words at a time,
    whatever rows they are in. Each distinct one of them is merged once, all of them together;
    Arrow spreads the ids to the rows.
    """

    def encode_rows(rows: pa.Array) -> pa.Array:
        flat = rows.flatten()
        row_ends = np.cumsum(np.append(0, pc.fill_null(pc.list_value_length(rows), 0).to_numpy()), dtype=np.int64)
        offsets = np.zeros(len(row_ends), np.int64)
        pieces, before = [pa.array([], pa.int32())], 0
        for start in range(0, len(flat), WORDS):
            words = flat.slice(start, WORDS).dictionary_encode()
            ids = merger.encode(words.dictionary.to_pylist()).take(words.indices)
            ends = np.cumsum(np.append(0, pc.list_value_length(ids).to_numpy()), dtype=np.int64) + before
            inside = slice(*np.searchsorted(row_ends, [start + 1, start + len(words) + 1]))
            offsets[inside] = ends[row_ends[inside] - start]
            pieces.append(ids.flatten())
            before = int(ends[-1])
        # Rows without words stand where the row before them ends.
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.concat_arrays(pieces), mask=rows.is_null())

    return encode_rows
