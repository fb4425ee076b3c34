"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct word shingles. Every shingle flips one bit of a parity
sketch, so the Hamming distance of two sketches is at most the size of the sets' symmetric
difference, and a Jaccard similarity of t allows a difference of (a + b)(1 - t)/(1 + t) for set
sizes a and b. Sizes fall into bands. In a band the shingles are dealt to more pieces than the
greatest difference D of its pairs, and the hashes in a piece are XORed to one 64-bit word. Of
D + 1 + e pieces, two similar sets agree in e + 1 at least; so a set with at most e empty pieces
leaves those out, and still agrees with its partners in a piece that both have. A set is also
put into the next band if a partner may be there.

Sets that are equal form one node. Nodes that share a piece meet in a bucket:

* of two nodes: they are a candidate pair;
* of more: their parity sketches are compared by Hamming distance, and a spanning forest of the
  pairs that pass, closest first, are the candidates. Buckets of many nodes are cut into blocks,
  and every two blocks are compared by a task of their own.

Candidates are verified on the texts' shingle sets. If a pair of a forest fails, all pairs of
its bucket that pass and lie across the parts still linked are verified as well. So no link
between two components is lost, while the pairs inside a family are not written out.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with
nothing; a text of fewer words than a shingle has one shingle of all its words; equal sets are
linked; rows with a null id get their component's smallest id; repeated rows give a row each;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import Scratch, WordIds, byte_texts, dropped, kept, slices, whole_text
from corpusmill.llm.token_ids import release_encoders

BLOCK = 1024
# Sets a task remembers having met, so as to write their pieces once.
MET = 100_000
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = keys ^ (keys >> np.uint64(32))
    keys = keys * _MIX
    keys ^= keys >> np.uint64(29)
    keys *= _STEP
    return keys ^ (keys >> np.uint64(32))


def shingles(text: bytes, size: int, memo: dict) -> np.ndarray:
    """Sorted hashes of the distinct shingles; A-Z count as a-z."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    width = min(size, n)
    keys = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        keys = _mixed(keys * _STEP + ids[k : n - width + 1 + k])
    return np.unique(keys)


@dataclass(frozen=True)
class Similarity:
    """A Jaccard similarity of at least ``part / whole`` on shingles of ``words`` words."""

    words: int = 3
    part: int = 9
    whole: int = 10

    def difference(self, a, b):
        """Greatest symmetric difference of similar sets of these sizes."""
        return (a + b) * (self.whole - self.part) // (self.whole + self.part)

    def partner(self, n: int) -> int:
        """Size of the greatest set that may be similar to one of ``n``."""
        return n * self.whole // self.part

    @cached_property
    def edges(self) -> list[int]:
        """Greatest size of each band; from one to the next it grows by the root of two."""
        first = next(n for n in range(1, 1 << 20) if self.difference(n, n) >= 1)
        return [int(first * 2 ** (j / 2)) for j in range(2 * (48 - first.bit_length()))]

    def bands(self, n: int) -> list[int]:
        if n == 0 or self.difference(n, self.partner(n)) == 0:
            return []  # only an equal set is similar
        own = int(np.searchsorted(self.edges, n))
        return [own, own + 1] if self.partner(n) > self.edges[own] else [own]

    def pieces(self, band: int) -> tuple[int, int]:
        """Number of pieces of a band, and how many empty ones a set may leave out."""
        edge = self.edges[band]
        most = int(self.difference(edge, edge))
        spare = 1 + most // 8
        return most + 1 + spare, spare


def pieces(keys: np.ndarray, number: int, spare: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pieces to be joined on, and their words."""
    place = ((keys >> np.uint64(20)) % np.uint64(number)).astype(np.int64)
    words = np.zeros(number, np.uint64)
    np.bitwise_xor.at(words, place, keys)
    filled = np.bincount(place, minlength=number) > 0
    if number - filled.sum() > spare:
        filled[:] = True
    return np.flatnonzero(filled), words[filled]


def sketch(keys: np.ndarray) -> np.ndarray:
    """Parity bits of a set, at least two per shingle; their number is a power of two."""
    width = max(256, 1 << int(2 * len(keys) - 1).bit_length())
    bits = np.bincount((keys & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def folded(words: np.ndarray, width: int) -> np.ndarray:
    """The same sketch with fewer words; distances only become smaller."""
    return np.bitwise_xor.reduce(words.reshape(-1, width), axis=0)


def _node(keys: np.ndarray) -> int:
    """Name of a set."""
    both = np.bitwise_xor.reduce(keys, keepdims=True) + keys.sum(keepdims=True)
    return int(_mixed(both).view(np.int64)[0])


def _buckets(keys: np.ndarray, near: Similarity) -> np.ndarray:
    """Names of a set's buckets, from band, number and word of each piece."""
    names = []
    for band in near.bands(len(keys)):
        number, words = pieces(keys, *near.pieces(band))
        label = number.astype(np.uint64) << np.uint64(8) | np.uint64(band)
        names.append(_mixed(_mixed(words + _STEP) + label))
    return np.concatenate(names).view(np.int64)


def _set_rows(near: Similarity):
    """A row per document; a set that has bands gives its sketch and its buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        memo, met = WordIds(), set()
        for batch in slices(batches, 1000):
            out, buckets = [], []
            for text in byte_texts(batch):
                keys = shingles(text, near.words, memo)
                node = _node(keys) if len(keys) else 0
                # Sketch and buckets of a set are needed once; equal sets are common in one task.
                fresh = node not in met and near.bands(len(keys))
                out.append((len(keys), node, sketch(keys).tobytes() if fresh else None))
                buckets.append(_buckets(keys, near) if fresh else np.empty(0, np.int64))
                met.add(node)
            if len(met) > MET:
                met.clear()
            kinds = [pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            ends = np.cumsum([0, *map(len, buckets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(buckets)))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("text_hash"), *columns, lists],
                ["doc_id", "text_hash", "n", "node", "sketch", "buckets"],
            )

    return run


def _passing(sketches: np.ndarray, sizes: np.ndarray, near: Similarity) -> np.ndarray:
    """Hamming distances of pairs that may be similar; the others have the greatest value."""
    n = len(sizes)
    far = np.iinfo(np.int32).max
    out = np.full((n, n), far, np.int32)
    step = max(1, (1 << 22) // max(1, n * sketches.shape[1]))
    for i in range(0, n, step):
        own = sizes[i : i + step, None]
        distance = np.bitwise_count(sketches[i : i + step, None] ^ sketches[None]).sum(axis=2, dtype=np.int32)
        alike = np.minimum(own, sizes) * near.whole >= np.maximum(own, sizes) * near.part
        ok = alike & (distance <= near.difference(own, sizes))
        out[i : i + step] = np.where(ok, distance, far)
    np.fill_diagonal(out, far)
    return out


def _forest(distance: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest, closest first from each tree."""
    n, far = len(distance), np.iinfo(np.int32).max
    outside = np.ones(n, bool)
    edges = []
    best, link = np.full(n, far), np.zeros(n, np.int64)
    while outside.any():
        reach = np.where(outside, best, far)
        v = int(reach.argmin())
        if reach[v] == far:
            v = int(outside.argmax())
        else:
            edges.append((int(link[v]), v))
        outside[v] = False
        closer = distance[v] < best
        best = np.where(closer, distance[v], best)
        link[closer] = v
    return edges


def _across(distance: np.ndarray, linked: list[tuple[int, int]], failed: list[tuple[int, int]]):
    """Pairs that pass and lie across the parts joined by ``linked``, without ``failed`` ones."""
    label = list(range(len(distance)))

    def root(x: int) -> int:
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for a, b in linked:
        label[root(a)] = root(b)
    part = np.array([root(i) for i in range(len(label))])
    ok = (distance < np.iinfo(np.int32).max) & (part[:, None] != part)
    for a, b in failed:
        ok[a, b] = ok[b, a] = False
    return list(zip(*np.nonzero(np.triu(ok))))


def _bucket_rows(near: Similarity, again: bool):
    """Candidates of each bucket; rows come sorted by bucket.

    With ``again``, rows without a sketch name verified pairs ``(node, other, linked)``.
    """

    def candidates(rows: list[dict]) -> list[tuple[int, int]]:
        nodes = {r["node"]: r for r in rows if r["sketch"] is not None}
        names = sorted(nodes)
        width = min(len(nodes[v]["sketch"]) for v in names) // 8
        sketches = np.stack([folded(np.frombuffer(nodes[v]["sketch"], np.uint64), width) for v in names])
        distance = _passing(sketches, np.array([nodes[v]["n"] for v in names]), near)
        close = np.flatnonzero((distance < np.iinfo(np.int32).max).any(axis=1))
        names, distance = [names[i] for i in close], distance[np.ix_(close, close)]
        place = {v: i for i, v in enumerate(names)}
        if again:
            pairs = [(place[r["node"]], place[r["other"]], r["linked"]) for r in rows if r["sketch"] is None]
            found = _across(
                distance, [p[:2] for p in pairs if p[2]], [p[:2] for p in pairs if not p[2]]
            )
        else:
            found = _forest(distance)
        return [(min(names[i], names[j]), max(names[i], names[j])) for i, j in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        name, rows, out = None, [], []

        def flushed(last: bool):
            if len(out) and (last or len(out) > 20_000):
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                batch = pa.record_batch(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["key", "i", "j", "a", "b"]
                )
                out.clear()
                yield batch

        for batch in slices(batches, 2000):
            for row in batch.to_pylist():
                own = row["key"], row["i"], row["j"]
                if own != name:
                    if rows:
                        out += [(*name, a, b) for a, b in candidates(rows)]
                        yield from flushed(False)
                    name, rows = own, []
                rows.append(row)
        if rows:
            out += [(*name, a, b) for a, b in candidates(rows)]
        yield from flushed(True)

    return run


def _compared(members: DataFrame, near: Similarity, again: bool) -> DataFrame:
    dealt = members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(_bucket_rows(near, again), "key long, i int, j int, a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, near: Similarity) -> DataFrame:
    """Add ``linked`` to distinct pairs ``(a, b)``: whether their sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        memo = WordIds()
        for batch in slices(batches, 500):
            left, right = byte_texts(batch, "text_a"), byte_texts(batch, "text_b")
            linked, seen, keys = [], None, None
            for x, y in zip(left, right):
                if x != seen:
                    seen, keys = x, shingles(x, near.words, memo)
                other = shingles(y, near.words, memo)
                both = len(np.intersect1d(keys, other, assume_unique=True))
                linked.append(both * near.whole >= (len(keys) + len(other) - both) * near.part)
            yield pa.record_batch(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"]
            )

    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return (
        pairs.select("a", "b").distinct().join(first, "a").join(second, "b")
        .mapInArrow(run, "a long, b long, linked boolean")
    )


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``: the least node reachable.

    Large-star and small-star steps in turn, until the edges stay the same. The table that the
    result is read from goes with ``scratch``.
    """
    current, path = kept(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a != b")
        .distinct(),
        "edges",
    )
    sign = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.m").alias("b"))
            .filter("a != b")
            .distinct()
        )
        following, next_path = kept(small, "edges")
        fresh = following.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        dropped(current, path)
        current, path = following, next_path
        if fresh == sign:
            break
        sign = fresh
    if scratch:
        scratch.paths.append(path)
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def linked_nodes(
    docs: DataFrame, near: Similarity, scratch: Scratch, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc_id, text_hash, n, node)`` of all documents, and links ``(a, b)`` of nodes.

    The links connect all nodes that are connected by similarity. Both are read from tables of
    ``scratch``.
    """
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text_hash long, n long, node long, sketch binary, buckets array<long>"
    whole, whole_path = kept(texts.mapInArrow(_set_rows(near), schema), "sets")
    scratch.paths.append(whole_path)
    sets = scratch.keep(whole.drop("sketch", "buckets"), "set-names")
    fresh = whole.filter("sketch is not null")
    nodes = scratch.keep(fresh.drop("buckets").dropDuplicates(["node"]), "nodes")
    # A set met by several tasks has its rows several times.
    met = fresh.select(F.explode("buckets").alias("key"), "node").selectExpr(
        "*", "min(node) over (partition by key) as low", "max(node) over (partition by key) as high"
    )
    members = scratch.keep(met.filter("low < high").select("key", "node").distinct(), "members")
    dropped(docs, whole_path)
    # Counted with partial counts and written first, so that the join can split a hot bucket.
    sizes = scratch.keep(members.groupBy("key").agg(F.count("*").alias("size")), "bucket-sizes")
    shared = scratch.keep(members.join(sizes, "key"), "buckets")

    two = shared.filter("size = 2").groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    # Every block meets every block, itself included when it is the only one.
    meets = F.transform(
        F.sequence(F.lit(0), F.greatest(blocks - 1, F.lit(0))),
        lambda k: F.struct(F.least(k, own).alias("i"), F.greatest(k, own).alias("j")),
    )
    meets = F.filter(meets, lambda m: (blocks == 1) | (m["i"] != m["j"]))
    many = scratch.keep(
        shared.filter("size > 2")
        .select("key", "node", F.inline(meets))
        .join(nodes.select("node", "n", "sketch"), "node"),
        "compared",
    )
    forest = scratch.keep(_compared(many, near, again=False), "forest")
    found = two.select("a", "b").unionByName(forest.select("a", "b")).distinct()
    active = found.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = nodes.select("node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    wanted = wanted.join(active, "node", "left_semi")
    same = texts["doc_id"].eqNullSafe(wanted["_id"]) & (texts["text_hash"] == wanted["_hash"])
    active_texts = scratch.keep(
        texts.join(wanted, same).select("node", "text").dropDuplicates(["node"]), "active-texts"
    )
    first = scratch.keep(_verified(found, active_texts, near), "verified")

    bucket = ["key", "i", "j"]
    tried = forest.join(first, ["a", "b"])
    open_buckets = tried.filter("not linked").select(*bucket).distinct()
    members = many.join(open_buckets, bucket, "left_semi").select(
        *bucket, "node", "n", "sketch", F.lit(None).cast("long").alias("other"), F.lit(None).cast("boolean").alias("linked")
    )
    known = tried.join(open_buckets, bucket, "left_semi").select(
        *bucket, F.col("a").alias("node"), F.lit(None).cast("long").alias("n"),
        F.lit(None).cast("binary").alias("sketch"), F.col("b").alias("other"), "linked",
    )
    # Written first: a union of two inputs that are dealt by bucket already is not dealt anew,
    # although their parts need not meet in one task.
    opened = scratch.keep(members.unionByName(known), "opened")
    more = _compared(opened, near, again=True).select("a", "b").distinct()
    more = more.join(first, ["a", "b"], "left_anti")
    second = scratch.keep(_verified(more, active_texts, near), "verified-again")
    links = first.unionByName(second).filter("linked").select("a", "b")
    return sets.select("doc_id", "text_hash", "n", "node"), links


def _placed(docs: DataFrame, near: Similarity, block: int, scratch: Scratch) -> DataFrame:
    """``(doc_id, text_hash, n, node, root)``; the root is the component's name."""
    rows, links = linked_nodes(docs, near, scratch, block)
    found = rows.join(components(links, scratch), "node", "left").withColumn("root", F.coalesce("root", "node"))
    return scratch.keep(found, "placed")


def similar_components(docs: DataFrame, near: Similarity | None = None, block: int = BLOCK) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, component_id)``: the smallest id of the component.

    Read from the one table that stays in the shared folder.
    """
    with Scratch(docs.sparkSession) as scratch:
        placed = _placed(docs, near or Similarity(), block, scratch)
        # An empty set is linked with nothing, not even with another.
        linked, alone = placed.filter("n > 0"), placed.filter("n = 0")
        least = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        columns = ["doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id"]
        found = (
            linked.join(least, "root")
            .select(*columns)
            .unionByName(alone.withColumn("component_id", F.col("doc_id")).select(*columns))
        )
        return kept(found, "components")[0]


def one_of_each(docs: DataFrame, near: Similarity | None = None, block: int = BLOCK) -> DataFrame:
    """The document of the smallest id of each component; all columns stay.

    Of repeated rows one stays. Documents with empty sets stay.
    """
    with Scratch(docs.sparkSession) as scratch:
        placed = _placed(docs, near or Similarity(), block, scratch)
        equal = placed.filter("n > 0").groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("rows"))
        order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "rows")
        first = equal.groupBy("root").agg(F.min(order).alias("first")).select("first.*")
        empty = placed.filter("n = 0").groupBy("doc_id", "text_hash").agg(F.lit(1).cast("long").alias("rows"))
        chosen, _ = kept(first.drop("no_id").unionByName(empty), "chosen")
    chosen = chosen.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash", "rows": "_rows"})
    same = docs["doc_id"].eqNullSafe(chosen["_id"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == chosen["_hash"]
    )
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    found = docs.join(chosen, same).select(row, "_id", "_hash", "_rows")
    several = found.filter("_rows > 1").dropDuplicates(["_id", "_hash"])
    return found.filter("_rows = 1").unionByName(several).select("_row.*")
