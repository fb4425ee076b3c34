"""Fill-in-the-middle order by secondary sort.

A text is cut at two places drawn from the hash of its id, and its parts change places behind
sentinels. No text is put together in a column: each part is cut into pieces of ``units`` code
points, and each piece is keyed by its document and its place in the output. Rows are dealt by
document and sorted by place inside the partitions, and a task streams the pieces of a document
into an incremental digest. For the way back the same stream is read as output: the sentinels
are looked for in it, across pieces, and what lies between them is keyed by document and place
in the text. It stays in its partition, is sorted again and streamed into a second digest, which
is that of the text if nothing was lost.

The key has the partition that a document was read in, so that a row repeated very often is dealt
to many tasks; repeated rows of one partition are streamed as one and counted.

Defined cases: a null or empty text is plain; a null id counts as empty text; a text that holds a
sentinel is plain; a text of any length is streamed in pieces; repeated rows give a row each;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import slices, whole_text

# The sentinels, and the parts that follow them in each form.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
# The order of the parts in the text.
RANKS = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
LAST = 3


@dataclass(frozen=True)
class Rearrangement:
    """Of 100 texts ``share`` are rearranged, and ``spm`` of 100 of those start with the suffix."""

    seed: int = 1
    share: int = 90
    spm: int = 20
    units: int = 2048

    def cuts(self, doc_id, text: str) -> tuple[str, int, int]:
        """The form, and the ends of prefix and middle."""
        own = "" if doc_id is None else doc_id
        digest = hashlib.sha256(f"{self.seed}:{own}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
        if not text or any(s in text for s in RANKS) or h3 % 100 >= self.share:
            return "plain", 0, 0
        a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
        return ("spm" if h4 % 100 < self.spm else "psm"), a, b

    def pieces(self, text: str, form: str, a: int, b: int) -> Iterator[bytes]:
        """The output in pieces; each part starts with its sentinel."""
        if form == "plain":
            parts = [("", 0, len(text))]
        else:
            ends = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, len(text))}
            parts = [(s, *ends[s]) for s in ORDERS[form]]
        for sentinel, start, stop in parts:
            for at in range(start, max(stop, start + 1), self.units):
                piece = text[at : min(at + self.units, stop)]
                yield (sentinel + piece if at == start else piece).encode()


class Reader:
    """Reads an output piece by piece; gives what belongs to each part of the text."""

    def __init__(self, form: str):
        self.awaited = [s.encode() for s in ORDERS.get(form, ())]
        self.rank, self.held = 0, b""

    def read(self, piece: bytes) -> Iterator[tuple[int, bytes]]:
        """``(rank of the part, bytes)``; a beginning of the awaited sentinel is held back."""
        self.held += piece
        while self.awaited:
            sentinel = self.awaited[0]
            at = self.held.find(sentinel)
            if at < 0:
                sure = max(0, len(self.held) - len(sentinel) + 1)
                yield self.rank, self.held[:sure]
                self.held = self.held[sure:]
                return
            yield self.rank, self.held[:at]
            self.held = self.held[at + len(sentinel) :]
            self.rank = RANKS[sentinel.decode()]
            self.awaited.pop(0)
        yield self.rank, self.held
        self.held = b""

    def rest(self) -> Iterator[tuple[int, bytes]]:
        yield self.rank, self.held


KEY = ["doc_id", "text_hash", "task"]
ABOUT = ["n", "form", "prefix_chars", "middle_chars"]
_KINDS = {
    "text_hash": pa.int64(),
    "task": pa.int32(),
    "place": pa.int32(),
    "rank": pa.int32(),
    "n": pa.int64(),
    "form": pa.string(),
    "prefix_chars": pa.int64(),
    "middle_chars": pa.int64(),
    "copies": pa.int64(),
    "piece": pa.binary(),
    "output_sha256": pa.string(),
    "restored_sha256": pa.string(),
    "output": pa.string(),
}
_SQL = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}


def _schema(id_type: str, names: list[str]) -> str:
    return ", ".join(f"{c} {id_type if c == 'doc_id' else _SQL[_KINDS[c]]}" for c in names)


class _Rows:
    """Rows on their way out, in batches of bounded size."""

    def __init__(self, names: list[str]):
        self.names, self.rows, self.size = names, [], 0

    def add(self, row: tuple, size: int = 0) -> None:
        self.rows.append(row)
        self.size += 100 + size

    def out(self, id_type: pa.DataType, all_of_it: bool) -> Iterator[pa.RecordBatch]:
        if self.rows and (all_of_it or self.size > 4_000_000):
            kinds = [_KINDS.get(c, id_type) for c in self.names]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*self.rows), kinds)], self.names)
            self.rows, self.size = [], 0


CUT = [*KEY, "place", *ABOUT, "piece"]


def _cut(rule: Rearrangement):
    """Texts into pieces of the output; what is known of a text goes with its first piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(CUT)
        for batch in slices(batches, 500):
            id_type = batch.schema.field("doc_id").type
            for row in batch.to_pylist():
                key = tuple(row[c] for c in KEY)
                text = row["text"]
                form, a, b = rule.cuts(row["doc_id"], text)
                split = (None, None) if form == "plain" else (a, b - a)
                about = (len(text), form, *split)
                for place, piece in enumerate(rule.pieces(text, form, a, b)):
                    rows.add((*key, place, *about, piece), len(piece))
                    about = (None,) * 4
                yield from rows.out(id_type, False)
            yield from rows.out(id_type, True)

    return run


READ = [*KEY, "rank", "place", *ABOUT, "copies", "piece", "output_sha256", "output"]


def _put_together(with_output: bool):
    """Pieces of outputs, sorted, into digests; and into pieces of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(READ)
        name = last = digest = reader = about = None
        copies, place, output = 0, 0, []

        def add(parts: Iterator[tuple[int, bytes]]) -> None:
            nonlocal place
            for rank, part in parts:
                if part:
                    rows.add((*name, rank, place, *(None,) * 5, part, None, None), len(part))
                    place += 1

        def close() -> None:
            add(reader.rest())
            text = b"".join(output).decode() if with_output else None
            rows.add((*name, LAST, 0, *about, copies, None, digest.hexdigest(), text), len(text or ""))

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for row in batch.to_pylist():
                own = tuple(row[c] for c in KEY)
                if own != name:
                    if name:
                        close()
                    name, last, copies, place, output = own, None, 0, 0, []
                    about = [row[c] for c in ABOUT]
                    digest, reader = hashlib.sha256(), Reader(row["form"])
                copies += row["place"] == 0
                if row["place"] != last:
                    last = row["place"]
                    digest.update(row["piece"])
                    add(reader.read(row["piece"]))
                    if with_output:
                        output.append(row["piece"])
                yield from rows.out(id_type, False)
        if name:
            close()
            yield from rows.out(id_type, True)

    return run


DONE = ["doc_id", *ABOUT, "output_sha256", "restored_sha256", "output"]


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of texts, sorted, into digests; the last row of a text has all else."""
    rows = _Rows(DONE)
    digest = hashlib.sha256()
    for batch in batches:
        id_type = batch.schema.field("doc_id").type
        for row in batch.to_pylist():
            if row["rank"] < LAST:
                digest.update(row["piece"])
                continue
            done = (row["doc_id"], *(row[c] for c in ABOUT), row["output_sha256"], digest.hexdigest(), row["output"])
            for _ in range(row["copies"]):
                rows.add(done, len(row["output"] or ""))
                yield from rows.out(id_type, False)
            digest = hashlib.sha256()
        yield from rows.out(id_type, True)


def output_pieces(docs: DataFrame, rule: Rearrangement | None = None) -> DataFrame:
    """``(doc_id, text_hash, task, place, n, form, prefix_chars, middle_chars, piece)``.

    Dealt by document, and sorted by document and place in each partition. What is known of a
    text is in the row of its first piece.
    """
    texts = docs.select("doc_id", whole_text().alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.spark_partition_id().alias("task"), "text"
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    cut = texts.mapInArrow(_cut(rule or Rearrangement()), _schema(id_type, CUT))
    return cut.repartition(*KEY).sortWithinPartitions(*KEY, "place")


def fill_in_middle(docs: DataFrame, rule: Rearrangement | None = None, with_output: bool = False) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)``.

    ``with_output`` adds the rearranged text as ``output``.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    read = output_pieces(docs, rule).mapInArrow(_put_together(with_output), _schema(id_type, READ))
    again = read.sortWithinPartitions(*KEY, "rank", "place")
    done = again.mapInArrow(_restored, _schema(id_type, DONE))
    return done if with_output else done.drop("output")
