"""Token ids, id files and packing: the library's own ids and exact round trips."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import id_files, packing, token_ids
from tests.llm import brute

_encoder = token_ids.Encoder()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab E1é.!'s\n\t ſ#\u00a0數", max_size=25), max_size=6))
def test_pieces_give_the_ids_of_the_whole_text(texts):
    assert [i.tolist() for i in _encoder.encode(texts)] == brute.all_ids(texts)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(0, 300), st.randoms())
def test_pack_round_trip(width, n, rng):
    ids = np.array([rng.getrandbits(width) for _ in range(n)], np.uint32)
    assert id_files.unpack(id_files.pack(ids, width), n, width).tolist() == ids.tolist()


@pytest.mark.parametrize("file_ids", [id_files.FILE_IDS, 500])
def test_files_hold_all_ids_in_order(spark, docs, tmp_path, file_ids):
    manifest = id_files.write_ids(docs, str(tmp_path / "ids"), file_ids=file_ids)
    rows = id_files.read_ids(manifest).collect()
    own = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    expected = brute.all_ids([r.text for r in own])
    found = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in found] == [r.doc_id for r in own]
    assert [r.start for r in found] == np.cumsum([0, *map(len, expected)])[:-1].tolist()
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in found] == expected
    file = id_files.IdFile(manifest.orderBy("part", "number").first().file)
    assert file.width == 16
    for k in (0, len(file.doc_ids) - 1):
        assert file.document(k).tolist() == expected[k]
    flat = [i for e in expected for i in e]
    assert file.ids(5, min(4100, file.n_ids)).tolist() == flat[5 : min(4100, file.n_ids)]
    file.close()


def test_files_of_an_empty_table(empty):
    manifest = id_files.write_ids(empty)
    assert manifest.count() == 0 and id_files.read_ids(manifest).count() == 0


@pytest.mark.parametrize("group_bytes", [packing.GROUP_BYTES, 30_000])
def test_packing_places_every_id_once(docs, group_bytes):
    rows = packing.pack_documents(docs, size=256, group_bytes=group_bytes).collect()
    sequences = {}
    for r in rows:
        assert 0 < r.length <= 256 and len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()]
        assert sum(n for _, n in own) <= 256
    by_id = {}
    for r in sorted(rows, key=lambda r: (r.start, r.piece)):
        by_id.setdefault(r.doc_id, []).append(r)
    for row in docs.dropDuplicates(["doc_id"]).collect():
        ids = brute.all_ids([row.text])[0]
        copies = docs.filter(docs.doc_id.eqNullSafe(row.doc_id)).count()
        own = by_id[row.doc_id][::copies]
        assert [r.piece for r in own] == list(range(-(-len(ids) // 256)))
        assert all(r.length == 256 for r in own[1:])
        assert [i for r in own for i in np.frombuffer(r.ids, "<u4").tolist()] == ids
    if group_bytes == packing.GROUP_BYTES:
        total = sum(r.length for r in rows)
        assert len(sequences) <= -(-total // 256) + 1


def test_packing_of_an_empty_table(empty):
    assert packing.pack_documents(empty).count() == 0


def test_sum_of_squares_choice():
    """Where two gaps fit, the one whose use leaves the smaller sum of squares is taken."""
    bins, offsets = packing.sum_of_squares(np.array([7, 7, 6, 3]), 10)
    assert bins.tolist() == [0, 1, 2, 0] or bins.tolist() == [0, 1, 2, 1]
    assert offsets.tolist() == [0, 0, 0, 7]
    fills = np.random.default_rng(2).integers(1, 600, 4000)
    bins, _ = packing.sum_of_squares(fills, 2048)
    assert bins.max() + 1 <= -(-fills.sum() // 2048) + 1
