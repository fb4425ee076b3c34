"""The registered queries on the smallest tables, value by value against plain versions."""

import os
from itertools import groupby

import pytest

from corpusmill.llm import queries, secrets
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    return [(r.doc_id, r.text) for r in docs.collect()]


def result(spark, name, *columns):
    found = queries.all_queries()[name](spark, SF_DIR)
    return sorted(tuple(r) for r in found.select(*columns).collect())


def test_op1(spark, rows):
    found = result(spark, "op1_jaccard_join", "doc_id", "n_shingles", "component_id")
    assert found == sorted(brute.jaccard_components(rows))


def test_op2(spark, rows):
    found = result(spark, "op2_repeated_strings", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == sorted(brute.without_repeats(rows))


def test_op3(spark, rows):
    found = result(spark, "op3_quality_classifier", "doc_id", "held_out", "score", "predicted")
    assert [f[0] for f in found] == sorted(i for i, _ in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    right = []
    for doc_id, held_out, score, predicted in found:
        assert held_out == (brute.remainder(doc_id, 4) == 2)
        assert 0 <= score <= 1 and predicted == int(score >= 0.7)
        if held_out and doc_id in labels:
            right.append(predicted == labels[doc_id])
    assert len(right) > 10 and sum(right) >= 0.9 * len(right)


def url_parts(url):
    rest = (url or "").partition("://")
    if not rest[1]:
        return "", ""
    cut = min((rest[2].find(c) for c in "/?#" if c in rest[2]), default=len(rest[2]))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[2][:cut])
    path = rest[2][cut:]
    return host, path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]


def test_op4(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    found = result(spark, "op4_url_filters", "page_id", "host", "path", "rule", "verdict")
    assert [f[0] for f in found] == sorted(pages)
    for page_id, *own, rule, verdict in found:
        host, path = url_parts(pages[page_id])
        fits = [
            (len(name + start), name + start, judged)
            for name, start, judged in queries.URL_RULES
            if (host == name or host.endswith("." + name)) and path.startswith(start)
        ]
        _, expected, judged = max(fits, default=(0, None, verdict))
        assert (*own, rule, verdict) == (host, path, expected, judged) and verdict in ("allow", "block")


def test_op5(spark, rows):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    expected = brute.base_scores(rows)
    for doc_id, *base, base_score, score in result(spark, "op5_lm_scoring", *names):
        assert tuple(base) == expected[doc_id][:4]
        assert base_score == pytest.approx(expected[doc_id][4], rel=1e-9) and score < 0


def test_op6(spark, rows):
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    allowed = secrets.EntropyRule().allowed
    expected = []
    for doc_id, text in rows:
        spans = ",".join(f"{secrets.KINDS[k]}:{a}:{z}" for a, k, z in brute.secret_spans(text, allowed))
        expected.append((doc_id, *brute.secret_base(text)[:4], spans))
    assert result(spark, "op6_secret_scans", *names) == sorted(expected)


def test_op7(spark, rows):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    found = result(spark, "op7_quality_rules", *names)
    assert [f[:7] for f in found] == sorted((i, *brute.quality_rules(t)) for i, t in rows)
    assert not any(failed and kept for *_, failed, kept in found) and any(kept for *_, kept in found)


def test_op8(spark, rows):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    expected = sorted((*r, r[2] > 0) for r in brute.decontaminated(rows, items))
    assert result(spark, "op8_decontaminate", *names) == expected


def test_op9(spark, rows):
    ordered = sorted(rows)
    expected, start = [], 0
    for (doc_id, _), ids in zip(ordered, brute.all_ids([t for _, t in ordered])):
        expected.append((doc_id, start, len(ids), brute.crc_ids(ids)))
        start += len(ids)
    assert result(spark, "op9_token_id_files", "doc_id", "start", "n_tokens", "ids_crc32") == expected


def test_op10(spark, rows):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    found = result(spark, "op10_best_fit_packing", *names)
    ids = dict(zip((i for i, _ in rows), brute.all_ids([t for _, t in rows])))
    for doc_id, pieces in groupby(found, key=lambda r: r[0]):
        whole, at = ids[doc_id], 0
        pieces = list(pieces)
        for k, (_, piece, start, length, crc, *_) in enumerate(pieces):
            assert (piece, start) == (k, at) and crc == brute.crc_ids(whole[start : start + length])
            assert length == 2048 or k == 0
            at += length
        assert at == len(whole) and len(pieces) == -(-len(whole) // 2048)
    for _, placed in groupby(sorted((s, o, n) for *_, n, _, s, o in found), key=lambda r: r[0]):
        at = 0
        for _, offset, length in placed:
            assert offset == at
            at += length
        assert at <= 2048
    sequences = len({r[5] for r in found})
    assert sequences <= -(-sum(map(len, ids.values())) // 2048) + 2


def test_op11(spark, rows):
    found = result(spark, "op11_repeated_windows", "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == sorted(brute.without_repeated_windows(rows))


def test_op12(spark, rows):
    found = queries.all_queries()["op12_spelling_variants"](spark, SF_DIR)
    found = {tuple(r) for r in found.select("word", "n", "n_near", "form", "form_n", "root").collect()}
    assert found == set(brute.spelling_variants(rows)) and len(found) > 1000


def test_op13(spark, rows):
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    found = result(spark, "op13_fill_in_middle", *names)
    expected = []
    for doc_id, text in rows:
        *about, output = brute.fill_in_middle(doc_id, text)
        expected.append((doc_id, *about, brute.sha(output), brute.sha(text or "")))
    assert [f[:3] for f in found] == sorted(e[:3] for e in expected)
    assert set(found) == set(expected)
