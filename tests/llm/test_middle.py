"""Fill-in-the-middle order against a plain version, and its way back."""

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import middle
from tests.llm import brute
from tests.llm.conftest import tuples

COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def expected(pairs):
    rows = []
    for i, t in pairs:
        n, form, a, b, output = brute.fill_in_middle(i, t)
        rows.append((i, n, form, a, b, brute.sha(output), brute.sha(t or "")))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("units", [2048, 7, 1])
def test_outputs_equal_plain_version(docs, pairs, units):
    odd = [(500 + i, t) for i, t in enumerate(["<P>", "a<S>b", "<M", "<<P", "P><S", "😀<", "<", "x" * 10, "<P" * 9])]
    if units == 1:
        pairs = [p for p in pairs if len(p[1] or "") < 5000]
        docs = docs.filter("text is null or length(text) < 5000")
    more = docs.sparkSession.createDataFrame(odd, "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(more)
    found = middle.fill_in_middle(every, middle.Rearrangement(units=units))
    assert tuples(found, *COLUMNS) == expected(pairs + odd)


def test_all_forms_with_their_outputs(spark):
    rows = [(i, f"text é {i} <" * (i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = middle.fill_in_middle(df, middle.Rearrangement(units=5), with_output=True)
    assert {r.doc_id: r.output for r in found.collect()} == {i: brute.fill_in_middle(i, t)[4] for i, t in rows}
    forms = {r.form for r in found.collect()}
    assert forms == {"plain", "psm", "spm"}


def test_repeated_rows_and_clashing_columns(docs, empty, pairs):
    many = docs.unionByName(docs).unionByName(docs).coalesce(2)
    more = many.withColumns({c: F.lit(1) for c in ("text_hash", "task", "place", "piece", "n", "form")})
    assert tuples(middle.fill_in_middle(more), *COLUMNS) == expected(pairs * 3)
    assert middle.fill_in_middle(empty).count() == 0


def test_one_exchange(spark):
    docs = spark.range(9).selectExpr("id as doc_id", "cast(id as string) as text")
    plan = middle.fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_string_ids(spark):
    rows = [("a", "some text here"), (None, "no id"), ("", "empty id")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert tuples(middle.fill_in_middle(df), *COLUMNS) == expected(rows)


def test_a_sentinel_is_found_across_pieces():
    for size in (1, 2, 3, 5, 50):
        output = "<S>end <P<<P>begin <M<M>mid <P> <S>".encode()
        reader, parts = middle.Reader("spm"), {0: b"", 1: b"", 2: b""}
        for i in range(0, len(output), size):
            for rank, part in reader.read(output[i : i + size]):
                parts[rank] += part
        for rank, part in reader.rest():
            parts[rank] += part
        assert parts == {2: b"end <P<", 0: b"begin <M", 1: b"mid <P> <S>"}
