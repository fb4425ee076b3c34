"""The stages of the pipeline."""

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from corpusmill.llm import queries
from tests.llm import brute
from tests.llm.conftest import ITEMS, prose


@pytest.fixture
def sf_dir(spark, docs, benchmark, tmp_path):
    good = [(1000 + i, prose(3000 + i, 80)) for i in range(40)]
    bad = [(2000 + i, prose(4000 + i, 80).upper().replace(" ", "!! ")) for i in range(20)]
    more = spark.createDataFrame(good + bad, "doc_id long, text string")
    docs.unionByName(more, allowMissingColumns=True).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(0, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_each_stage_does_its_work(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = corpus_pipeline.quality_classifier(spark, documents, sf_dir).cache()
    ids = {r.doc_id for r in left.collect()}
    assert left.columns == documents.columns
    assert not ids & set(range(2000, 2020)) and set(range(1000, 1040)) <= ids

    single = corpus_pipeline.jaccard_join(spark, left, sf_dir).cache()
    rows = [(r.doc_id, r.text) for r in left.collect()]
    groups = brute.jaccard_components([r for r in rows if r[0] is not None], 5, 4, 5)
    assert sorted(r.doc_id for r in single.collect() if r.doc_id is not None) == sorted({c for *_, c in groups})
    assert single.columns == documents.columns

    clean = corpus_pipeline.benchmark_decontamination(spark, single, sf_dir).cache()
    hit = {i for i, _, n, *_ in brute.decontaminated([(r.doc_id, r.text) for r in single.collect()], ITEMS) if n}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - hit

    masked = corpus_pipeline.secret_scans(spark, clean, sf_dir).cache()
    before = {r.doc_id: r.text for r in clean.collect()}
    assert masked.columns == documents.columns
    for r in masked.collect():
        assert not brute.secret_base(r.text)[4]
        if not brute.secret_base(before[r.doc_id])[4] and "Zx9K" not in (before[r.doc_id] or ""):
            assert r.text == before[r.doc_id]

    packed = corpus_pipeline.best_fit_packing(spark, masked, sf_dir)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in masked.collect()}


def test_run_equals_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    columns = ["doc_id", "piece", "start", "length", "ids"]
    expected = sorted(map(repr, docs.select(*columns).collect()))
    found = corpus_pipeline.run(spark, sf_dir).select(*columns).collect()
    assert sorted(map(repr, found)) == expected and expected


def test_stages_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_all_queries_are_registered():
    assert {*queries.all_queries(), "pipeline"} <= registered.queries().keys()
    assert queries.all_sql().keys() <= registered.oracle_sql().keys()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in queries.all_queries())] == []
