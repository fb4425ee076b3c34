import hashlib

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import ranks


@pytest.fixture(params=["1", "7"])
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


def permutation(n, epoch, seed=42):
    key = lambda i: (hashlib.md5(f"{seed}:{epoch}:{i}".encode()).hexdigest(), i)
    return {i: k for k, i in enumerate(sorted(range(n), key=key))}


@pytest.mark.parametrize("n", [1, 500])
def test_epoch_order(partitions, n):
    rows = partitions.range(n).withColumnRenamed("id", "row_id")
    first = {r.row_id: r["rank"] for r in ranks.epoch_order(rows).collect()}
    second = {r.row_id: r["rank"] for r in ranks.epoch_order(rows, epoch=1, partitions=3).collect()}
    assert first == permutation(n, 0) and second == permutation(n, 1)
    assert n == 1 or first != second


@pytest.mark.parametrize("n, size, accumulation, max_steps", [
    (1, 4, 1, None), (10, 3, 2, None), (100, 7, 4, None), (100, 7, 4, 6), (12, 4, 3, None), (5, 50, 2, 9),
])
def test_epoch_batches(partitions, n, size, accumulation, max_steps):
    rows = partitions.range(n).withColumnRenamed("id", "row_id")
    got = {
        r.row_id: (r.batch_id, r.update_id, r.applied)
        for r in ranks.epoch_batches(rows, size, accumulation, max_steps).collect()
    }
    batches = -(-n // size)
    steps = min(batches, max_steps) if max_steps else batches
    want = {}
    for row, rank in permutation(n, 0).items():
        batch = rank // size
        if batch < steps:
            update = batch // accumulation
            want[row] = (batch, update, (update + 1) * accumulation <= steps)
    assert got == want


def test_rank_by_sparse_id(partitions):
    ids = [3, 10**12, 5, 2**21, 7, -4, 2**20, 2**20 - 1]
    df = partitions.createDataFrame([(i,) for i in ids], "id long")
    got = {r.id: r["rank"] for r in ranks.rank_by_id(df, "id").collect()}
    assert got == {i: k for k, i in enumerate(sorted(ids))}


def test_text_batches_and_limits(partitions):
    valid = partitions.range(1, 26).select((F.col("id") * 3).alias("line_no"))
    sizes = ranks.text_batches(valid, 10).groupBy("batch_id").count().collect()
    assert sorted(map(tuple, sizes)) == [(0, 10), (1, 10), (2, 5)]
    assert ranks.take_lines(valid, 30).count() == 10
    assert ranks.take_lines(valid).count() == 25
    assert ranks.take_lines(valid, test_mode=True).count() == 25


def test_lookup(partitions):
    rows = partitions.range(10).withColumnRenamed("id", "row_id")
    wanted = partitions.createDataFrame([(3,), (3,), (11,)], "row_id long")
    assert [r.row_id for r in ranks.lookup_rows(rows, wanted).collect()] == [3]


def test_rank_buckets_follow_the_rows(spark):
    """Dense and sparse ids are spread over several buckets, and nothing is lost."""
    for step in (1, 10**15):
        df = spark.range(1000).select((F.col("id") * step - 7).alias("id"))
        rows = ranks.rank_by_id(df, "id", bucket_rows=100).collect()
        assert sorted((r["rank"], r.id) for r in rows) == [(k, k * step - 7) for k in range(1000)]
    empty = spark.range(0)
    assert ranks.rank_by_id(empty, "id").count() == 0


def test_epoch_plan_moves_rows_once(spark):
    rows = spark.range(1000).select(F.col("id").alias("row_id"), F.lit("text").alias("text"))
    plan = ranks.epoch_batches(rows, 10)._jdf.queryExecution().executedPlan().toString()
    carrying = [line for line in plan.splitlines() if "Exchange" in line and "rangepartitioning" in line]
    assert len(carrying) == 1


@pytest.mark.parametrize("digits", [1, 2, 3, 5])
def test_epoch_rank_does_not_depend_on_the_depth(spark, digits):
    rows = spark.range(700).withColumnRenamed("id", "row_id")
    got = {r.row_id: (r["rank"], r.total) for r in ranks.epoch_order(rows, bucket_digits=digits).collect()}
    assert got == {i: (k, 700) for i, k in permutation(700, 0).items()}


def test_epoch_depth_follows_the_rows():
    assert [ranks.epoch_digits(n) for n in (0, 50_000, 800_000, 800_001, 10**9, 10**11, 10**13)] == [1, 1, 1, 2, 4, 5, 5]


def test_epoch_depth_reaches_the_batches(spark):
    rows = spark.range(50).withColumnRenamed("id", "row_id")
    found = [sorted(map(tuple, ranks.epoch_batches(rows, 7, bucket_digits=d).collect())) for d in (1, 4)]
    assert found[0] == found[1]


def test_id_ranges_stay_even_with_an_outlier(spark):
    """Dense ids and one far away, ids in two clusters, repeated and null ids."""
    dense = spark.range(20_000).unionByName(spark.createDataFrame([(2**62,)], "id long"))
    clusters = spark.range(5_000).unionByName(spark.range(10**15, 10**15 + 15_000))
    for df in (dense, clusters):
        sizes = [r.n for r in ranks.id_parts(df, "id", 1000).groupBy("_part").agg(F.sum("_n").alias("n")).collect()]
        assert len(sizes) > 15 and max(sizes) < 2500
        rows = sorted((r["rank"], r.id) for r in ranks.rank_by_id(df, "id", bucket_rows=1000).collect())
        assert rows == list(enumerate(sorted(r.id for r in df.collect())))
    repeated = spark.createDataFrame([(5,), (3,), (5,), (None,), (9,), (5,)], "id long")
    rows = sorted((r["rank"], r.id) for r in ranks.rank_by_id(repeated, "id", bucket_rows=1).collect())
    assert rows == [(0, 3), (1, 5), (2, 5), (3, 5), (4, 9)]
