import random

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import samples
from corpusmill.functions.sql import register_sql
from tests.helpers import column


def spans(ids, header, end):
    """Positions from after each header through the next end, headers taken left to right."""
    mask, i, h = [0] * len(ids), 0, len(header)
    while i + h <= len(ids):
        if ids[i : i + h] != header:
            i += 1
            continue
        i += h
        if end in ids[i:]:
            last = ids.index(end, i)
            mask[i : last + 1] = [1] * (last + 1 - i)
    return mask


@pytest.mark.parametrize("header", [[3, 7, 9], [3], [3, 3], [4, 3]])
def test_assistant_mask(spark, header):
    rng = random.Random(4)
    rows = [[rng.choice([3, 3, 4, 7, 9, 1]) for _ in range(rng.randrange(0, 30))] for _ in range(800)]
    rows += [[], header, header + [4], [4, *header], header * 2 + [4]]
    want = [spans(r, header, 4) for r in rows]
    got = column(spark, rows, lambda c: samples.assistant_mask(c, header, 4), "array<int>")
    assert got == want
    register_sql(spark)
    listed = ",".join(map(str, header))
    df = spark.createDataFrame(list(enumerate(rows)), "i int, v array<int>")
    by_sql = df.select("i", F.expr(f"assistant_mask(v, array({listed}), 4)").alias("o")).collect()
    assert [r.o for r in sorted(by_sql)] == want


def test_padding_masks_and_shift(spark):
    rows = [[], [5], [5, 0, 6, 4], [5, 0, 6, 4, 8], [5, 0, 6, 4, 8, 9]]
    padded = [(r + [0] * 5)[:5] for r in rows]
    assert column(spark, rows, lambda c: samples.truncate_pad(c, 5, 0), "array<int>") == padded
    lengths = [[int(k < len(r)) for k in range(5)] for r in rows]
    assert column(spark, rows, lambda c: samples.length_mask(c, 5), "array<int>") == lengths
    values = [[int(x != 0) for x in p] for p in padded]
    assert column(spark, padded, lambda c: samples.pad_value_mask(c, 0), "array<int>") == values
    shifted = column(spark, padded, lambda c: samples.shift_xy(c, c), "array<int>")
    assert [(s.x, s.y, s["mask"]) for s in shifted] == [(p[:-1], p[1:], p[1:]) for p in padded]


def test_sql_chunks_and_chat(spark):
    register_sql(spark)
    row = spark.sql(
        "SELECT chunk_text('abcd    efgh', 4) AS c,"
        " render_chat(array(named_struct('role','user','content','q'))) AS r"
    ).first()
    assert row.c == ["abcd", "efgh"] and row.r == "<|im_start|>user\nq<|im_end|>\n"
