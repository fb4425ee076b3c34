"""Small helpers shared by the tests."""

from pyspark.sql import functions as F


def column(spark, values, expr, kind="string"):
    """Values of an expression over one column, in input order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    rows = df.select("i", expr(F.col("v")).alias("o")).collect()
    return [r.o for r in sorted(rows, key=lambda r: r.i)]
