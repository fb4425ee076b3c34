"""Small plan helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, out: str, expr: Column) -> DataFrame:
    """Add a costly column that later filters and columns read without computing it again.

    A filter on a plain projected column is pushed below the projection and repeats its
    expression there; a one-element explode is not crossed.
    """
    return df.select("*", F.explode_outer(F.array(expr)).alias(out))


def spread(df: DataFrame) -> DataFrame:
    """Spread a source with fewer splits than cores over all cores; leave others as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
