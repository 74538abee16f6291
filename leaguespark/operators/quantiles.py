"""Exact order statistics by group without a group's values in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Width of the interval around the wanted share that is looked at exactly, and the sketch's accuracy.
MARGIN = 0.01
ACCURACY = 10_000


def percentile_disc(rows: DataFrame, key: str, value: str, share: float) -> DataFrame:
    """(key, value): the first value whose share of the group's known values, in order, is at least ``share``.

    A sketch of bounded size bounds the place from both sides; values below are only counted, and of those
    between, each different one is one row, numbered within its group.
    """
    known = rows.filter(F.col(value).isNotNull()).select(key, value)
    sketch = F.percentile_approx(value, [max(0.0, share - MARGIN), min(1.0, share + MARGIN)], ACCURACY)
    bounds = known.groupBy(key).agg(sketch.alias("__b"), F.count(F.lit(1)).alias("__n")).select(F.col(key).alias("__k"), F.col("__b")[0].alias("__lo"), F.col("__b")[1].alias("__hi"), "__n")
    placed = known.join(bounds, F.col(key).eqNullSafe(F.col("__k")))
    # Below the interval is one row a group, at its lower bound.
    at = F.when(F.col(value) < F.col("__lo"), F.lit(None)).otherwise(F.col(value))
    counts = placed.filter(F.col(value) <= F.col("__hi")).groupBy(key, "__n", at.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    upto = F.sum("__c").over(Window.partitionBy(key).orderBy(F.col("__v").asc_nulls_first()))
    reached = counts.withColumn("__s", upto).filter(F.col("__v").isNotNull() & (F.col("__s") >= F.ceil(F.col("__n") * share)))
    return reached.groupBy(key).agg(F.min("__v").alias(value))
