"""Append-only captures: latest version by key, retention, deduplicating append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def latest_by_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under a total order; one shuffle by key, and Spark keeps one row a key before it."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__nth", F.row_number().over(by)).filter("__nth = 1").drop("__nth")


def scan_filters(rows: DataFrame, since=None, ids: list[str] | None = None, id_column: str = "natural_key", time_column: str = "scraped_at") -> DataFrame:
    """Filters of a capture scan; what is not given costs nothing and reaches the files as pushed filters."""
    if since is not None:
        rows = rows.filter(F.col(time_column) >= F.lit(since))
    if ids is not None:
        rows = rows.filter(F.col(id_column).isin(*ids))
    return rows


def retention(rows: DataFrame, keys: list[str], order: list[Column], keep: int | None = None, older_than: Column | None = None) -> DataFrame:
    """Rows with a flag ``expired``: beyond the newest ``keep`` of a key, or old, but never the newest one."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    expired = nth > keep if keep is not None else (nth > 1) & older_than
    return rows.withColumn("expired", expired)


def payload_hash(*columns: str) -> Column:
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def append_new(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a batch whose keys are new, each once."""
    return batch.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")


def append_rows(existing: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows of a batch with ``outcome``: inserted for the first row of a key that is not there yet, else duplicate; null keys are equal.

    Whether a key is the first of the batch is found by an aggregate, so a key with very many rows is one row a task.
    """
    first = batch.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min(F.struct(*order)).alias("__first"))
    there = existing.select(*[F.col(k).alias(f"__e_{k}") for k in keys]).distinct().withColumn("__there", F.lit(True))
    same = lambda left, right: [F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}")) for k in keys]
    news = first.join(there, same("__", "__e_"), "left").select(*[f"__{k}" for k in keys], F.when(F.col("__there").isNull(), F.col("__first")).alias("__first"))
    placed = batch.join(news, same("", "__"))
    return placed.withColumn("outcome", F.when(F.struct(*order).eqNullSafe(F.col("__first")), "inserted").otherwise("duplicate")).select(*batch.columns, "outcome")


def append_outcome(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """(inserted, duplicates) of such an append."""
    total = batch.agg(F.count(F.lit(1)).alias("n"))
    new = append_new(existing, batch, keys).agg(F.count(F.lit(1)).alias("inserted"))
    # One row each: joined on a constant.
    return new.withColumn("one", F.lit(1)).join(total.withColumn("one", F.lit(1)), "one").select("inserted", (F.col("n") - F.col("inserted")).alias("duplicates"))
