"""One generic merge for all upserts: overwrite, keep-if-null, insert-only, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge(
    old: DataFrame, new: DataFrame, keys: list[str], overwrite: list[str] = (), coalesce: list[str] = (), insert_only: list[str] = (),
    watched: list[str] | None = None, increments: dict[str, int] | None = None,
) -> DataFrame:
    """Old rows, changed rows and new rows, with a column ``outcome``.

    ``overwrite`` columns take the new value, ``coalesce`` columns keep the old one
    where the new is null, ``insert_only`` columns are set once, ``increments`` add
    to the old value.  ``outcome`` is inserted, updated (a ``watched`` column, by
    default any written one, changed), noop or kept (not in the new rows).  Keys
    are unique in both tables.
    """
    increments = increments or {}
    columns = [*overwrite, *coalesce, *insert_only, *increments]
    watched = [*overwrite, *coalesce, *increments] if watched is None else watched
    left = old.select(*keys, F.struct(*columns).alias("o"))
    right = new.select(*keys, F.struct(*[c for c in columns if c not in increments] or [F.lit(None).alias("none")]).alias("n"))
    joined = left.join(right, keys, "full_outer")
    was, comes = F.col("o").isNotNull(), F.col("n").isNotNull()

    def value(c: str) -> Column:
        before = F.col(f"o.{c}")
        if c in increments:
            return F.when(comes, F.coalesce(before, F.lit(0)) + increments[c]).otherwise(before)
        after = F.col(f"n.{c}")
        if c in insert_only:
            return F.when(was, before).otherwise(after)
        return F.when(~comes, before).otherwise(F.coalesce(after, before) if c in coalesce else after)

    merged = joined.withColumns({f"__{c}": value(c) for c in columns})
    changed = F.lit(False)
    for c in watched:
        changed = changed | ~F.col(f"__{c}").eqNullSafe(F.col(f"o.{c}"))
    outcome = F.when(~was, "inserted").when(~comes, "kept").when(changed, "updated").otherwise("noop")
    return merged.select(*keys, *[F.col(f"__{c}").alias(c) for c in columns], outcome.alias("outcome"))


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"))


def outcomes(merged: DataFrame) -> DataFrame:
    return merged.filter("outcome <> 'kept'").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def delete_cascade(children: dict[str, tuple[DataFrame, str]], gone: DataFrame, key: str) -> dict[str, DataFrame]:
    """Children without the rows of deleted parents."""
    return {name: child.join(gone.select(F.col(key).alias(fk)), fk, "left_anti") for name, (child, fk) in children.items()}


def split_valid(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): a row is rejected for every rule that is not true, with the reasons."""
    reasons = F.filter(F.array(*[F.when(F.coalesce(ok, F.lit(False)), F.lit(None).cast("string")).otherwise(name) for name, ok in rules.items()]), lambda r: r.isNotNull())
    judged = rows.withColumn("reasons", reasons)
    return judged.filter(F.size("reasons") == 0).drop("reasons"), judged.filter(F.size("reasons") > 0)


def most_frequent(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value of each key, the smallest among equals; counted before it is shuffled by key."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("less"), F.col(value).alias("value"))).alias("best"))
    return best.select(*keys, F.col("best.value").alias(value), (-F.col("best.less")).alias("n"))
