"""Operators with state by key: windows that start at a key's first request, and pauses that grow with blocks in a row."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


class FixedWindow:
    """A window of so many seconds from a key's first request; the next request after its end starts the next one."""

    def __init__(self, seconds: float, start: float | None = None, count: int = 0) -> None:
        self.seconds, self.start, self.count = seconds, start, count

    def take(self, at: float) -> tuple[float, int]:
        """(start, place in the window) of a request; requests come in order of time."""
        if self.start is None or at > self.start + self.seconds:
            self.start, self.count = at, 0
        self.count += 1
        return self.start, self.count


def rate_limit(requests: DataFrame, key: str, time: str, limit: int, seconds: float) -> DataFrame:
    """The columns, and window_start, place and limited, in one pass over each key's requests in order.

    A task streams through its keys and holds one window, so a key with a third of the rows takes time,
    not memory; a null key is a key.
    """
    rows = requests.withColumn("__at", F.unix_micros(F.col(time).cast("timestamp"))).withColumn("__key", F.coalesce(F.col(key).cast("string"), F.lit("\0")))
    ordered = rows.repartition("__key").sortWithinPartitions("__key", "__at", *[c for c in requests.columns if c not in (key, time)][:1])

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, window = None, FixedWindow(seconds * 1e6)
        for batch in batches:
            starts, places = [], []
            for own, at in zip(batch["__key"], batch["__at"], strict=True):
                if own != current:
                    current, window = own, FixedWindow(seconds * 1e6)
                start, place = window.take(at)
                starts.append(int(start))
                places.append(place)
            yield batch.drop(columns=["__key", "__at"]).assign(window_start=starts, place=places)

    schema = requests.limit(0).withColumns({"window_start": F.lit(None).cast("long"), "place": F.lit(None).cast("long")}).schema
    found = ordered.mapInPandas(apply, schema)
    return found.withColumn("window_start", F.timestamp_micros("window_start")).withColumn("limited", F.col("place") > limit)


def rate_limit_stream(requests: DataFrame, key: str, time: str, limit: int, seconds: float) -> DataFrame:
    """The same on a stream: (key, at, place, limited); the state of a key is the start and the count of its window.

    Within a micro batch requests are put in order; those of an earlier time in a later batch count in the window of their arrival.
    """

    def apply(own: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        window = FixedWindow(seconds, *(state.get if state.exists else (None, 0)))
        times = sorted(t for batch in batches for t in batch["__at"])
        places = [window.take(t)[1] for t in times]
        state.update((window.start, window.count))
        yield pd.DataFrame({"key": [own[0]] * len(times), "at": times, "place": places, "limited": [p > limit for p in places]})

    rows = requests.select(F.coalesce(F.col(key).cast("string"), F.lit("\0")).alias("__key"), (F.unix_micros(F.col(time).cast("timestamp")) / 1e6).alias("__at"))
    return rows.groupBy("__key").applyInPandasWithState(apply, "key string, at double, place long, limited boolean", "start double, count long", "append", GroupStateTimeout.NoTimeout)


def cooldowns(requests: DataFrame, domain: str, time: str, blocked: Column, base_seconds: int, most_seconds: int) -> DataFrame:
    """The columns, and blocks (blocked requests in a row up to this one) and pause_until (null unless blocked): the pause grows with each block in a row, up to a bound."""
    by = Window.partitionBy(domain).orderBy(time)
    rows = requests.withColumn("__b", blocked)
    rows = rows.withColumn("__run", F.sum(F.when(F.col("__b"), 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.withColumn("blocks", F.sum(F.col("__b").cast("long")).over(Window.partitionBy(domain, "__run").orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    pause = F.least(F.col("blocks") * base_seconds, F.lit(most_seconds)).cast("int")
    return rows.withColumn("pause_until", F.when(F.col("__b"), F.timestamp_add("SECOND", pause, F.col(time)))).drop("__b", "__run")
