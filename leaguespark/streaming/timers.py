"""Keyed state with timers: runs whose signs of life stop, and pauses of domains that block."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Kinds of entries that end a run.
ENDS = ("success", "failed", "partial", "skipped")
#: Groups of runs that share a state; a stream keeps the number it began with.
SLOTS = 512
LOST = "run_id string, last_activity_at timestamp, lost_at timestamp"


def lost_runs(entries: DataFrame, idle_seconds: int, by_clock: bool = False, silent: tuple[str, ...] = ()) -> DataFrame:
    """(run_id, last_activity_at, lost_at): open runs that gave no sign of life for so long, from a stream of (run_id, at, kind).

    Each run has one timer, set anew by every entry and dropped by the one that ends it.  Timers go by the entries' own
    time (a run is lost once the newest entry of all is that much later), or by the clock, for logs that may fall silent
    altogether.  Entries of ``silent`` kinds only move the time on; entries without a time are left out.

    The open runs of one of ``SLOTS`` slots are one state, a map by run, so that Python is called once a slot and not
    once a run; the slot's own timer is the earliest of its runs'.
    """
    idle = idle_seconds * 1000

    def apply(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs() if by_clock else state.getCurrentWatermarkMs()
        runs = json.loads(state.get[0]) if state.exists else {}  # run: last entry in microseconds, time of the timer
        last, ended = {}, set()
        for batch in () if state.hasTimedOut else batches:
            for run, micros in zip(batch["run_id"], batch["micros"], strict=True):
                if micros > last.get(run, -1 << 63):
                    last[run] = micros
            ended.update(batch["run_id"][batch["kind"].isin(ENDS)])
        lost = [(run, at) for run, (at, timer) in runs.items() if run not in last and (timer <= now if by_clock else timer < now)]
        for run, _ in lost:
            del runs[run]
        for run, micros in last.items():
            if run in ended:
                runs.pop(run, None)
            else:
                at = int(max(micros, runs.get(run, (micros,))[0]))
                runs[run] = (at, now + idle if by_clock else max(at // 1000 + idle, now + 1))
        if runs:
            state.update((json.dumps(runs),))
            first = min(timer for _, timer in runs.values())
            if by_clock:
                state.setTimeoutDuration(max(first - now, 1))
            else:
                state.setTimeoutTimestamp(max(first, now + 1))
        elif state.exists:
            state.remove()
        if lost:
            yield pd.DataFrame({"run_id": [run for run, _ in lost], **{c: pd.to_datetime([at + more for _, at in lost], unit="us") for c, more in (("last_activity_at", 0), ("lost_at", idle * 1000))}})

    timeout = GroupStateTimeout.ProcessingTimeTimeout if by_clock else GroupStateTimeout.EventTimeTimeout
    rows = entries.filter("run_id IS NOT NULL").withColumn("at", F.col("at").cast("timestamp"))
    # A condition on the time itself stays above the watermark, so silent entries still move it.
    rows = (rows if by_clock else rows.withWatermark("at", "0 seconds")).filter(F.when(F.coalesce(F.col("kind").isin(*silent), F.lit(False)), None).otherwise(F.col("at")).isNotNull())
    rows = rows.select(F.pmod(F.xxhash64("run_id"), F.lit(SLOTS)).cast("int").alias("slot"), "run_id", "at", "kind", F.unix_micros("at").alias("micros"))
    return rows.groupBy("slot").applyInPandasWithState(apply, LOST, "open string", "append", timeout)


def pauses(requests: DataFrame, base_seconds: int, most_seconds: int) -> DataFrame:
    """(domain, id, blocks, pause_until) of requests (domain, id, at, blocked), as a stream: pauses grow with each block in a row, up to a bound.

    The state of a domain is its number of blocks in a row.  Within a micro batch requests go by time, then id; a
    request that is not blocked sets the number back and has no pause.
    """

    def apply(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        blocks = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values(["micros", "id"])
        counts, until = [], []
        for micros, blocked in zip(rows["micros"], rows["blocked"], strict=True):
            blocks = blocks + 1 if blocked else 0
            counts.append(blocks)
            until.append(int(micros) + min(blocks * base_seconds, most_seconds) * 1_000_000 if blocked else None)
        state.update((blocks,))
        yield pd.DataFrame({"domain": [key[0]] * len(rows), "id": rows["id"].tolist(), "blocks": counts, "until": pd.array(until, dtype="Int64")})

    rows = requests.select(F.coalesce("domain", F.lit("")).alias("domain"), "id", F.unix_micros(F.col("at").cast("timestamp")).alias("micros"), F.coalesce("blocked", F.lit(False)).alias("blocked"))
    found = rows.groupBy("domain").applyInPandasWithState(apply, "domain string, id long, blocks long, until long", "blocks long", "append", GroupStateTimeout.NoTimeout)
    return found.withColumn("pause_until", F.timestamp_micros("until")).drop("until")
