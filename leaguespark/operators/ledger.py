"""Ledgers of runs: logs that only grow, and the state of each run folded from them.

An entry says that something happened to a run: it was opened, it took a step, gave a
sign of life, counted pages or rows, met an error, ended.  Entries are appended as
files and never changed; what a run is now is an aggregate over its entries, so
writers need no locks and a lost writer leaves a run that is open and silent, which
``reap`` then closes.  Entries are dealt out and sorted once, by run and ``PART``
consecutive ones; what is sent twice goes there, and each part of a run is one row
from then on, so a run with very many entries is several tasks' work.

Defined cases: entries without a run are left out; a run without an opening entry
has no job and no start; of several ends the first counts (the earliest, then the
lowest ``seq``); entries sent twice with one ``seq`` count once.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

ENTRY = "run_id string, seq long, at timestamp, kind string, job string, saison string, n long, text string"
#: Kinds of entries that end a run.
ENDS = ("success", "failed", "partial", "skipped")
#: Kinds that are no sign of life.
SILENT = ("stats", "rows")
#: Bits of ``seq`` within a part.
PART = 20


def fold(entries: DataFrame) -> DataFrame:
    """One row a run: run_id, job, saison, started_at, last_activity_at, finished_at, status, steps_total, step_index, current_step, errors, pages_total, pages, rows_read, stats, error_message."""
    kind = F.col("kind")
    # Only openings tell the job; the other entries travel without it. One sort serves both groupings.
    told = {c: F.when(kind == "open", F.col(c)) for c in ("job", "saison")}
    rows = entries.filter("run_id IS NOT NULL").withColumns({**told, "part": F.shiftright("seq", PART)})
    rows = rows.repartition("run_id", "part").dropDuplicates(["run_id", "part", "seq"])
    when = F.struct("at", "seq")
    last = lambda k, value: F.max_by(F.when(kind == k, F.col(value)), F.when(kind == k, when))
    end = F.min_by(F.when(kind.isin(*ENDS), F.struct("kind", "at", "text")), F.when(kind.isin(*ENDS), when))
    total = lambda k: F.coalesce(F.sum(F.when(kind == k, F.col("n"))), F.lit(0))
    opened = F.min_by(F.when(kind == "open", F.struct("job", "saison", "at", "n")), F.when(kind == "open", when))
    found = rows.groupBy("run_id").agg(
        opened.alias("o"), end.alias("e"), F.max(F.when(~kind.isin(*SILENT), F.col("at"))).alias("last_activity_at"), last("step", "n").alias("step_index"), last("step", "text").alias("step"),
        F.count_if(kind == "error").alias("errors"), last("total", "n").alias("pages_total"), total("pages").alias("pages"), last("rows", "n").alias("rows_read"), last("stats", "text").alias("stats"),
    )
    return found.select(
        "run_id", "o.job", "o.saison", F.col("o.at").alias("started_at"), "last_activity_at", F.col("e.at").alias("finished_at"), F.coalesce("e.kind", F.lit("running")).alias("status"),
        F.coalesce("o.n", F.lit(0)).alias("steps_total"), F.coalesce("step_index", F.lit(0)).alias("step_index"), F.when(F.col("e").isNull(), F.col("step")).alias("current_step"), "errors",
        "pages_total", "pages", F.coalesce("rows_read", F.lit(0)).alias("rows_read"), "stats", F.col("e.text").alias("error_message"),
    )


def reap(runs: DataFrame, now: Column, idle_hours: int, by: str = "last_activity_at") -> DataFrame:
    """Entries that end the runs which are open and have been silent (or, by ``started_at``, open) for too long."""
    silent = (F.col("status") == "running") & (F.coalesce(F.col(by), F.col("started_at")) < now - F.expr(f"INTERVAL {idle_hours} HOURS"))
    text = F.lit(f"orphelin : aucune activité depuis plus de {idle_hours} h")
    return runs.filter(silent).select("run_id", F.lit((1 << 62)).alias("seq"), now.alias("at"), F.lit("failed").alias("kind"), "job", "saison", F.lit(None).cast("long").alias("n"), text.alias("text"))


def resume_points(runs: DataFrame) -> DataFrame:
    """(job, saison, since): when the last successful run of each job began, from where an incremental load goes on."""
    return runs.filter("status = 'success'").groupBy("job", "saison").agg(F.max("started_at").alias("since"))


class Run:
    """A run that is being written: each call appends an entry."""

    def __init__(self, log: RunLog, job: str, saison: str | None, clock: Callable[[], datetime]) -> None:
        self.log, self.job, self.saison, self.clock = log, job, saison, clock
        self.id, self.seq, self.held, self.wrote = uuid.uuid4().hex, 0, [], 0.0

    def note(self, kind: str, n: int | None = None, text: str | None = None, now: bool = True) -> None:
        self.held.append((self.id, self.seq, self.clock(), kind, self.job, self.saison, n, text))
        self.seq += 1
        if now:
            self.flush()

    def flush(self) -> None:
        held, self.held = self.held, []
        if held:
            self.log.append(held)
        self.wrote = time.monotonic()

    def step(self, index: int, text: str) -> None:
        self.note("step", index, text)

    def error(self) -> None:
        self.note("error")

    def total(self, n: int) -> None:
        self.note("total", n)

    def pages(self, n: int = 1) -> None:
        self.note("pages", n)

    def stats(self, values: dict) -> None:
        self.note("stats", text=json.dumps(values, sort_keys=True))

    def rows(self, n: int, every: float = 3.0) -> None:
        """Rows read so far; written at most once in ``every`` seconds."""
        self.note("rows", n, now=False)
        if time.monotonic() - self.wrote >= every:
            self.flush()

    def observed(self, df: DataFrame, **metrics: Column) -> DataFrame:
        """The same rows, which are counted while whatever reads them runs; ``measure`` then writes the counts down."""
        self.observation = Observation(f"run-{self.id}-{self.seq}")
        return df.observe(self.observation, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in metrics.items()])

    def measure(self) -> dict:
        """The counts of the observed rows, once an action has read them."""
        found = self.observation.get
        self.note("rows", found["rows"], now=False)
        self.stats({k: v for k, v in found.items()})
        return found


class RunLog:
    """A folder of entries."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def append(self, entries: list[tuple] | DataFrame) -> None:
        rows = entries if isinstance(entries, DataFrame) else self._rows(entries)
        rows.write.mode("append").parquet(self.path)

    def _rows(self, entries: list[tuple]) -> DataFrame:
        """A few entries as literals, which costs no Python worker."""
        kinds = dict(part.split(" ") for part in ENTRY.split(", "))
        row = lambda entry: F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(entry, kinds.items(), strict=True)])
        return self.spark.range(0, 1, 1, 1).select(F.inline(F.array(*map(row, entries))))

    def entries(self) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(self.path)

    def runs(self) -> DataFrame:
        return fold(self.entries())

    @contextmanager
    def run(self, job: str, saison: str | None = None, steps: int = 0, clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc)):
        """Opens a run and ends it: success, failed on an error, partial when it is interrupted (what it has written so far stays)."""
        run = Run(self, job, saison, clock)
        run.note("open", steps)
        try:
            yield run
        except Exception as e:
            run.note("failed", text=str(e)[:500])
            raise
        except BaseException as e:  # a signal
            run.note("partial", text=f"interrompu ({type(e).__name__})")
            raise
        run.note("success")


def wait_for(done: Callable[[], bool], seconds: float = 30.0) -> bool:
    """Waits until something is so; listeners hear of the end of a query a little later than it comes."""
    until = time.monotonic() + seconds
    while not done() and time.monotonic() < until:
        time.sleep(0.05)
    return done()


class ProgressToLog(StreamingQueryListener):
    """Writes the progress of one query into its run: rows read so far, rows too late, rows of state, observed metrics."""

    def __init__(self, run: Run, query_name: str) -> None:
        self.run, self.name, self.rows, self.late, self.ids, self.ended = run, query_name, 0, 0, set(), False

    def onQueryStarted(self, event) -> None:  # noqa: N802
        if event.name == self.name:
            self.ids.add(event.id)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if p.name != self.name:
            return
        self.rows += p.numInputRows
        self.late += sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        self.run.note("rows", self.rows, now=False)
        metrics = {name: row.asDict() for name, row in p.observedMetrics.items()}
        self.run.note("stats", text=json.dumps({"batch": p.batchId, "late": self.late, "state": sum(o.numRowsTotal for o in p.stateOperators), **metrics}, sort_keys=True, default=str), now=False)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended = self.ended or event.id in self.ids
