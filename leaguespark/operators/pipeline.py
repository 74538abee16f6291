"""A pipeline of loads: steps that need others, run in order, written down in a ledger, and resumed where they stopped.

The tables are versioned.  A step of a campaign commits its table under the campaign's
token and is written down as done afterwards: a run that is lost between the two finds
the commit already made and changes nothing.  Warnings and rejects of a step are written
anew whenever it runs, so they are there once.  A step takes its captures once, and so
it does what it makes of them, however often its report and its commit read them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguespark.operators import entities
from leaguespark.operators.ledger import RunLog
from leaguespark.operators.loads import newest
from leaguespark.sources.versions import BUCKETS, VersionedTable, empty


@dataclass(frozen=True)
class Step:
    name: str
    needs: tuple[str, ...]
    load: Callable[[DataFrame, entities.Read], entities.Prepared]


#: The seven loads of the structure; a step's name is its table's.
STEPS = (
    Step("salles", (), entities.halls), Step("clubs", ("salles",), entities.clubs), Step("competitions", (), entities.competitions), Step("phases", ("competitions",), entities.phases),
    Step("poules", ("phases",), entities.poules), Step("equipes", ("clubs",), entities.teams), Step("engagements", ("equipes", "poules"), entities.engagements),
)


def ordered(steps: tuple[Step, ...], start: str | None = None, only: list[str] | None = None) -> list[Step]:
    """Each step after those it needs, else as they are listed; from one on, or some only."""
    by_name = {s.name: s for s in steps}
    asked = {*([start] if start else []), *(only or []), *(n for s in steps for n in s.needs)}
    if unknown := asked - set(by_name):
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    done: dict[str, Step] = {}

    def visit(step: Step, above: tuple[str, ...]) -> None:
        if step.name in above:
            raise ValueError(f"steps need each other: {' -> '.join([*above, step.name])}")
        for name in step.needs:
            visit(by_name[name], (*above, step.name))
        done.setdefault(step.name, step)

    for step in steps:
        visit(step, ())
    found = list(done.values())
    if start:
        found = found[[s.name for s in found].index(start) :]
    return [s for s in found if not only or s.name in only]


class Pipeline:
    """``captures`` gives a step's captures by name, ``given`` the tables that no step loads."""

    def __init__(self, spark: SparkSession, path: str, captures: Callable[[str], DataFrame], given: dict[str, DataFrame], steps: tuple[Step, ...] = STEPS, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.captures, self.given, self.steps, self.buckets = spark, path.rstrip("/"), captures, given, steps, buckets
        self.log = RunLog(spark, f"{self.path}/log")

    def table(self, name: str, keys: list[str] | None = None) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.path}/tables/{name}", keys or ["id_ffhb"], self.buckets)

    def read(self, name: str) -> DataFrame:
        """A table as it is; one that isn't loaded yet is empty."""
        if name in self.given:
            return self.given[name]
        table = self.table(name)
        return table.read() if table.exists() else self.spark.createDataFrame([], "id_ffhb string")

    def messages(self, kind: str) -> DataFrame:
        """``warnings`` or ``rejects`` of all steps that have run, with the step and the campaign."""
        return self.spark.read.option("basePath", f"{self.path}/{kind}").parquet(f"{self.path}/{kind}/*/*")

    def done(self, campaign: str) -> set[str]:
        """Steps that the ledger has as done in a campaign."""
        if not VersionedTable(self.spark, self.path, ["id_ffhb"])._names("log"):
            return set()
        runs = self.log.runs().filter((F.col("saison") == campaign) & (F.col("status") == "success"))
        return {r.job for r in runs.select("job").distinct().collect()}  # one row a step

    def run(self, campaign: str, start: str | None = None, only: list[str] | None = None, keep_going: bool = False) -> dict[str, str]:
        """Runs what isn't done in this campaign; gives what became of each step: done, skipped, failed or blocked by one that failed."""
        done, what = self.done(campaign), {}
        for step in ordered(self.steps, start, only):
            if step.name in done:
                what[step.name] = "skipped"
            elif any(what.get(n) in ("failed", "blocked") for n in step.needs):
                what[step.name] = "blocked"
            else:
                try:
                    self._step(step, campaign)
                    what[step.name] = "done"
                except Exception:
                    if not keep_going:
                        raise
                    what[step.name] = "failed"
        return what

    def _step(self, step: Step, campaign: str) -> None:
        held = []

        def keep(rows: DataFrame) -> DataFrame:
            held.append(rows.persist())
            return rows

        try:
            with self.log.run(step.name, campaign) as run:
                found = step.load(keep(newest(self.captures(step.name))), self.read)
                found = replace(found, new=keep(found.new), warnings=keep(found.warnings), rejects=keep(found.rejects))
                table = self.table(step.name, found.keys)
                if not table.exists():
                    table.replace(empty(self.spark, found.new.select(*found.columns).schema))
                # What the step changes is counted against the version before it, also when its commit was made already.
                own = table.committed(f"{campaign}-{step.name}")
                before = table.read() if own is None else table.read(own - 1)
                run.stats({r.outcome: r.n for r in found.report(before).collect()})  # at most five rows
                if found.overwrite or found.coalesce:
                    table.merge(found.new, token=f"{campaign}-{step.name}", overwrite=found.overwrite, coalesce=found.coalesce)
                else:
                    table.append(found.new, token=f"{campaign}-{step.name}")
                if found.after:
                    table.merge(found.after(table.read()), token=f"{campaign}-{step.name}-after", overwrite=found.after_overwrite)
                for kind, rows in (("warnings", found.warnings), ("rejects", found.rejects)):
                    rows.write.mode("overwrite").parquet(f"{self.path}/{kind}/campaign={campaign}/step={step.name}")
        finally:
            for rows in held:
                rows.unpersist()

    def report(self, campaign: str) -> DataFrame:
        """(step, outcome, n) of the campaign's steps that are done, by the ledger."""
        runs = self.log.runs().filter((F.col("saison") == campaign) & (F.col("status") == "success"))
        counts = runs.select(F.col("job").alias("step"), F.explode(F.from_json("stats", "map<string,bigint>")).alias("outcome", "n"))
        return counts.select("step", "outcome", "n")


