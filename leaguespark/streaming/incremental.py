"""Incremental loads as streams that end when the input is read: file source, checkpoint, available-now trigger."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leaguespark.operators import matches
from leaguespark.sources.versions import VersionedTable


def work_dir(spark: SparkSession) -> str:
    """A new folder below the shared one, for checkpoints and outputs of one stream; one of its own only where none is set and all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="leaguespark-")
        spark.sparkContext.setCheckpointDir(found)
    return f"{found.rstrip('/')}/streams/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A file stream with the schema of what lies there: a folder, or a single file, which a stream takes as its folder and the file's name."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return reader.parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", re.sub(r"([\[\]{}*?\\])", r"\\\1", name)).parquet(folder)


def run(stream: DataFrame, folder: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """All that is there, in micro batches, from where the last run with this folder ended; gives the ended query."""
    query = stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _kept(each: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For what reads a batch several times: the batch is taken from the stream once, and so is what its state counts."""

    def call(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            each(batch, number)
        finally:
            batch.unpersist()

    return call


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after their time was up, as far as the query's recent progress tells."""
    return sum(int(o["numRowsDroppedByWatermark"]) for p in query.recentProgress for o in p["stateOperators"])


def state_rows(query: StreamingQuery) -> int:
    """Rows that the query's state held at its end."""
    return sum(int(o["numRowsTotal"]) for p in query.recentProgress[-1:] for o in p["stateOperators"])


def latest(stream: DataFrame, keys: list[str], order: list[str], columns: list[str], folder: str) -> DataFrame:
    """The newest row of each key over all batches and runs, whatever arrives late or twice.

    The stream keeps no state: the newest rows of a batch are merged into the versioned table of the folder, which
    rewrites the buckets of the batch's keys.  Where the last run ended is the stream's checkpoint, so a run reads
    new files only; a batch that is repeated after a failure is committed once.
    """
    spark, held = stream.sparkSession, list(dict.fromkeys([*columns, *order]))
    table = VersionedTable(spark, f"{folder}/table", keys)
    if not table.exists():
        table.replace(spark.createDataFrame([], stream.select(*keys, *held).schema))

    def newest(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*held), F.struct(*order)).alias("__r")).select(*keys, "__r.*")

    run(stream, folder, _kept(lambda batch, number: table.update(newest(batch), lambda old, new: newest(old.unionByName(new)), f"batch-{number}")))
    table.drop_old()
    return table.read().select(*keys, *columns)


def ingest_counted(stream: DataFrame, keys: list[str], folder: str, time: str | None = None, late: str = "60 days") -> tuple[DataFrame, int]:
    """Rows whose keys are new, once, and how many rows of this run came too late.

    With a time, the state forgets keys that are older than the newest time by more than ``late``, and rows older than
    that are left out: the state is bounded by what arrives within that time.  Without one it holds every key.
    """
    once = stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys) if time else stream.dropDuplicates(keys)
    query = run(once, folder, lambda batch, number: batch.write.mode("overwrite").parquet(f"{folder}/out/__batch={number}"))
    return stream.sparkSession.read.parquet(f"{folder}/out").drop("__batch"), late_rows(query)


def ingest(stream: DataFrame, keys: list[str], folder: str, time: str | None = None, late: str = "60 days") -> DataFrame:
    """Rows whose keys are new, once, also when a batch or a file is sent again; with a time, keys are forgotten once they are too late."""
    return ingest_counted(stream, keys, folder, time, late)[0]


def fill_scores_counted(sheets: DataFrame, table: DataFrame, folder: str, time: str | None = None, late: str = "60 days") -> tuple[DataFrame, int]:
    """A table of (id, score_dom, score_ext) with absent scores filled from a stream of sheets (id, s_dom, s_ext), and the number of sheets that came too late.

    The first sheet fills, none overwrites.  The filled table is a versioned one: a later run with the same folder goes
    on from its newest version, takes in matches that are new in ``table``, and scores that came by another way.
    With a time, a sheet is too late if it is older than the newest one by more than ``late``.
    """
    spark = table.sparkSession
    rows = table.select("id", "score_dom", "score_ext")
    filled = VersionedTable(spark, f"{folder}/table", ["id"])
    absent = F.col("score_dom").isNull() | F.col("score_ext").isNull()
    if filled.exists():
        both = F.col("n.score_dom").isNotNull() & F.col("n.score_ext").isNotNull()

        def renew(old: DataFrame, new: DataFrame) -> DataFrame:
            joined = old.alias("o").join(new.alias("n"), F.col("o.id") == F.col("n.id"), "full_outer")
            keep = F.col("o.id").isNotNull() & ~F.coalesce(both, F.lit(False))
            return joined.select(F.coalesce("o.id", "n.id").alias("id"), *[F.when(keep, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in ("score_dom", "score_ext")])

        filled.update(rows, renew)
    else:
        filled.replace(rows)

    def fill(old: DataFrame, first: DataFrame) -> DataFrame:
        use = absent & F.col("s.s_dom").isNotNull() & F.col("s.s_ext").isNotNull()
        return old.join(first, "id", "left").select("id", *[F.when(use, F.col(f"s.s_{side}")).otherwise(F.col(f"score_{side}")).alias(f"score_{side}") for side in ("dom", "ext")])

    def each(batch: DataFrame, number: int) -> None:
        whole = batch.filter("s_dom IS NOT NULL AND s_ext IS NOT NULL")
        filled.update(whole.groupBy("id").agg(F.min(F.struct("s_dom", "s_ext")).alias("s")), fill, f"batch-{number}")

    stream = sheets.withWatermark(time, late).dropDuplicatesWithinWatermark(["id", "s_dom", "s_ext"]) if time else sheets
    query = run(stream, folder, _kept(each))
    filled.drop_old()
    return filled.read(), late_rows(query)


def fill_scores(sheets: DataFrame, table: DataFrame, folder: str) -> DataFrame:
    return fill_scores_counted(sheets, table, folder)[0]


def attempt(deliveries: DataFrame, answers: DataFrame, now: Column, disable_after: int = matches.MAX_FAILURES) -> tuple[DataFrame, DataFrame]:
    """One round of the delivery queue: (deliveries, subscriptions) after the answers came in.

    deliveries: id, subscription_id, status, attempts, next_attempt_at, failures (of the subscription); answers: id, http.
    A 2xx answer delivers and resets the subscription's failures; anything else climbs the ladder of waits and at
    last fails.  A subscription with too many failures in a row is switched off.
    """
    due = (F.col("status") == "pending") & (F.col("next_attempt_at") <= now)
    joined = deliveries.join(answers, "id", "left").withColumn("__due", due & F.col("http").isNotNull())
    ok = F.col("http").between(200, 299)
    step = matches.next_delivery(F.col("status"), F.col("attempts"), ok)
    after = joined.withColumn("__s", F.when(F.col("__due"), step))
    rows = after.select(
        "id", "subscription_id", F.coalesce("__s.status", "status").alias("status"), (F.col("attempts") + F.col("__due").cast("int")).alias("attempts"),
        F.when(F.col("__s.wait").isNotNull(), F.timestamp_add("SECOND", F.col("__s.wait"), now)).otherwise(F.col("next_attempt_at")).alias("next_attempt_at"),
    )
    failed = F.count_if(F.col("__due") & ~ok)
    by = after.groupBy("subscription_id").agg(F.max("failures").alias("before"), failed.alias("failed"), F.count_if(F.col("__due") & ok).alias("delivered"))
    failures = F.when(F.col("delivered") > 0, F.lit(0)).otherwise(F.col("before") + F.col("failed"))
    return rows, by.select("subscription_id", failures.cast("long").alias("failures"), (failures < disable_after).alias("active"))
