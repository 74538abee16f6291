"""Shared folder tables, batch limits and small column helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes handed to Python at once; texts can be long, so both stay small.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20
#: The ASCII white space that parts words: space and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of its own only where none is set and all runs on one machine, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="leaguespark-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def stash(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    It cuts the lineage, so that a lost executor costs no recomputation of what
    came before.  All tables of one application share a folder, to be removed
    once the application has ended.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/leaguespark/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: memory follows the batch, not the partition."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def named(column: str) -> Column:
    """A column by its name as it stands, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """All columns as one struct ``row``, and more columns beside it: names inside the struct clash with none outside; ``row.*`` gives them back."""
    return docs.select(F.struct(*map(named, docs.columns)).alias("row"), *[c.alias(name) for name, c in more.items()])


def release(shared: Broadcast) -> None:
    """Drop the value from memory; it is read again from the broadcast's local file when asked for."""
    vars(shared).pop("_value", None)


def gathered(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups of at least so many bytes."""
    group: list[pa.RecordBatch] = []
    for batch in batches:
        group.append(batch)
        if sum(b.nbytes for b in group) >= least:
            yield group
            group = []
    if group:
        yield group


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, null counting as empty.

    Each word and the space before it become one character, which costs no array.
    """
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.length(F.regexp_replace(trimmed, rf"[{SPACE}]*[^{SPACE}]+", "x")).cast("long")


def unit_hash(*cols: Column | str) -> Column:
    """A number in [0, 1) that only depends on the values."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus
