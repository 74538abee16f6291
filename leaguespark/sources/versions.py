"""Versioned tables: folders of Parquet files and manifests that say which of them are the table.

A commit writes its rows to new folders and then publishes one small manifest, by a
rename that fails if another commit has taken the number.  Readers use the newest
manifest and only the folders it names, so they see a whole version, whatever
happens meanwhile: a writer that is lost before the rename leaves files that nobody
reads.  A commit carries a token; a token that has been committed is not committed
again, so a batch that is sent twice changes the table once.

The rows of a table are dealt to buckets by their keys.  A merge reads and writes
the buckets that hold its keys, the others stay in the folders they are in.  The
number of buckets is fixed when a table is made; ``files`` are the files of a bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leaguespark.operators import merge as merging

BUCKETS = 16
#: Times that a merge starts anew when another commit came first.
TRIES = 5


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of a schema, which the optimizer knows: a merge into them needs no join and no shuffle for it."""
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).limit(0)


class Conflict(RuntimeError):
    """Another commit took the version's number."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS, files: int = 1) -> None:
        self.spark, self.path, self.keys, self.buckets, self.files = spark, path.rstrip("/"), list(keys), buckets, files

    # Files, through Hadoop's interface, so that any shared store will do.
    def _hadoop(self):
        return self.spark._jvm.org.apache.hadoop.fs

    def _path(self, name: str):
        return self._hadoop().Path(f"{self.path}/{name}")

    def _store(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        store, at = self._store(), self._path(folder)
        return sorted(f.getPath().getName() for f in store.listStatus(at)) if store.exists(at) else []

    def _write(self, name: str, text: str) -> None:
        out = self._store().create(self._path(name), False)
        out.write(bytearray(text, "utf-8"))
        out.close()

    def _manifest(self, version: int) -> dict:
        found = self._store().open(self._path(f"versions/{version:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(found, "UTF-8"))
        finally:
            found.close()

    def versions(self) -> list[int]:
        return [int(n.split(".")[0]) for n in self._names("versions") if n.endswith(".json") and n[0] != "."]

    def newest(self) -> dict | None:
        found = self.versions()
        return self._manifest(found[-1]) if found else None

    def committed(self, token: str | None) -> int | None:
        """The version of a token, among those that are kept."""
        return next((v for v in reversed(self.versions()) if token is not None and self._manifest(v)["token"] == token), None)

    def _publish(self, manifest: dict) -> None:
        """The step that makes a version one: a manifest of the next number, unless there is one."""
        draft = f"versions/.{uuid.uuid4().hex}"
        self._write(draft, json.dumps(manifest))
        fs = self._hadoop()
        files = fs.FileContext.getFileContext(self._path("").toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(self._path(draft), self._path(f"versions/{manifest['version']:012d}.json"), options)
        except Exception as e:
            self._store().delete(self._path(draft), False)
            if "already exists" in str(e) or "FileAlreadyExists" in str(e):
                raise Conflict(f"version {manifest['version']} of {self.path} is taken") from None
            raise

    # Rows.
    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _folders(self, manifest: dict | None, only: list[int] | None = None) -> list[str]:
        held = manifest["buckets"] if manifest else {}
        return sorted({folder for b, folder in held.items() if only is None or int(b) in only})

    def _rows(self, manifest: dict, only: list[int] | None = None) -> DataFrame:
        schema, folders = StructType.fromJson(manifest["schema"]), self._folders(manifest, only)
        if not folders:
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{f}" for f in folders])

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or an older one that is still kept."""
        manifest = self.newest() if version is None else self._manifest(version)
        if manifest is None:
            raise ValueError(f"{self.path} has no version yet")
        return self._rows(manifest)

    def _commit(self, rows: DataFrame, before: dict | None, kept: dict[str, str], token: str | None) -> int:
        run = uuid.uuid4().hex
        dealt = rows.withColumn("__b", self.bucket())
        share = F.pmod(F.xxhash64(F.lit(1), *self.keys), F.lit(self.files))
        dealt.repartition(F.col("__b"), share).write.partitionBy("__b").parquet(f"{self.path}/data/{run}")
        written = {n.split("=")[1]: f"{run}/{n}" for n in self._names(f"data/{run}") if n.startswith("__b=")}
        version = before["version"] + 1 if before else 0
        self._publish({"version": version, "token": token, "schema": rows.schema.jsonValue(), "buckets": kept | written})
        return version

    def replace(self, rows: DataFrame, token: str | None = None) -> int:
        """All rows anew; gives the version."""
        done = self.committed(token)
        return self._commit(rows, self.newest(), {}, token) if done is None else done

    def update(self, new: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], token: str | None = None) -> int:
        """The buckets of the new rows' keys become ``combine(old, new)``, which keeps the table's columns."""
        for _ in range(TRIES):
            done = self.committed(token)
            if done is not None:
                return done
            before = self.newest()
            if before is None:
                raise ValueError(f"{self.path} has no version yet")
            touched = sorted(r[0] for r in new.select(self.bucket().alias("b")).distinct().collect())  # at most ``buckets`` numbers
            kept = {b: folder for b, folder in before["buckets"].items() if int(b) not in touched}
            old = self._rows(before, touched)
            try:
                return self._commit(combine(old, new).select(*old.columns), before, kept, token)
            except Conflict:
                continue
        raise Conflict(f"{TRIES} commits to {self.path} came first")

    def change(self, choose: Callable[[DataFrame], DataFrame], token: str | None = None) -> int | None:
        """Rows that ``choose`` picks from the newest version take the values it gives them; picked anew if another commit came first.

        ``choose`` gives whole rows under keys of the table, the same ones whenever it is asked; None if there are none.
        """
        for _ in range(TRIES):
            done = self.committed(token)
            if done is not None:
                return done
            before = self.newest()
            if before is None:
                raise ValueError(f"{self.path} has no version yet")
            chosen = choose(self._rows(before))
            touched = sorted(r[0] for r in chosen.select(self.bucket().alias("b")).distinct().collect())
            if not touched:
                return None
            kept = {b: folder for b, folder in before["buckets"].items() if int(b) not in touched}
            old = self._rows(before, touched)
            try:
                return self._commit(old.join(chosen.select(*self.keys), self.keys, "left_anti").select(*old.columns).unionByName(chosen.select(*old.columns)), before, kept, token)
            except Conflict:
                continue
        raise Conflict(f"{TRIES} commits to {self.path} came first")

    def merge(self, new: DataFrame, token: str | None = None, **how) -> int:
        """An upsert by ``merge.merge``: overwrite, coalesce, insert_only, increments; columns that the merge doesn't name stay as they are."""
        named = {c for group in ("overwrite", "coalesce", "insert_only", "increments") for c in how.get(group) or []}

        def combine(old: DataFrame, rows: DataFrame) -> DataFrame:
            rest = [c for c in old.columns if c not in named and c not in self.keys]
            rows = rows.select("*", *[F.lit(None).cast(old.schema[c].dataType).alias(c) for c in [*rest, *(how.get("increments") or {})] if c not in rows.columns])
            return merging.merge(old, rows, self.keys, **{**how, "insert_only": [*(how.get("insert_only") or []), *rest]}).drop("outcome")

        return self.update(new, combine, token)

    def append(self, new: DataFrame, token: str | None = None) -> int:
        """New keys only, each once; rows whose keys are there already change nothing.  A null key is like no other row's."""
        return self.update(new, lambda old, rows: merging.insert_ignore(old, rows.select(*old.columns), self.keys), token)

    def delete(self, gone: DataFrame, token: str | None = None) -> int:
        """Without the rows of some keys."""
        return self.update(gone, lambda old, rows: old.join(rows.select(*self.keys).distinct(), self.keys, "left_anti"), token)

    def drop_old(self, keep: int = 2, older_than_ms: int = 3_600_000) -> list[str]:
        """Older manifests go, then the folders that no manifest names, if they are old enough to be no running commit's; gives what went."""
        store, gone = self._store(), []
        for version in self.versions()[:-keep]:
            store.delete(self._path(f"versions/{version:012d}.json"), False)
        named = {folder for v in self.versions() for folder in self._folders(self._manifest(v))}
        now = self.spark._jvm.System.currentTimeMillis()
        for run in self._names("data"):
            if now - store.getFileStatus(self._path(f"data/{run}")).getModificationTime() < older_than_ms:
                continue
            folders = [f"{run}/{n}" for n in self._names(f"data/{run}") if n.startswith("__b=")]
            unused = [f for f in folders if f not in named]
            for name in [run] if len(unused) == len(folders) else unused:
                store.delete(self._path(f"data/{name}"), True)
                gone.append(name)
        return gone
