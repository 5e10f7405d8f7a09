"""Tables as folders of versions: readers follow a pointer, writers make a new version and move the pointer.

A version is complete before the pointer names it, so a reader sees the old rows or the new ones, never a gap
between a delete and an insert. Old versions stay until ``expire``.
"""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another writer has moved the pointer meanwhile."""


def retry_on_conflict(action: Callable[[], object], attempts: int = 3, delay: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> object:
    for k in range(1, attempts + 1):
        try:
            return action()
        except Conflict:
            if k == attempts:
                raise
            sleep(delay * k)


def work_folder(spark: SparkSession) -> str:
    """Under the shared folder that the cluster names; a temporary one on a single machine that names none."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return f"{found.rstrip('/')}/refresh-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="refresh-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    return made


Parts = Callable[[str], bool]


class TableStore:
    """A version names its files by part, the value of ``part`` for the rows in it (one part without). A write that
    touches some parts takes over the others' files as they are, so its cost follows what has changed."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        #: Told of the rows of each write: table, frame, number.
        self.on_write: Callable[[str, DataFrame, int], None] = lambda name, df, rows: None
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _read(self, path: str) -> str:
        opened = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
        finally:
            opened.close()

    def _names(self, path: str) -> list[str]:
        p = self._path(path)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def versions(self, name: str) -> list[int]:
        return sorted(int(n[8:-5]) for n in self._names(f"{self.root}/{name}") if n.startswith("pointer-") and n.endswith(".json"))

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def _pointer(self, name: str, version: int) -> dict:
        return json.loads(self._read(f"{self.root}/{name}/pointer-{version}.json"))

    def layout(self, name: str) -> str | None:
        """The expression that names the parts of the rows; None for a table without."""
        return self._pointer(name, self.versions(name)[-1])["by"]

    def written(self, name: str, version: int | None = None) -> int:
        """How many rows the write of a version has written, as observed then."""
        return self._pointer(name, version or self.versions(name)[-1])["rows"]

    def parts(self, name: str) -> list[str]:
        return sorted(self._pointer(name, self.versions(name)[-1])["parts"])

    def read(self, name: str, version: int | None = None, parts: Parts | None = None) -> DataFrame:
        """All rows of a version, the last by default, or those of some parts."""
        at = self._pointer(name, version or self.versions(name)[-1])
        paths = [p for k, ps in at["parts"].items() if parts is None or parts(k) for p in ps]
        if not paths:
            return self.spark.createDataFrame([], at["schema"])
        return self.spark.read.schema(at["schema"]).parquet(*paths)

    def _commit(self, name: str, version: int, parts: dict[str, list[str]], schema: str, by: str | None, rows: int) -> int:
        """Creating the pointer file is the commit; of two writers of one version only one can create it."""
        try:
            out = self._fs.create(self._path(f"{self.root}/{name}/pointer-{version}.json"), False)
        except Exception as e:
            raise Conflict(f"{name}: version {version} is taken") from e
        out.write(bytearray(json.dumps({"parts": parts, "schema": schema, "by": by, "rows": rows, "at": time.time()}).encode()))
        out.close()
        return version

    def _write(self, name: str, version: int, df: DataFrame, by: str | None) -> tuple[dict[str, list[str]], int]:
        """Files of the rows by part, and how many rows. ``by`` is an expression over the columns; its value only names the folder. Rows of
        a part are brought together first, and AQE splits large parts, so that a part is few files of a good size."""
        path, seen = f"{self.root}/{name}/data-{version}-{time.time_ns()}", Observation()
        counted = lambda rows: rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd")
        if by is None:
            counted(df).parquet(path)
            self.on_write(name, df, seen.get["rows"])
            return {"all": [path]}, seen.get["rows"]
        parted = df.withColumn("_part", F.coalesce(F.expr(by).cast("string"), F.lit("none")))
        counted(parted.hint("rebalance", "_part")).partitionBy("_part").parquet(path)
        self.on_write(name, df, seen.get["rows"])
        return {n[6:]: [f"{path}/{n}"] for n in self._names(path) if n.startswith("_part=")}, seen.get["rows"]

    @staticmethod
    def _ddl(df: DataFrame) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def overwrite(self, name: str, df: DataFrame, by: str | None = None, base: int | None = None) -> int:
        """A new version of exactly these rows."""
        version = (base if base is not None else (self.versions(name) or [0])[-1]) + 1
        made, rows = self._write(name, version, df, by)
        return self._commit(name, version, made, self._ddl(df), by, rows)

    def drop(self, name: str) -> None:
        """The whole table goes, all of its versions."""
        self._fs.delete(self._path(f"{self.root}/{name}"), True)

    def drop_parts(self, name: str, parts: Parts) -> int:
        """A version without these parts, whose files go, as all older versions do."""
        last = self.versions(name)[-1]
        at = self._pointer(name, last)
        version = self._commit(name, last + 1, {k: ps for k, ps in at["parts"].items() if not parts(k)}, at["schema"], at["by"], at["rows"])
        self.expire(name)
        return version

    def append(self, name: str, df: DataFrame, by: str | None = None) -> int:
        """``by`` is for a table that is made by this."""
        if not self.exists(name):
            return self.overwrite(name, df, by)
        last = self.versions(name)[-1]
        at = self._pointer(name, last)
        new, rows = self._write(name, last + 1, df.select(*self.read(name, last).columns), at["by"])
        return self._commit(name, last + 1, {k: at["parts"].get(k, []) + new.get(k, []) for k in {*at["parts"], *new}}, at["schema"], at["by"], rows)

    def _replace(self, name: str, new: DataFrame, stay: Callable[[DataFrame], DataFrame], by: str | None, parts: Parts | None) -> int:
        """In the parts touched, what ``stay`` keeps of the old rows, and the new rows; the other parts as they are."""
        if not self.exists(name):
            return self.overwrite(name, new, by)
        last = self.versions(name)[-1]
        at = self._pointer(name, last)
        touched = {k for k in at["parts"] if parts is None or parts(k)}
        old = self.read(name, last, lambda k: k in touched)
        made, rows = self._write(name, last + 1, stay(old).unionByName(new.select(*old.columns)), at["by"])
        kept = {k: ps for k, ps in at["parts"].items() if k not in touched}
        return self._commit(name, last + 1, {k: kept.get(k, []) + made.get(k, []) for k in {*kept, *made}}, at["schema"], at["by"], rows)

    def replace_keys(self, name: str, new: DataFrame, keys: list[str], gone: DataFrame | None = None, by: str | None = None, parts: Parts | None = None) -> int:
        """Rows of the keys of ``gone`` (by default those of ``new``) go, the new rows come, in one version. ``parts``
        says where old rows of these keys can be."""
        out = (gone if gone is not None else new).select(*keys).distinct()
        return self._replace(name, new, lambda old: old.join(out, keys, "left_anti"), by, parts)

    def replace_where(self, name: str, new: DataFrame, where: Column, by: str | None = None, parts: Parts | None = None) -> int:
        """Rows for which ``where`` holds go, the new rows come."""
        return self._replace(name, new, lambda old: old.filter(~F.coalesce(where, F.lit(False))), by, parts)

    def compact(self, name: str, target_mb: int = 256) -> int:
        """The same rows in files of about ``target_mb``: partitions are merged and split to that size as they are
        written, in parallel."""
        last, size = self.versions(name)[-1], "spark.sql.adaptive.advisoryPartitionSizeInBytes"
        before = self.spark.conf.get(size, None)
        self.spark.conf.set(size, f"{target_mb}m")
        try:
            by = self._pointer(name, last)["by"]
            rows = self.read(name, last)
            return self.overwrite(name, rows if by else rows.hint("rebalance"), by, last)
        finally:
            self.spark.conf.set(size, before) if before else self.spark.conf.unset(size)

    def expire(self, name: str, keep: int = 1, days: float = 0, now: Callable[[], float] = time.time) -> None:
        """Drops versions written over ``days`` days ago, but for the last ``keep``, and the files that none of those
        that stay names."""
        all_ = self.versions(name)
        young = {v for v in all_ if days and self._pointer(name, v).get("at", 0) >= now() - days * 86_400}
        stay = young | set(all_[-keep:])
        used = {p for v in stay for ps in self._pointer(name, v)["parts"].values() for p in ps}
        for v in all_:
            if v not in stay:
                self._fs.delete(self._path(f"{self.root}/{name}/pointer-{v}.json"), False)
        for n in self._names(f"{self.root}/{name}"):
            top = f"{self.root}/{name}/{n}"
            if not n.startswith("data-") or top in used:
                continue
            inner = [f"{top}/{x}" for x in self._names(top) if x.startswith("_part=")]
            for gone in [p for p in inner if p not in used] if any(p in used for p in inner) else [top]:
                self._fs.delete(self._path(gone), True)
