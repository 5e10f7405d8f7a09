"""Pieces that several corpus operators share: the shared work folder,
staged tables, row keys and Arrow access to whole texts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Words are runs of anything but ASCII white space. ``bytes.split()`` splits at exactly the same bytes.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
BLANKS = b" \t\n\x0b\x0c\r"

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves, in local mode only; on a cluster that is an error, as
    executors could not see each other's files.
    """
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = tempfile.mkdtemp(prefix="scoreline-")
        atexit.register(shutil.rmtree, _own_dir[app], ignore_errors=True)
    return _own_dir[app]


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    where, fs = _hadoop(spark, path)
    fs.delete(where, True)


def let_workers_import(spark: SparkSession) -> None:
    """Adds the folder of this package to the path of Python workers, for sessions whose workers start elsewhere."""
    env, home = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = env.get("PYTHONPATH", "").split(os.pathsep)
    if home not in path and home not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [*path, home]))


_made: list[Workspace] = []


def made() -> int:
    """How many work folders there are: a mark for ``release``."""
    return len(_made)


def release(mark: int) -> None:
    """Removes the tables of all work folders made since ``mark``: for a caller that has written what it wanted."""
    for w in _made[mark:]:
        w._clean()
    del _made[mark:]


class Workspace:
    """Tables that one run of an operator writes to the shared folder.

    ``put`` cuts the lineage: what it returns reads Parquet files, so a lost executor costs a reread and no
    recomputation. A table can be dropped as soon as nothing reads it; the rest goes when the driver exits.
    """

    def __init__(self, spark: SparkSession, name: str):
        let_workers_import(spark)
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        self.names: list[str] = []
        _made.append(self)
        atexit.register(self._clean)

    def path(self) -> str:
        self.n += 1
        return f"{self.root}/{self.n}"

    def put(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        path = self.path()
        out = df.write.option("compression", "zstd")
        (out.partitionBy(partition_by) if partition_by else out).parquet(path)
        got = self.spark.read.schema(df.schema).parquet(path)
        got._staged_at = path
        return got

    def put_bucketed(self, df: DataFrame, key: str) -> DataFrame:
        """The rows in buckets by ``key``, each a sorted file, as many as the session's shuffle partitions: a join or a
        sum by ``key`` finds them where they are, without an exchange on this side."""
        got = bucketed(df, key, self.path())
        self.names.append(got._named)
        return got

    def drop(self, *tables: DataFrame | None) -> None:
        drop_tables(self.spark, *tables)

    def _clean(self) -> None:
        try:
            for n in self.names:
                self.spark.sql(f"DROP TABLE IF EXISTS {n}")
            remove(self.spark, self.root)
        except Exception:  # the session has ended already
            pass


def bucketed(df: DataFrame, key: str, path: str) -> DataFrame:
    """Writes ``df`` to ``path`` in buckets by ``key``, sorted, one file each."""
    spark, name = df.sparkSession, f"scoreline_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("compression", "zstd").option("path", path).saveAsTable(name)
    got = spark.table(name)
    got._staged_at, got._named = path, name
    return got


def reopened(spark: SparkSession, path: str, schema: str, key: str, n: int) -> DataFrame:
    """What ``bucketed`` has written to ``path`` in ``n`` buckets, perhaps by another session."""
    name = f"scoreline_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {n} BUCKETS LOCATION '{path}'")
    got = spark.table(name)
    got._staged_at, got._named = path, name
    return got


def read_text(spark: SparkSession, path: str) -> str | None:
    """A file of the shared folder; None if there is none."""
    where, fs = _hadoop(spark, path)
    if not fs.exists(where):
        return None
    opened = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Puts a file in place whole: it is written beside the old one and then renamed."""
    (new, fs), (where, _) = _hadoop(spark, f"{path}.new"), _hadoop(spark, path)
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(where, False)
    fs.rename(new, where)


def drop_tables(spark: SparkSession, *tables: DataFrame | None) -> None:
    """Removes staged tables and their files."""
    for t in tables:
        if t is not None and hasattr(t, "_staged_at"):
            if hasattr(t, "_named"):
                spark.sql(f"DROP TABLE IF EXISTS {t._named}")
            remove(spark, t._staged_at)


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def row_key(*cols: str) -> list[Column]:
    """96 bits that stand for a row's content; rows of equal content share them and get equal results."""
    return [F.xxhash64(*cols).alias("rk1"), F.hash(*cols).alias("rk2")]


KEY = ["rk1", "rk2"]


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def boxed(docs: DataFrame, *without: str) -> Column:
    """All columns of a frame, but some, as one struct ``row``: whatever they are called, they clash with nothing."""
    keep = [F.col(quoted(c)) for c in docs.columns if c.lower() not in without]
    return F.struct(*keep or [F.lit(0).alias("none")]).alias("row")


def unboxed(docs: DataFrame, **new: Column) -> list[Column]:
    """The columns of the frame that was boxed, in order, some of them replaced."""
    return [new[c.lower()].alias(c) if c.lower() in new else F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns]


def raw(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column's UTF-8 bytes; null as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def vectors(col: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the lists that are there and hold finite numbers only, once for each length, as doubles."""
    at, there = np.asarray(col.offsets), np.asarray(col.is_valid())
    flat = col.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    unfit = np.r_[0, np.cumsum(~np.isfinite(flat))]
    length = np.where(there & (unfit[at[1:]] == unfit[at[:-1]]), np.diff(at), -1)
    for n in np.unique(length[length >= 0]).tolist():
        places = np.flatnonzero(length == n)
        yield places, flat[at[places][:, None] + np.arange(n)]


def arrow_map(df: DataFrame, fn, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with a function from one record batch to record batches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from fn(b)

    let_workers_import(df.sparkSession)
    return df.mapInArrow(run, schema)


def blocks(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that what is derived from many texts is never held for all of them at once."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
