"""Where jobs keep the tables and checkpoints they write.

Every executor and a restarted driver must see these files, so the folder is
the shared one the session names in ``spark.checkpoint.dir``. Only a local
master, whose executors share the driver's disk, may fall back to a temporary
folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_root: list[str] = []
# How written tables are packed: a third to half fewer bytes than by Spark's default on trades.
PACKED = {"compression": "zstd"}
# Fixed value: Spark's name of the setting by which an execution deletes its shuffle files at its end.
_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="tradeflow-"))
    return _local_root[0]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nothing has used yet, below the shared root."""
    return f"{shared_root(spark)}/tradeflow/{label}-{uuid.uuid4().hex[:12]}"


class Store:
    """The file system of a path as Spark itself resolves it: by scheme, or the session's default."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._base = self._hadoop.Path(path)
        self._files = self._base.getFileSystem(spark._jsc.hadoopConfiguration())

    def _entries(self, path):
        if not self._files.exists(path):
            return []
        return list(self._files.listStatus(path))

    def folders(self) -> list[str]:
        """Names of the folders in it; none if it does not exist."""
        return [e.getPath().getName() for e in self._entries(self._base) if e.isDirectory()]

    def sizes(self) -> dict[str, int]:
        """Names and bytes of the files in it."""
        return {e.getPath().getName(): e.getLen() for e in self._entries(self._base) if e.isFile()}

    def touch(self, name: str) -> None:
        """An empty file."""
        self._files.create(self._hadoop.Path(self._base, name), True).close()

    def drop(self, name: str) -> None:
        self._files.delete(self._hadoop.Path(self._base, name), False)

    def has(self, name: str) -> bool:
        return self._files.exists(self._hadoop.Path(self._base, name))

    def remove(self) -> None:
        self._files.delete(self._base, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    return Store(spark, path).folders()


def remove_folder(spark: SparkSession, path: str) -> None:
    Store(spark, path).remove()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What runs inside deletes its shuffle files when it ends; by default they stay until the driver collects its garbage.

    For steps that write what they found: nothing reads their shuffles again.
    """
    named = spark.conf.get(_DROPPED, None)
    spark.conf.set(_DROPPED, True)
    try:
        yield
    finally:
        spark.conf.unset(_DROPPED) if named is None else spark.conf.set(_DROPPED, named)


def settled(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` and return the written table.

    The result has a short lineage and a size that can be measured cheaply.
    """
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").options(**PACKED).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet table at ``path``, or no rows while nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
