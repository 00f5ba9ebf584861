"""Tables that are replaced as a whole, and never missing.

A table is a folder of versions, ``v-<number>``. A version counts once Spark has
put its ``_SUCCESS`` file in it, which it does last. So a writer that dies, at any
moment and on any store, leaves the version before it in force; nothing is moved
or renamed. The version before the newest one is kept for readers that began
earlier; older ones and unfinished ones are deleted by the next writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeflow.workspace import Store, remove_folder, shuffles_dropped, subfolders

_DONE = "_SUCCESS"  # fixed value: the file by which Spark says that a folder is complete


def _numbers(spark: SparkSession, path: str) -> list[int]:
    found = [n.removeprefix("v-") for n in subfolders(spark, path) if n.startswith("v-")]
    return sorted((int(n) for n in found if n.isdigit()), reverse=True)


def _folder(path: str, number: int) -> str:
    return f"{path}/v-{number:06d}"


def _finished(spark: SparkSession, path: str) -> list[int]:
    return [n for n in _numbers(spark, path) if Store(spark, _folder(path, n)).has(_DONE)]


def replace_table(df: DataFrame, path: str) -> str:
    """Write ``df`` as the newest version; its folder."""
    spark = df.sparkSession
    target = _folder(path, max(_numbers(spark, path), default=0) + 1)
    with shuffles_dropped(spark):
        df.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(target)
    keep = _finished(spark, path)[:2]
    for number in _numbers(spark, path):
        if number < keep[0] and number not in keep:
            remove_folder(spark, _folder(path, number))
    return target


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version."""
    finished = _finished(spark, path)
    if not finished:
        raise FileNotFoundError(f"no complete version of {path}")
    return spark.read.parquet(_folder(path, finished[0]))
