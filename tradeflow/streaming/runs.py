"""A log of runs: what ran, for how long, and how many rows it took in.

Entries lie in folders by day, so a report on a span of time opens its days only.
``fold_runs`` puts the entries of a day that is over into one file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tradeflow.workspace import Store, read_or_empty, remove_folder, subfolders

RUN_LOG = StructType(
    [
        StructField("run_id", StringType()),
        StructField("unit", StringType()),  # which pool of compute ran it
        StructField("step", StringType()),
        StructField("status", StringType()),
        StructField("start_time", TimestampType()),
        StructField("end_time", TimestampType()),
        StructField("total_elapsed_ms", DoubleType()),
        StructField("execution_ms", DoubleType()),
        StructField("row_count", LongType()),
        StructField("detail", StringType()),  # why it failed
    ]
)


def run_log_path(root: str) -> str:
    return f"{root}/logs/runs"


_FOLDING = "_folding"


def run_log(spark: SparkSession, root: str, since: datetime | None = None) -> DataFrame:
    """All runs, or those that started at ``since`` or later; days before it are not opened."""
    path = run_log_path(root)
    layout = [StructField("day", DateType()), StructField("entry", StringType())]
    rows = read_or_empty(spark, path, StructType([*RUN_LOG.fields, *layout]))
    if since is not None:
        rows = rows.where((F.col("day") >= F.lit(since.astimezone(timezone.utc).date())) & (F.col("start_time") >= F.lit(since)))
    # A day that is being folded may hold an entry twice for a moment.
    folding = any(Store(spark, f"{path}/{day}").has(_FOLDING) for day in subfolders(spark, path))
    return (rows.dropDuplicates(["run_id"]) if folding else rows).select(*RUN_LOG.names)


def enter_runs(spark: SparkSession, root: str, entries: list[tuple]) -> None:
    """Enter runs of one day. Each call has a folder of its own, as several sessions may write at once."""
    day, entry = entries[0][4].astimezone(timezone.utc).date(), uuid.uuid4().hex
    spark.createDataFrame(entries, RUN_LOG).coalesce(1).write.parquet(f"{run_log_path(root)}/day={day}/entry={entry}")


def fold_runs(spark: SparkSession, root: str, before: date) -> int:
    """Put the entries of each day before ``before`` into one file; the number of folders that went.

    The mark that a day is being folded is set first and taken away last. Where a
    fold died in between, entries are told apart by their id, and it can be done again.
    """
    path, gone = run_log_path(root), 0
    for name in subfolders(spark, path):
        folder = f"{path}/{name}"
        entries = [n for n in subfolders(spark, folder) if n.startswith("entry=")]
        if date.fromisoformat(name.removeprefix("day=")) >= before or len(entries) < 2:
            continue
        store = Store(spark, folder)
        store.touch(_FOLDING)
        rows = spark.read.schema(RUN_LOG).parquet(*[f"{folder}/{n}" for n in entries]).dropDuplicates(["run_id"])
        rows.coalesce(1).write.parquet(f"{folder}/entry={uuid.uuid4().hex}")
        for n in entries:
            remove_folder(spark, f"{folder}/{n}")
        store.drop(_FOLDING)
        gone += len(entries)
    return gone


@contextmanager
def logged_run(spark: SparkSession, root: str, unit: str, step: str) -> Iterator[dict]:
    """Enter the block in the run log once it is over; set ``row_count`` in what it yields.

    A block that fails is entered as FAILED, and fails on.
    """
    started, told, status, why = datetime.now(timezone.utc), {"row_count": None}, "FAILED", None
    try:
        yield told
        status = "SUCCEEDED"
    except Exception as failure:
        why = str(failure)[:1000]
        raise
    finally:
        ended = datetime.now(timezone.utc)
        took = (ended - started).total_seconds() * 1000
        enter_runs(spark, root, [(uuid.uuid4().hex, unit, step, status, started, ended, took, took, told["row_count"], why)])
