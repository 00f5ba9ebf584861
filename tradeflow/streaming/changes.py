"""Change streams: what a consumer has not seen of a RAW table.

RAW tables only ever gain batches, so a change stream is a remembered batch
number per (consumer, table). A consumer moves its mark after its own output is
stored; if it fails in between it sees the same changes again, so a step must
replace its output rather than add to it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.streaming.ingest import latest_batch, raw_rows
from tradeflow.workspace import Store

_SEEN = "seen-"


def _marks(spark: SparkSession, root: str, consumer: str, table: str) -> Store:
    return Store(spark, f"{root}/logs/marks/{quote(consumer, safe='')}/{table}")


def _numbers(marks: Store) -> list[int]:
    return sorted(int(n.removeprefix(_SEEN)) for n in marks.sizes() if n.startswith(_SEEN))


def seen(spark: SparkSession, root: str, consumer: str, table: str) -> int:
    """The last batch the consumer is done with; a mark is a file's name, so nothing is read."""
    return max(_numbers(_marks(spark, root, consumer, table)), default=-1)


def mark_seen(spark: SparkSession, root: str, consumer: str, marks: Mapping[str, int]) -> None:
    """Move the marks. Older ones go once the new one is there, so there are two at most."""
    for table, batch in marks.items():
        held = _marks(spark, root, consumer, table)
        before = _numbers(held)
        if batch < 0 or batch in before:
            continue
        held.touch(f"{_SEEN}{batch}")
        for number in before:
            held.drop(f"{_SEEN}{number}")


def changes(spark: SparkSession, root: str, consumer: str, table: str) -> DataFrame:
    return raw_rows(spark, root, table, after=seen(spark, root, consumer, table))


def has_data(spark: SparkSession, root: str, consumer: str, table: str) -> bool:
    return latest_batch(spark, root, table) > seen(spark, root, consumer, table)


def stream_status(spark: SparkSession, root: str, consumer: str, tables: list[str]) -> DataFrame:
    """One row per table: does its stream hold anything new for ``consumer``?"""
    rows = [
        spark.range(1).select(
            F.lit(f"{table.upper()}_STREAM").alias("stream"),
            F.lit(has_data(spark, root, consumer, table)).alias("has_data"),
        )
        for table in tables
    ]
    return reduce(DataFrame.unionByName, rows)


def run_if_new(
    spark: SparkSession,
    root: str,
    consumer: str,
    table: str,
    step: Callable[[SparkSession, str, int], object],
) -> bool:
    """Run ``step`` only when ``table`` has unseen rows, then move the mark.

    The step is told the last batch it may take in; later ones are for next time.
    """
    upto = latest_batch(spark, root, table)
    if upto <= seen(spark, root, consumer, table):
        return False
    step(spark, root, upto)
    mark_seen(spark, root, consumer, {table: upto})
    return True
