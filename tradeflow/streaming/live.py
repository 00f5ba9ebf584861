"""Aggregates kept by Structured Streaming's own state, in update mode.

Both follow loaded batches, and each run takes in what has been published since
the last one; the checkpoint goes on from there after a restart. State lies in
RocksDB on the executors, and has no watermark: a row that comes late counts.

* Event counts: every loaded batch is published once as partial counts, dealt by
  group over slots of one file each. The stream adds them up per group.
* Distinct accounts: loaded positions are reduced to (symbol, account) pairs met
  for the first time, which feed a count per symbol. A batch that is stored anew
  brings no new pairs, so replays change nothing.

What changes in a trigger is written as that trigger's folder, which a replay
replaces. Totals only grow, so a reader takes the greatest of each group.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tradeflow.operators.rollups import EVENT_SUMMARY
from tradeflow.schemas import POSITIONS
from tradeflow.sources.formats import literal
from tradeflow.streaming.ingest import load_log, raw_path, raw_rows, state_on_disk
from tradeflow.streaming.maintained import MaintainedTable
from tradeflow.workspace import Store, read_or_empty, subfolders

EVENT_COUNTS = MaintainedTable("event_counts_live", "curated", EVENT_SUMMARY.schema, "0")
ACCOUNT_COUNTS = MaintainedTable(
    "account_counts_live", "curated",
    StructType([StructField("symbol", StringType()), StructField("account_count", LongType())]), "0")
_KEYS = {EVENT_COUNTS.name: ["event_hour", "symbol", "event_type"], ACCOUNT_COUNTS.name: ["symbol"]}
# A batch is published in a slot for each so many of its rows.
ROWS_PER_SLOT = 500_000
# After so many triggers what they wrote is put together.
FOLD_AFTER = 32


def _published(root: str) -> str:
    return f"{root}/published/event_counts"


def _updates(root: str, table: MaintainedTable) -> str:
    return f"{root}/updates/{table.name}"


def _files(spark: SparkSession, folder: str) -> bool:
    return any(f.endswith(".parquet") for f in Store(spark, folder).sizes())


def publish_events(spark: SparkSession, root: str) -> list[int]:
    """Publish the loaded batches of events that are not yet; their numbers.

    A slot has one file, written by one task: Spark moves it to its place when it is complete, so it is
    there as a whole or not at all. Which slot a group is in follows from the load log alone, so a batch
    whose publication was lost gets the slots it lacks, and nothing is published twice.
    """
    log = load_log(spark, root, "market_events_raw").groupBy("_batch").agg(F.sum("row_count").alias("n"))
    new = []
    for batch, n in sorted((r["_batch"], r["n"] or 0) for r in log.collect()):
        folder = f"{_published(root)}/_batch={batch}"
        if Store(spark, folder).has("_SUCCESS") or _files(spark, folder):  # or published as one file
            continue
        slots = max(1, math.ceil(n / ROWS_PER_SLOT))
        there = [int(s.removeprefix("_slot=")) for s in subfolders(spark, folder) if s.startswith("_slot=") and _files(spark, f"{folder}/{s}")]
        rows = raw_rows(spark, root, "market_events_raw", after=batch - 1, upto=batch).where(F.col("_batch") == batch)
        counts = EVENT_SUMMARY.partial(rows).withColumn("_slot", F.pmod(F.xxhash64(*EVENT_SUMMARY.keys), F.lit(slots)))
        lacking = counts.where(~F.col("_slot").isin(there)).repartition(slots, "_slot")
        options = {"maxRecordsPerFile": 0, "mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}
        lacking.write.mode("append").options(**options).partitionBy("_slot").parquet(folder)
        new.append(batch)
    return new


def _advance(spark: SparkSession, root: str, table: MaintainedTable, totals: DataFrame) -> None:
    """Take in everything there is, then end."""
    def keep(changed: DataFrame, trigger: int) -> None:
        changed.select(*table.schema.names).write.mode("overwrite").parquet(f"{_updates(root, table)}/trigger={trigger}")

    writer = totals.writeStream.outputMode("update").queryName(table.name).foreachBatch(keep)
    writer = writer.option("checkpointLocation", f"{root}/checkpoints/{table.name}").trigger(availableNow=True)
    with state_on_disk(spark):
        query = writer.start()
    query.awaitTermination()
    _fold(spark, root, table)


def _triggers(spark: SparkSession, root: str, table: MaintainedTable) -> list[int]:
    return sorted(int(n.removeprefix("trigger=")) for n in subfolders(spark, _updates(root, table)) if n.startswith("trigger="))


def _fold(spark: SparkSession, root: str, table: MaintainedTable) -> None:
    """Put triggers that are over into the table, once there are many. Done twice, it changes nothing."""
    at = table.last_refresh(spark, root)
    done = at["inputs"].get("trigger", -1)
    new = [t for t in _triggers(spark, root, table) if t > done]
    if len(new) >= FOLD_AFTER:
        table.commit(spark, root, read(spark, root, table), at=at, inputs={"trigger": new[-1]}, replacing=[0], action="FOLD")
        for trigger in _triggers(spark, root, table):
            if trigger <= done:  # those of the fold before: a reader may still hold the last ones
                Store(spark, f"{_updates(root, table)}/trigger={trigger}").remove()


def read(spark: SparkSession, root: str, table: MaintainedTable) -> DataFrame:
    """The newest total of each group."""
    keys = _KEYS[table.name]
    folded = table.read(spark, root)
    layout = StructType([*table.schema.fields, StructField("trigger", LongType())])
    newer = read_or_empty(spark, _updates(root, table), layout).select(*table.schema.names)
    values = [n for n in table.schema.names if n not in keys]
    return folded.unionByName(newer).groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])


def count_events(spark: SparkSession, root: str) -> None:
    """Bring the event counts up to the loaded batches."""
    publish_events(spark, root)
    if not subfolders(spark, _published(root)):
        return
    partials = spark.readStream.schema(EVENT_SUMMARY.schema).option("recursiveFileLookup", True).option(
        "maxFileAge", "36500d").parquet(literal(_published(root)))
    _advance(spark, root, EVENT_COUNTS, EVENT_SUMMARY.merge(partials))


def count_accounts(spark: SparkSession, root: str) -> None:
    """Bring the number of different accounts per symbol up to the loaded batches."""
    if not subfolders(spark, raw_path(root, "positions_raw")):
        return
    loaded = spark.readStream.schema(POSITIONS).options(recursiveFileLookup=True, maxFileAge="36500d").parquet(
        literal(raw_path(root, "positions_raw")))
    pairs = loaded.dropDuplicates(["symbol", "account_id"])
    _advance(spark, root, ACCOUNT_COUNTS, pairs.groupBy("symbol").agg(F.count("account_id").alias("account_count")))


def following(step: Callable[[SparkSession, str], None]) -> Callable[[SparkSession, str, int], None]:
    """``step`` as what a pipe runs after each batch."""
    return lambda spark, root, batch: step(spark, root)
