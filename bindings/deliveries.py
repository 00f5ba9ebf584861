"""The driver's tables delivered as files and loaded, for jobs that start there."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.landing import deliver, whole_files
from tradeflow.sources.driver_tables import built_rows, is_written, raw_table
from tradeflow.sources.formats import FEEDS
from tradeflow.streaming.ingest import load_new_files
from tradeflow.workspace import new_folder, remove_folder

DELIVERIES = 3
# About so many events a file, which a pipe reads as one text.
EVENTS_PER_FILE = 150_000

# Folder and the feeds that are in it, by application and tables.
_stages: dict[tuple[str, str, bool], tuple[str, set[str]]] = {}
_roots: dict[tuple[str, str], tuple[str, set[str]]] = {}


def delivery_of(feed: str) -> Column:
    """Which delivery, from 1, a row of the feed arrives in. Every row has one."""
    if feed == "market_events":
        return F.coalesce(F.minute("event_ts"), F.lit(0)) % DELIVERIES + 1
    return F.col("account_id").cast("bigint") % DELIVERIES + 1


def files_per_delivery(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _feed_rows(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """The feed's rows, from the RAW table if that is written; it is not written to be delivered alone."""
    table = FEEDS[feed].table
    if is_written(spark, sf_dir, table):
        return whole_files(raw_table(spark, sf_dir, table))
    return built_rows(spark, sf_dir, table)


def deliver_feed(spark: SparkSession, sf_dir: str, feed: str, stage: str, batches=range(1, DELIVERIES + 1), packed: bool = True) -> list[str]:
    """Put deliveries of a feed on the stage; their folders. Files of events are packed, unless they are to be cut into ranges."""
    gathered = None if is_written(spark, sf_dir, FEEDS[feed].table) else True
    rows, files, a_task = _feed_rows(spark, sf_dir, feed), files_per_delivery(spark), files_a_task(spark, sf_dir, feed)
    return [deliver(rows.where(delivery_of(feed) == batch), feed, stage, batch, files, a_task, gathered, packed) for batch in batches]


def files_a_task(spark: SparkSession, sf_dir: str, feed: str) -> int:
    """How many files each task of a delivery writes."""
    if feed != "market_events":
        return 1
    return max(1, math.ceil(_feed_rows(spark, sf_dir, feed).count() / (DELIVERIES * files_per_delivery(spark) * EVENTS_PER_FILE)))


def stage_with(spark: SparkSession, sf_dir: str, *feeds: str, packed: bool = True) -> str:
    """The stage all feeds share, with every delivery of at least ``feeds``; each feed is put there once.

    There is one of packed files, and another of files that are not.
    """
    key = (spark.sparkContext.applicationId, sf_dir, packed)
    stage, there = _stages.setdefault(key, (new_folder(spark, "stage"), set()))
    for feed in feeds:
        if feed not in there:
            deliver_feed(spark, sf_dir, feed, stage, packed=packed)
            there.add(feed)
    return stage


def load_by_delivery(spark: SparkSession, sf_dir: str, feed: str, root: str, then=None):
    """Load a feed's deliveries as one micro-batch each.

    They come from the stage all share if the feed is there. Otherwise each is delivered when the one before has been
    loaded, and deleted then, so that a feed never lies on a stage as a whole just to be loaded.
    """
    options = {"files_per_batch": files_per_delivery(spark) * files_a_task(spark, sf_dir, feed), "then": then}
    shared, there = _stages.get((spark.sparkContext.applicationId, sf_dir, True), ("", set()))
    if feed in there:
        load_new_files(spark, feed, shared, root, **options)
        return
    stage = new_folder(spark, "passing-stage")
    for batch in range(1, DELIVERIES + 1):
        delivered = deliver_feed(spark, sf_dir, feed, stage, [batch])
        load_new_files(spark, feed, stage, root, **options)
        for folder in delivered:
            remove_folder(spark, folder)


def loaded_root(spark: SparkSession, sf_dir: str, *feeds: str) -> str:
    """A root with at least ``feeds`` loaded, three batches each. Only to be read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    root, there = _roots.setdefault(key, (new_folder(spark, "loaded"), set()))
    for feed in feeds:
        if feed not in there:
            load_by_delivery(spark, sf_dir, feed, root)
            there.add(feed)
    return root
