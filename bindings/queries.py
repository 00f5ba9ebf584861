"""Every registered query: (spark, sf_dir) -> DataFrame over the driver's tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import deliveries
from tradeflow.operators import enrich, events, rollups
from tradeflow.plans import jobs, reports
from tradeflow.schemas import POSITIONS, TRADE_METRICS, TRADES, conform
from tradeflow.sources.driver_tables import raw_table
from tradeflow.sources.formats import FEEDS, scan
from tradeflow.sources.versions import read_table
from tradeflow.streaming import changes, ingest, live, refresh
from tradeflow.workspace import new_folder, remove_folder, settled

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _trades(spark, sf_dir) -> DataFrame:
    return raw_table(spark, sf_dir, "trades_raw")


def _positions(spark, sf_dir) -> DataFrame:
    return raw_table(spark, sf_dir, "positions_raw")


def _events(spark, sf_dir) -> DataFrame:
    return raw_table(spark, sf_dir, "market_events_raw")


def _attributes_as_columns(rows: DataFrame) -> DataFrame:
    """A variant has no counterpart in the check engine; its members have."""
    members = {"source": "string", "trade_id": "string", "account_id": "string",
               "current_price": "decimal(18,4)"}
    return rows.select(
        "event_ts", "symbol", "event_type",
        *[F.try_variant_get("event_attr", f"$.{k}", t).alias(k) for k, t in members.items()],
    )


def _delivery(path: str):
    return F.regexp_extract(path, r"batch(\d+)/", 1).cast("int")


# --- scans -------------------------------------------------------------------


@query
def scan_csv_trades(spark, sf_dir):
    return scan(spark, FEEDS["trades"], deliveries.stage_with(spark, sf_dir, "trades")).select(*TRADES.names)


@query
def scan_json_events(spark, sf_dir):
    stage = deliveries.stage_with(spark, sf_dir, "market_events")
    return _attributes_as_columns(scan(spark, FEEDS["market_events"], stage))


@query
def scan_json_ranges(spark, sf_dir):
    """Events with every array read by many tasks, in ranges of 64 kB."""
    stage, own = deliveries.stage_with(spark, sf_dir, "market_events", packed=False), spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(name, "64k")
    return _attributes_as_columns(scan(own, FEEDS["market_events"], stage))


@query
def scan_parquet_positions(spark, sf_dir):
    stage = deliveries.stage_with(spark, sf_dir, "positions")
    return scan(spark, FEEDS["positions"], stage).select(*POSITIONS.names)


@query
def scan_pattern(spark, sf_dir):
    """Rows found per delivery by path pattern, on a stage all feeds share."""
    stage = deliveries.stage_with(spark, sf_dir, *FEEDS)
    found = [
        scan(spark, feed, stage).groupBy(_delivery("_src_file").alias("delivery"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("feed"), "delivery", "row_count")
        for name, feed in FEEDS.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


# --- loading -----------------------------------------------------------------


@query
def copy_into_once(spark, sf_dir):
    """Trades after loading the stage twice: the second load finds nothing new."""
    stage, root = deliveries.stage_with(spark, sf_dir, "trades"), new_folder(spark, "copy")
    ingest.load_new_files(spark, "trades", stage, root)
    ingest.load_new_files(spark, "trades", stage, root)
    return ingest.raw_rows(spark, root, "trades_raw").select(*TRADES.names)


@query
def pipe_batches(spark, sf_dir):
    """Positions loaded by a running pipe in several micro-batches."""
    stage, root = deliveries.stage_with(spark, sf_dir, "positions"), new_folder(spark, "pipe")
    pipe = ingest.start_pipe(
        spark, "positions", stage, root, every="1 second",
        files_per_batch=deliveries.files_per_delivery(spark),
    )
    try:
        pipe.processAllAvailable()
    finally:
        pipe.stop()
    return ingest.raw_rows(spark, root, "positions_raw").select(*POSITIONS.names)


@query
def pipe_notices(spark, sf_dir):
    """Trades by a pipe that is told of files, of some twice, and is started anew in between."""
    stage, root = deliveries.stage_with(spark, sf_dir, "trades"), new_folder(spark, "told")
    notices, files = f"{root}/notices", ingest.list_stage(spark, FEEDS["trades"], stage)
    for deliveries_told in ([1, 2], [2, 3]):
        told = files.where(_delivery("file_name").isin(deliveries_told))
        ingest.announce(told, notices, files_per_notice=deliveries.files_per_delivery(spark))
        ingest.load_new_files(spark, "trades", stage, root, notices=notices)
    return ingest.raw_rows(spark, root, "trades_raw").select(*TRADES.names)


@query
def pipe_refresh(spark, sf_dir):
    """Events of a first delivery, then a backfill of those that came later."""
    stage, root = new_folder(spark, "late-stage"), new_folder(spark, "backfill")
    deliveries.deliver_feed(spark, sf_dir, "market_events", stage, [1])
    ingest.load_new_files(spark, "market_events", stage, root)
    deliveries.deliver_feed(spark, sf_dir, "market_events", stage, [2, 3])
    ingest.load_new_files(spark, "market_events", stage, root)
    return _attributes_as_columns(ingest.raw_rows(spark, root, "market_events_raw"))


@query
def stop_resume(spark, sf_dir):
    """Trades from a pipe stopped after its first batch and resumed."""
    stage, root = deliveries.stage_with(spark, sf_dir, "trades"), new_folder(spark, "stopped")
    per_batch = deliveries.files_per_delivery(spark)
    pipe = ingest.start_pipe(
        spark, "trades", stage, root, every="10 seconds", files_per_batch=per_batch
    )
    until = time.monotonic() + 300
    while ingest.latest_batch(spark, root, "trades_raw") < 0 and pipe.isActive and time.monotonic() < until:
        time.sleep(0.2)
    pipe.stop()
    ingest.load_new_files(spark, "trades", stage, root, files_per_batch=per_batch)
    return ingest.raw_rows(spark, root, "trades_raw").select(*TRADES.names)


# --- sinks -------------------------------------------------------------------


@query
def sink_overwrite(spark, sf_dir):
    """Enriched trades written twice over the same table."""
    target = new_folder(spark, "overwritten")
    enriched = enrich.enrich_trades(_trades(spark, sf_dir), _positions(spark, sf_dir))
    jobs.overwrite(enriched, target)
    jobs.overwrite(enriched, target)
    return read_table(spark, target)


@query
def sink_append(spark, sf_dir):
    """Metrics inserted twice: every group is there twice, as INSERT INTO leaves it."""
    target = new_folder(spark, "appended")
    metrics = rollups.TRADE_METRICS.query(_trades(spark, sf_dir))
    jobs.append_metrics(metrics, target)
    jobs.append_metrics(metrics, target)
    return spark.read.schema(TRADE_METRICS).parquet(target)


@query
def conform_schema(spark, sf_dir):
    """lineitem by other names, in other types and with other columns, as TRADES."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("Trade_Id"),
        F.col("l_partkey").alias("SYMBOL"),
        F.col("l_shipdate").cast("string").alias("trade_TS"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("AMOUNT"),
        F.col("l_tax").alias("not_declared"),
    )
    return conform(lines, TRADES)


# --- transforms --------------------------------------------------------------


@query
def positions_agg(spark, sf_dir):
    return enrich.positions_agg(_positions(spark, sf_dir))


@query
def enrich_trades(spark, sf_dir):
    return enrich.enrich_trades(_trades(spark, sf_dir), _positions(spark, sf_dir))


@query
def enrich_trades_sql(spark, sf_dir):
    return enrich.enrich_trades_sql(_trades(spark, sf_dir), _positions(spark, sf_dir))


@query
def enrich_stored(spark, sf_dir):
    """Enriched trades from tables that lie in matching buckets."""
    name = f"enriched_{uuid.uuid4().hex[:8]}"
    enrich.store_enriched(_trades(spark, sf_dir), _positions(spark, sf_dir), name, buckets=8)
    return enrich.read_enriched(spark, name)


@query
def enrich_procedure(spark, sf_dir):
    """What the procedure reports, and the rows it left in its target."""
    target = new_folder(spark, "procedure")
    message = jobs.enrich_job(spark, _trades(spark, sf_dir), _positions(spark, sf_dir), target)
    written = read_table(spark, target)
    return written.agg(
        F.lit(message).alias("status"),
        F.count(F.lit(1)).alias("row_count"),
        F.count("avg_market_price").alias("rows_with_context"),
    )


@query
def trade_metrics(spark, sf_dir):
    return rollups.TRADE_METRICS.query(_trades(spark, sf_dir))


@query
def market_event_summary(spark, sf_dir):
    return rollups.EVENT_SUMMARY.query(_events(spark, sf_dir))


@query
def position_summary(spark, sf_dir):
    return rollups.POSITION_SUMMARY.query(_positions(spark, sf_dir))


@query
def latest_price(spark, sf_dir):
    return enrich.latest_price(_positions(spark, sf_dir))


@query
def events_flattened(spark, sf_dir):
    return events.flatten(_events(spark, sf_dir))


@query
def order_event_join(spark, sf_dir):
    return events.order_events_with_trades(_events(spark, sf_dir), _trades(spark, sf_dir))


# --- change streams and task chains -------------------------------------------


@query
def changes_since(spark, sf_dir):
    """Trades a consumer that has seen the first batch has not seen."""
    root = deliveries.loaded_root(spark, sf_dir, "trades")
    consumer = f"late-{uuid.uuid4().hex[:8]}"
    changes.mark_seen(spark, root, consumer, {"trades_raw": 0})
    return changes.changes(spark, root, consumer, "trades_raw").select(*TRADES.names)


@query
def stream_status(spark, sf_dir):
    """Has-data of the three streams for a consumer that is done with trades."""
    root = deliveries.loaded_root(spark, sf_dir, *FEEDS)
    consumer = f"status-{uuid.uuid4().hex[:8]}"
    done = ingest.latest_batch(spark, root, "trades_raw")
    changes.mark_seen(spark, root, consumer, {"trades_raw": done})
    return changes.stream_status(
        spark, root, consumer, ["trades_raw", "market_events_raw", "positions_raw"]
    )


@query
def run_if_new(spark, sf_dir):
    """A gated step tried twice on the same data: it runs once."""
    root = deliveries.loaded_root(spark, sf_dir, "trades")
    consumer, target = f"gate-{uuid.uuid4().hex[:8]}", new_folder(spark, "gated")

    def step(session, at_root, upto):
        counted = ingest.raw_rows(session, at_root, "trades_raw", upto=upto).groupBy("side").agg(
            F.count(F.lit(1)).alias("trade_count")
        )
        counted.write.mode("overwrite").parquet(target)

    ran = [changes.run_if_new(spark, root, consumer, "trades_raw", step) for _ in range(2)]
    return spark.read.parquet(target).select(
        "side", "trade_count", F.lit(sum(ran)).alias("times_run")
    )


@query
def chain_enrich_metrics(spark, sf_dir):
    """Metrics published by the two-step chain, run on every batch that arrives."""
    root = new_folder(spark, "chain")
    deliveries.load_by_delivery(spark, sf_dir, "positions", root)
    deliveries.load_by_delivery(
        spark, sf_dir, "trades", root, then=lambda session, at, batch: jobs.run_chain(session, at)
    )
    return jobs.read_metrics(spark, root)


# --- maintained tables ---------------------------------------------------------


@query
def enrich_incremental(spark, sf_dir):
    """Enriched trades kept up with trades first, then with positions that change them."""
    root = new_folder(spark, "enriched-dt")
    table = refresh.TRADES_ENRICHED_DT
    for feed in ("trades", "positions"):
        deliveries.load_by_delivery(
            spark, sf_dir, feed, root, then=lambda session, at, batch: table.refresh(session, at)
        )
    return table.read(spark, root)


def _maintained(spark, sf_dir, table: refresh.RollupTable, feed: str) -> DataFrame:
    root = new_folder(spark, table.table.name)
    deliveries.load_by_delivery(
        spark, sf_dir, feed, root, then=lambda session, at, batch: table.refresh(session, at)
    )
    return table.read(spark, root)


@query
def metrics_incremental(spark, sf_dir):
    """Metrics kept on top of the enriched trades, which are kept on top of the loaded ones."""
    root = new_folder(spark, "metrics-dt")

    def refresh_both(session, at, batch):
        refresh.TRADES_ENRICHED_DT.refresh(session, at)
        refresh.TRADE_METRICS_DT.refresh(session, at)

    deliveries.load_by_delivery(spark, sf_dir, "trades", root, then=refresh_both)
    return refresh.TRADE_METRICS_DT.read(spark, root)


def _refreshed_as_due(spark, sf_dir, suspended: bool) -> DataFrame:
    """Which tables a due refresh took up, and how many rows each has taken in."""
    root = new_folder(spark, "due")
    for feed in ("trades", "positions"):
        deliveries.load_by_delivery(spark, sf_dir, feed, root)
    if suspended:
        refresh.suspend(spark, root, refresh.TRADE_METRICS_DT.table.name)
        refresh.suspend(spark, root, refresh.POSITION_SUMMARY_DT.table.name)
        refresh.suspend(spark, root, refresh.POSITION_SUMMARY_DT.table.name, suspended=False)
    refresh.refresh_due(spark, root)
    refresh.refresh_due(spark, root)  # nothing is due so soon
    tables = [made.table for made, _ in refresh.TARGET_LAGS]
    return reports.refresh_history(spark, root, tables).groupBy("name").agg(
        F.count(F.lit(1)).alias("refreshes"), F.sum("rows_taken").alias("rows_taken"))


@query
def lag_due(spark, sf_dir):
    return _refreshed_as_due(spark, sf_dir, suspended=False)


@query
def suspend_table(spark, sf_dir):
    return _refreshed_as_due(spark, sf_dir, suspended=True)


@query
def event_summary_incremental(spark, sf_dir):
    return _maintained(spark, sf_dir, refresh.MARKET_EVENT_SUMMARY_DT, "market_events")


@query
def position_summary_incremental(spark, sf_dir):
    return _maintained(spark, sf_dir, refresh.POSITION_SUMMARY_DT, "positions")


@query
def event_counts_live(spark, sf_dir):
    """Event counts by streaming state: the query ends after each batch and goes on from its checkpoint."""
    root = new_folder(spark, "events-live")
    deliveries.load_by_delivery(spark, sf_dir, "market_events", root, then=live.following(live.count_events))
    live.count_events(spark, root)  # nothing new
    return live.read(spark, root, live.EVENT_COUNTS)


@query
def account_counts_live(spark, sf_dir):
    """Different accounts per symbol by streaming state, with a batch stored anew in between."""
    root = new_folder(spark, "accounts-live")
    deliveries.load_by_delivery(spark, sf_dir, "positions", root, then=live.following(live.count_accounts))
    again = ingest.raw_rows(spark, root, "positions_raw", after=0, upto=1).drop("_batch")
    settled(again, new_folder(spark, "again")).write.mode("overwrite").parquet(f"{ingest.raw_path(root, 'positions_raw')}/_batch=1")
    live.count_accounts(spark, root)
    return live.read(spark, root, live.ACCOUNT_COUNTS)


@query
def full_refresh(spark, sf_dir):
    """Position summary: one incremental refresh, a full one, and a compaction."""
    table = refresh.POSITION_SUMMARY_DT
    root = new_folder(spark, "full")
    deliveries.load_by_delivery(spark, sf_dir, "positions", root)
    table.refresh(spark, root, upto=0)
    table.refresh_fully(spark, root)
    table.compact(spark, root)
    return table.read(spark, root)


@query
def upsert_enriched(spark, sf_dir):
    """Enriched trades, then the filled ones again with their status spelled out."""
    root = new_folder(spark, "upserted")
    folder = new_folder(spark, "enriched")  # written once, as it is read for each of the batches
    enriched = settled(enrich.enrich_trades(_trades(spark, sf_dir), _positions(spark, sf_dir)), folder)
    table = jobs.UpsertTable(parts=8, merge_after=2)
    table.upsert(spark, root, enriched, version=0)
    filled = enriched.where(F.col("status") == "F").withColumn("status", F.lit("filled"))
    table.upsert(spark, root, filled, version=1)
    table.upsert(spark, root, filled, version=1)
    table.upsert(spark, root, filled.where("pmod(hash(trade_id), 3) = 0"), version=2)
    remove_folder(spark, folder)
    return table.read(spark, root)


# --- reports -------------------------------------------------------------------

# The events table stands in for a log of runs.
_UNITS = ["click", "purchase", "view"]


def _run_log(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("unit"),
        F.col("ts").alias("start_time"),
        F.col("value").alias("credits_used"),
        F.col("value").alias("total_elapsed_ms"),
        (F.col("value") / 2).alias("execution_ms"),
    )


@query
def usage_top_recent(spark, sf_dir):
    top = reports.usage(_run_log(spark, sf_dir), _UNITS)
    return top.select("run_id", "unit", "start_time", "credits_used")


@query
def recent_window(spark, sf_dir):
    """The last day before the newest run."""
    runs = _run_log(spark, sf_dir)
    as_of = runs.agg(F.max("start_time")).first()[0]
    return reports.recent_activity(runs, _UNITS, as_of=as_of)


@query
def load_history(spark, sf_dir):
    """All files loaded into the three tables, summed up per delivery."""
    root = deliveries.loaded_root(spark, sf_dir, *FEEDS)
    logs = [reports.load_history(spark, root, f.table, n=None) for f in FEEDS.values()]
    files = logs[0].unionByName(logs[1]).unionByName(logs[2])
    return files.groupBy("table_name", _delivery("file_name").alias("delivery"), "status").agg(
        F.sum("row_count").alias("row_count")
    )


@query
def pipe_usage(spark, sf_dir):
    rows = reports.pipe_usage(spark, deliveries.loaded_root(spark, sf_dir, *FEEDS))
    return rows.groupBy("pipe_name").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("rows_inserted").alias("rows_inserted")
    )


@query
def pipe_status(spark, sf_dir):
    """The state of a trades pipe that has ended, as another session reads it."""
    stage, root = deliveries.stage_with(spark, sf_dir, "trades"), new_folder(spark, "status")
    ingest.load_new_files(spark, "trades", stage, root, files_per_batch=deliveries.files_per_delivery(spark))
    other, until = spark.newSession(), time.monotonic() + 60
    while True:  # the end of a query is told a moment later
        status = reports.pipe_status(other, root, "trades", stage)
        if status.first()["execution_state"] == "STOPPED" or time.monotonic() > until:
            break
        time.sleep(0.2)
    return status.select(
        "pipe_name", "execution_state", "healthy", "rows_inserted", "triggers", "files_failed", "files_pending",
        (F.col("files_per_trigger") * F.col("triggers") == F.col("files_seen")).alias("all_files_logged"))


@query
def load_history_sql(spark, sf_dir):
    """The load history by its SQL function, summed up per delivery."""
    own = spark.newSession()
    reports.register_load_history(own, deliveries.loaded_root(spark, sf_dir, *FEEDS))
    parts = [f"SELECT * FROM load_history(n => 1000000, tbl => '{f.table}', since => TIMESTAMP'2000-01-01')" for f in FEEDS.values()]
    files = own.sql(" UNION ALL ".join(parts))
    return files.groupBy("table_name", _delivery("file_name").alias("delivery"), "status").agg(F.sum("row_count").alias("row_count"))


def _root_with_lagging_tables(spark, sf_dir) -> str:
    root = new_folder(spark, "lagging")
    deliveries.load_by_delivery(spark, sf_dir, "positions", root)
    refresh.POSITION_SUMMARY_DT.refresh(spark, root, upto=0)
    refresh.POSITION_SUMMARY_DT.refresh(spark, root, upto=1)
    refresh.POSITION_CONTEXT.refresh(spark, root)
    return root


_LAGGING = [refresh.POSITION_SUMMARY_DT.table, refresh.POSITION_CONTEXT.table]
_NEVER = refresh.MaintainedTable("never_refreshed", "stage", POSITIONS, "0")


@query
def refresh_history(spark, sf_dir):
    root = _root_with_lagging_tables(spark, sf_dir)
    history = reports.refresh_history(spark, root, _LAGGING)
    return history.select(
        "name", "version", "refresh_action",
        F.col("inputs")["positions_raw"].alias("upto_batch"), "rows_taken",
        (F.col("refresh_end_time") >= F.col("refresh_start_time")).alias("finished"),
    )


@query
def table_lag(spark, sf_dir):
    root = _root_with_lagging_tables(spark, sf_dir)
    lag = reports.table_lag(spark, root, {t: ["positions_raw"] for t in [*_LAGGING, _NEVER]})
    return lag.select("name", "source", "batches_behind", "rows_behind", (F.col("seconds_behind") > 0).alias("late"))
