"""Reports over run, load and refresh logs.

Those of runs take any table with the columns of ``streaming.runs.RUN_LOG``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeflow.functions import before
from tradeflow.sources.formats import FEEDS
from tradeflow.schemas import RAW_TABLES
from tradeflow.streaming.ingest import LOAD_LOG, list_stage, load_log, load_log_path
from tradeflow.streaming.maintained import MaintainedTable
from tradeflow.streaming.progress import FAILED, STARTED, TOOK_IN, UNIT
from tradeflow.streaming.runs import run_log
from tradeflow.workspace import subfolders


def newest(rows: DataFrame, at: str, n: int, *tie_breaks: str) -> DataFrame:
    """The ``n`` newest rows. Unfinished ones, without a time, count as newest."""
    return rows.orderBy(F.col(at).desc_nulls_first(), *tie_breaks).limit(n)


def usage(runs: DataFrame, units: Iterable[str], n: int = 200) -> DataFrame:
    """What each compute unit used, newest first."""
    return newest(runs.where(F.col("unit").isin(list(units))), "start_time", n, "run_id")


def recent_activity(
    runs: DataFrame, units: Iterable[str], as_of: datetime | Column | None = None,
    days: int = 1, n: int = 200,
) -> DataFrame:
    """Runs of the last day with their milliseconds as seconds.

    For the run log, hand over ``run_log(spark, root, since)``: then only the days since then are opened.
    """
    since = before(as_of, days=days)
    recent = runs.where(F.col("unit").isin(list(units)) & (F.col("start_time") >= since))
    timed = recent.select(
        "run_id", "unit", "start_time",
        *[c for c in ("end_time", "step", "status") if c in recent.columns],
        (F.col("total_elapsed_ms") / 1000).alias("elapsed_sec"),
        (F.col("execution_ms") / 1000).alias("exec_sec"),
    )
    return newest(timed, "start_time", n, "run_id")


def load_history(
    spark: SparkSession, root: str, table: str, *,
    since: datetime | None = None, hours: int = 24, n: int | None = 20,
) -> DataFrame:
    """One row per loaded file of ``table``, by default of the last 24 hours."""
    start = F.lit(since) if since is not None else before(None, hours=hours)
    loaded = load_log(spark, root, table).where(F.col("last_load_time") >= start)
    rows = loaded.select("*", F.lit(table).alias("table_name"))
    return rows if n is None else newest(rows, "last_load_time", n, "file_name")


def pipe_usage(
    spark: SparkSession, root: str, feeds: Iterable[str] = tuple(FEEDS), n: int | None = 50
) -> DataFrame:
    """Files, bytes and rows each pipe brought in each run."""
    runs = [
        load_log(spark, root, FEEDS[feed].table)
        .groupBy("_batch")
        .agg(
            F.max("last_load_time").alias("start_time"),
            F.count(F.lit(1)).alias("files_inserted"),
            F.sum("file_size").alias("bytes_inserted"),
            F.sum("row_count").alias("rows_inserted"),
        )
        .withColumn("pipe_name", F.lit(f"{feed}_pipe"))
        for feed in feeds
    ]
    rows = reduce(DataFrame.unionByName, runs)
    return rows if n is None else newest(rows, "start_time", n, "pipe_name", "_batch")


def pipe_status(spark: SparkSession, root: str, feed_name: str, stage: str | None = None) -> DataFrame:
    """A pipe's state as one row, from the logs alone: the pipe may run in another session, or no more.

    Files per trigger are those of the triggers that found any. With ``stage``,
    ``files_pending`` are those in it that are in no load yet.
    """
    feed, name = FEEDS[feed_name], f"{feed_name}_pipe"
    log = load_log(spark, root, feed.table)
    told = run_log(spark, root).where((F.col("unit") == UNIT) & (F.col("step") == name))
    last = lambda c: F.max_by(c, F.struct("end_time", (F.col("status") != STARTED).cast("int")))
    took = F.col("status") == TOOK_IN
    runs = told.agg(
        last("status").alias("last"), F.max_by("detail", F.when(F.col("status") == FAILED, F.col("end_time"))).alias("last_error"),
        F.count(F.when(took, 1)).alias("triggers"), F.avg(F.when(took, F.col("row_count"))).alias("files_per_trigger"),
        F.max_by("row_count", F.when(took, F.col("end_time"))).alias("files_in_last_trigger"),
        F.max(F.when(took, F.col("end_time"))).alias("last_trigger_time")).first()
    pending = None
    if stage is not None:
        pending = list_stage(spark, feed, stage).join(log.select("file_name"), "file_name", "left_anti").count()
    state = "NEVER_STARTED" if runs["last"] is None else "RUNNING" if runs["last"] in (STARTED, TOOK_IN) else "STOPPED"
    return log.agg(
        F.lit(name).alias("pipe_name"), F.lit(state).alias("execution_state"), F.lit(runs["last"] != FAILED).alias("healthy"),
        F.lit(runs["last_error"]).cast("string").alias("last_error"), F.lit(runs["triggers"]).alias("triggers"),
        F.lit(runs["files_per_trigger"]).cast("double").alias("files_per_trigger"),
        F.lit(runs["files_in_last_trigger"]).cast("bigint").alias("files_in_last_trigger"),
        F.lit(runs["last_trigger_time"]).cast("timestamp").alias("last_trigger_time"), F.count(F.lit(1)).alias("files_seen"),
        F.coalesce(F.sum((F.col("status") == "FAILED").cast("long")), F.lit(0)).alias("files_failed"),
        F.lit(pending).cast("bigint").alias("files_pending"), F.sum("row_count").alias("rows_inserted"))


_HISTORY = "table_name STRING, file_name STRING, file_size BIGINT, row_count BIGINT, last_load_time TIMESTAMP, status STRING, error STRING"


def register_load_history(spark: SparkSession, root: str, name: str = "load_history") -> None:
    """Make the load history a SQL table function with named arguments.

    ``SELECT * FROM load_history(tbl => 'trades_raw', since => TIMESTAMP'...', n => 20)``: the newest files of
    a table, by default 20 of the last 24 hours. A call reads the logs as they are then.
    """
    columns = [c.split()[0] for c in _HISTORY.split(", ")]
    parts = []
    for table in RAW_TABLES:
        path = load_log_path(root, table)
        if not subfolders(spark, path):  # so that the function can name it; it holds no rows
            spark.createDataFrame([], StructType(LOAD_LOG.fields[:-1])).write.parquet(f"{path}/_batch=-1")
        quoted = path.replace("`", "``")
        parts.append(f"SELECT '{table}' AS table_name, {', '.join(columns[1:])} FROM parquet.`{quoted}`")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(
            tbl STRING, since TIMESTAMP DEFAULT current_timestamp() - INTERVAL 24 HOURS, n INT DEFAULT 20)
        RETURNS TABLE ({_HISTORY})
        RETURN SELECT {', '.join(columns)} FROM (
            SELECT *, row_number() OVER (ORDER BY last_load_time DESC, file_name) AS place
            FROM ({' UNION ALL '.join(parts)}) logs
            WHERE logs.table_name = lower({name}.tbl) AND logs.last_load_time >= {name}.since
        ) WHERE place <= {name}.n""")


def refresh_history(
    spark: SparkSession, root: str, tables: Iterable[MaintainedTable], n: int | None = 50
) -> DataFrame:
    """One row per refresh, with the loaded rows that were new to it."""
    logs = reduce(DataFrame.unionByName, [table.log(spark, root) for table in tables])
    rows = logs.drop("first_version")
    return rows if n is None else newest(rows, "refresh_end_time", n, "name", "version")


def table_lag(spark: SparkSession, root: str, tables: Mapping[MaintainedTable, Iterable[str]]) -> DataFrame:
    """How far each table is behind each RAW table it is made from.

    Seconds from the newest load it has taken in to the newest load there is;
    NULL if it has taken in none, though there are loads. A table that has
    everything has a lag of zero.
    """
    rows = []
    for table, sources in tables.items():
        reached = table.last_refresh(spark, root)["inputs"]
        for source in sources:
            upto = reached.get(source, -1)
            loads = load_log(spark, root, source)
            newer = F.col("_batch") > upto
            at = lambda some: F.max(F.when(some, F.unix_micros("last_load_time")))
            rows.append(loads.agg(
                F.count_distinct(F.when(newer, F.col("_batch"))).alias("batches_behind"),
                F.coalesce(F.sum(F.when(newer, F.col("row_count"))), F.lit(0)).alias("rows_behind"),
                (at(F.lit(True)) - at(~newer)).alias("_micros"),
            ).select(
                F.lit(table.name).alias("name"), F.lit(source).alias("source"), "batches_behind", "rows_behind",
                F.when(F.col("batches_behind") == 0, F.lit(0.0)).otherwise(F.col("_micros") / 1e6).alias("seconds_behind"),
            ))
    if not rows:
        return spark.createDataFrame([], "name string, source string, batches_behind bigint, rows_behind bigint, seconds_behind double")
    return reduce(DataFrame.unionByName, rows)
