"""The benchmark's star-schema tables presented as the three feeds.

Every row of ``lineitem`` and ``events`` takes part. Decimals are only added
and multiplied, so another engine computes the same digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.operators.joins import lookup_join
from tradeflow.schemas import MARKET_EVENTS, POSITIONS, TRADES, conform
from tradeflow.workspace import new_folder, settled

_TRADE_ID = """concat_ws('-', 'TRD', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                          CAST(l_shipdate AS DATE))"""
# l_shipdate is always midnight; spread the trades over the day.
_TRADE_TS = """l_shipdate + make_dt_interval(
    0, 0, 0, CAST((l_orderkey * 7919 + l_linenumber * 613) % 86400 AS DECIMAL(18, 6)))"""
# Some trades and their order events arrive without a time.
_FEED_TS = f"CASE WHEN l_orderkey % 97 <> 0 THEN {_TRADE_TS} END"


# What has been written, by application, tables and name.
_written: dict[tuple[str, str, str], str] = {}
_ORDER_LINES = "order_lines"


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, sf_dir, name


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(rows: DataFrame) -> DataFrame:
    """Give all cores work when fewer tasks would read the input; a large file is read by many as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    few = rows.rdd.getNumPartitions() < cores
    return rows.repartition(cores, *rows.columns) if few else rows


def _orders_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their orders. What follows from a line's columns is made after its joins, so it is not shuffled."""
    kept = _written.get(_key(spark, sf_dir, _ORDER_LINES))
    if kept:
        return spark.read.parquet(kept)
    lines = _spread(
        _table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_returnflag", "l_linestatus", "l_shipdate",
        )
    )
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus"
    )
    return lookup_join(
        lines, orders, "l_orderkey", "inner", spread_by="l_partkey",
        key_source=_table(spark, sf_dir, "lineitem"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_type", "p_retailprice"
    )
    lines = lookup_join(
        _orders_of_lines(spark, sf_dir), part, "l_partkey", "inner", spread_by="l_orderkey",
        key_source=_table(spark, sf_dir, "lineitem"),
    )
    symbol = F.col("l_partkey").cast("string")
    quantity = F.col("l_quantity").cast("decimal(9,0)")
    return conform(
        lines.select(
            F.expr(_TRADE_ID).alias("trade_id"),
            F.col("o_custkey").alias("account_id"),
            # A when-issued symbol, which no position is held in.
            F.when(F.col("p_type") == "PROMO", F.concat(symbol, F.lit("-WI")))
            .otherwise(symbol)
            .alias("symbol"),
            F.expr(_FEED_TS).alias("trade_ts"),
            F.when(F.col("l_returnflag") == "A", "BUY")
            .when(F.col("l_returnflag") == "R", "SELL")
            .alias("side"),
            quantity.alias("quantity"),
            F.col("p_retailprice").cast("decimal(18,4)").alias("price"),
            (quantity * F.col("p_retailprice").cast("decimal(9,2)")).alias("amount"),
            F.col("l_linestatus").alias("exchange"),
            F.col("o_orderstatus").alias("status"),
        ),
        TRADES,
    )


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = (
        _table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(
            # Whole numbers of 18 digits at most; summed as such, a group is half as wide.
            F.sum(F.col("l_quantity").cast("decimal(18,0)").cast("bigint")).cast("decimal(18,0)").alias("quantity"),
            F.max(F.expr(_TRADE_TS)).alias("updated_at"),
        )
    )
    part = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_retailprice").cast("decimal(9,2)").alias("avg_cost"),
    )
    priced = lookup_join(
        held, part, "l_partkey", "inner", spread_by="l_suppkey",
        key_source=_table(spark, sf_dir, "lineitem"),
    )
    gain = (F.col("l_suppkey") % 7).cast("decimal(9,0)") * F.lit("0.13").cast("decimal(9,2)")
    current_price = (F.col("avg_cost") + gain).cast("decimal(18,4)")
    return conform(
        priced.select(
            F.col("l_partkey").alias("symbol"),
            F.col("l_suppkey").alias("account_id"),
            "quantity",
            "avg_cost",
            (F.col("quantity") * F.col("avg_cost")).alias("cost_basis"),
            current_price.alias("current_price"),
            (F.col("quantity") * current_price).alias("market_value"),
            (F.col("quantity") * (current_price - F.col("avg_cost"))).alias("unrealized_pnl"),
            "updated_at",
        ),
        POSITIONS,
    )


def market_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``events`` as a market signal, and one order event per trade."""
    signals = _table(spark, sf_dir, "events").select(
        F.col("ts").alias("event_ts"),
        F.col("user_id").alias("symbol"),
        "event_type",
        F.to_json(
            F.struct(
                F.lit("market_data").alias("source"),
                F.col("event_type").alias("alert_type"),
                F.col("event_type").alias("priority"),
                F.to_date("ts").cast("string").alias("ex_date"),
                *[F.get_json_object("props", "$.k").cast("int").alias(n)
                  for n in ("threshold_price", "eps_estimate", "surprise_pct", "required_amount")],
                *[F.col("value").alias(n) for n in ("current_price", "dividend_amount", "eps_actual")],
            )
        ).alias("event_attr"),
    )
    orders = _orders_of_lines(spark, sf_dir).select(
        F.expr(_FEED_TS).alias("event_ts"),
        F.col("l_partkey").cast("string").alias("symbol"),
        F.when(F.col("o_orderstatus") == "F", "order_filled")
        .when(F.col("o_orderstatus") == "O", "order_placed")
        .otherwise("order_cancelled")
        .alias("event_type"),
        F.to_json(
            F.struct(
                F.lit("trading_system").alias("source"),
                F.expr(_TRADE_ID).alias("trade_id"),
                F.col("o_custkey").cast("string").alias("account_id"),
            )
        ).alias("event_attr"),
    )
    both = conform(signals, orders.schema).unionByName(orders)
    return conform(both.withColumn("event_attr", F.parse_json("event_attr")), MARKET_EVENTS)


_BUILDERS = {
    "trades_raw": trades,
    "positions_raw": positions,
    "market_events_raw": market_events,
}
_SCHEMAS = {"trades_raw": TRADES, "positions_raw": POSITIONS, "market_events_raw": MARKET_EVENTS}


def _write_once(spark: SparkSession, sf_dir: str, name: str, rows: Callable[[SparkSession, str], DataFrame]) -> str:
    key = _key(spark, sf_dir, name)
    if key not in _written:
        folder = new_folder(spark, name)
        settled(rows(spark, sf_dir), folder)
        _written[key] = folder
    return _written[key]


def is_written(spark: SparkSession, sf_dir: str, table: str) -> bool:
    return _key(spark, sf_dir, table) in _written


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A RAW table as it would stand after loading, written once per application."""
    folder = _write_once(spark, sf_dir, table, _BUILDERS[table])
    return spark.read.schema(_SCHEMAS[table]).parquet(folder)


def built_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The rows of a RAW table for a job that writes them elsewhere, in parts.

    Only what the parts would each shuffle anew is written: lines with their orders, once for all tables made of them.
    """
    if table != "positions_raw":
        _write_once(spark, sf_dir, _ORDER_LINES, _orders_of_lines)
    return _BUILDERS[table](spark, sf_dir)
