"""Trades with the position context of their symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.operators.joins import BROADCAST_BYTES, lookup_join, store_lookup, store_rows, stored_join
from tradeflow.operators.rollups import POSITION_CONTEXT
from tradeflow.schemas import POSITION_CONTEXT as CONTEXT_COLUMNS
from tradeflow.schemas import TRADES
from tradeflow.workspace import new_folder, settled

def positions_agg(positions: DataFrame) -> DataFrame:
    return POSITION_CONTEXT.query(positions)


def with_context(
    trades: DataFrame, context: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Every trade once, with its symbol's context or NULLs.

    ``context`` holds a symbol once, so the left join cannot multiply trades,
    and a NULL symbol matches nothing.
    """
    joined = lookup_join(trades, context, "symbol", "left", spread_by="trade_id", limit=limit)
    return joined.select(*TRADES.names, *CONTEXT_COLUMNS.names)


def enrich_trades(trades: DataFrame, positions: DataFrame) -> DataFrame:
    """DataFrame form. The context is written first so that its size is known."""
    spark = trades.sparkSession
    context = settled(positions_agg(positions), new_folder(spark, "positions-agg"))
    return with_context(trades, context)


def enrich_trades_sql(trades: DataFrame, positions: DataFrame) -> DataFrame:
    """SQL form, from the same definitions; adaptive execution picks the join and splits hot symbols."""
    spark = trades.sparkSession
    sums = ", ".join(
        f"CAST({sql} AS {kind.simpleString()}) AS {name}" for name, (sql, kind) in POSITION_CONTEXT.measures.items())
    partial = spark.sql(f"SELECT symbol, {sums} FROM {{positions}} GROUP BY symbol", positions=positions)
    columns = ", ".join([*TRADES.names, *CONTEXT_COLUMNS.names])
    return spark.sql(
        f"SELECT {columns} FROM {{trades}} LEFT JOIN {{context}} USING (symbol)",
        trades=trades, context=POSITION_CONTEXT.publish(partial),
    )


def store_enriched(trades: DataFrame, positions: DataFrame, name: str, buckets: int) -> None:
    """Trades and the context of their symbols as two tables, ``<name>_trades`` and ``<name>_context``, in matching buckets."""
    store_rows(trades.select(*TRADES.names), "symbol", f"{name}_trades", spread_by="trade_id", buckets=buckets)
    store_context(positions, name, buckets)


def store_context(positions: DataFrame, name: str, buckets: int) -> None:
    """A new context beside the stored trades, which stay as they are."""
    store_lookup(positions_agg(positions), "symbol", f"{name}_context", beside=f"{name}_trades", buckets=buckets)


def read_enriched(spark: SparkSession, name: str) -> DataFrame:
    """Every stored trade with its context; no side is shuffled, however large."""
    return stored_join(spark, f"{name}_trades", f"{name}_context", "symbol").select(*TRADES.names, *CONTEXT_COLUMNS.names)


def latest_price(positions: DataFrame) -> DataFrame:
    """Each symbol's price at its newest update; the higher one if two tie.

    NULLs for a symbol of which no position has both a price and a time.
    """
    known = F.col("updated_at").isNotNull() & F.col("current_price").isNotNull()
    newest = positions.groupBy("symbol").agg(
        F.max(F.when(known, F.struct("updated_at", "current_price"))).alias("newest"))
    return newest.select(
        "symbol", F.col("newest.current_price").alias("latest_price"), F.col("newest.updated_at").alias("priced_at"))
