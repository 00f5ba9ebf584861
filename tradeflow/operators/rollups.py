"""The four aggregates, each defined once for batch and incremental use.

A rollup turns rows into *partial* rows that can be added together: counts,
sums, and the sum and count behind each mean. Partial rows of several batches
``merge`` into the partial rows of their union, and ``publish`` turns partial
rows into the columns a reader wants. So the whole-table query is
``publish(partial(rows))`` and the incremental one is
``publish(merge(partials of each batch))``, with the same digits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tradeflow.functions import exact_mean, hour_of
from tradeflow.schemas import MONEY_SUM, NUMBER, PRICE_SUM


@dataclass(frozen=True)
class Rollup:
    """Keys and measures are SQL over the rows, each with the type it is kept in."""

    keys: dict[str, tuple[str, DataType]]
    measures: dict[str, tuple[str, DataType]]
    publish: Callable[[DataFrame], DataFrame]

    @property
    def schema(self) -> StructType:
        columns = {**self.keys, **self.measures}
        return StructType([StructField(n, kind) for n, (_, kind) in columns.items()])

    def partial(self, rows: DataFrame) -> DataFrame:
        keys = [F.expr(key).alias(n) for n, (key, _) in self.keys.items()]
        return rows.groupBy(*keys).agg(
            *[F.expr(sql).cast(kind).alias(n) for n, (sql, kind) in self.measures.items()]
        )

    def merge(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy(*self.keys).agg(
            *[F.sum(n).cast(kind).alias(n) for n, (_, kind) in self.measures.items()]
        )

    def query(self, rows: DataFrame) -> DataFrame:
        return self.publish(self.partial(rows))


TRADE_METRICS = Rollup(
    keys={
        "trade_hour": (hour_of("trade_ts"), TimestampNTZType()),
        "symbol": ("symbol", StringType()),
    },
    measures={
        "trade_count": ("count(*)", LongType()),
        "total_volume": ("sum(quantity)", NUMBER),
        "total_notional": ("sum(amount)", MONEY_SUM),
        "price_sum": ("sum(price)", PRICE_SUM),
        "price_count": ("count(price)", LongType()),
        "buy_count": ("sum(CASE WHEN side = 'BUY' THEN 1 ELSE 0 END)", LongType()),
        "sell_count": ("sum(CASE WHEN side = 'SELL' THEN 1 ELSE 0 END)", LongType()),
    },
    publish=lambda partials: partials.select(
        "trade_hour",
        "symbol",
        "trade_count",
        "total_volume",
        "total_notional",
        exact_mean(F.col("price_sum"), F.col("price_count")).alias("avg_price"),
        "buy_count",
        "sell_count",
    ),
)

EVENT_SUMMARY = Rollup(
    keys={
        "event_hour": (hour_of("event_ts"), TimestampNTZType()),
        "symbol": ("symbol", StringType()),
        "event_type": ("event_type", StringType()),
    },
    measures={"event_count": ("count(*)", LongType())},
    publish=lambda partials: partials.select("event_hour", "symbol", "event_type", "event_count"),
)

# Average price and holdings per symbol: the context trades are enriched with.
POSITION_CONTEXT = Rollup(
    keys={"symbol": ("symbol", StringType())},
    measures={
        "price_sum": ("sum(current_price)", PRICE_SUM),
        "price_count": ("count(current_price)", LongType()),
        "total_position_qty": ("sum(quantity)", NUMBER),
        "total_market_value": ("sum(market_value)", MONEY_SUM),
    },
    publish=lambda partials: partials.select(
        "symbol",
        exact_mean(F.col("price_sum"), F.col("price_count")).alias("avg_market_price"),
        "total_position_qty",
        "total_market_value",
    ),
)


def _publish_positions(partials: DataFrame) -> DataFrame:
    # One row per (symbol, account), so counting accounts counts distinct ones.
    # A symbol held by very many accounts is combined before it is shuffled.
    return partials.groupBy("symbol").agg(
        F.count("account_id").alias("account_count"),
        F.sum("total_shares").alias("total_shares"),
        F.sum("total_cost_basis").cast(MONEY_SUM).alias("total_cost_basis"),
        F.sum("total_market_value").cast(MONEY_SUM).alias("total_market_value"),
        F.sum("total_unrealized_pnl").cast(MONEY_SUM).alias("total_unrealized_pnl"),
        exact_mean(F.sum("price_sum"), F.sum("price_count")).alias("avg_current_price"),
    )


POSITION_SUMMARY = Rollup(
    keys={
        "symbol": ("symbol", StringType()),
        "account_id": ("account_id", StringType()),
    },
    measures={
        "total_shares": ("sum(quantity)", NUMBER),
        "total_cost_basis": ("sum(cost_basis)", MONEY_SUM),
        "total_market_value": ("sum(market_value)", MONEY_SUM),
        "total_unrealized_pnl": ("sum(unrealized_pnl)", MONEY_SUM),
        "price_sum": ("sum(current_price)", PRICE_SUM),
        "price_count": ("count(current_price)", LongType()),
    },
    publish=_publish_positions,
)
