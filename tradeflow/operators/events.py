"""Reading inside the semi-structured attributes of market events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.operators.joins import lookup_join
from tradeflow.workspace import new_folder, settled

# The attribute keys events carry, and the type each is read as.
ATTRIBUTES = {
    "source": "string",
    "priority": "string",
    "alert_type": "string",
    "threshold_price": "decimal(18,4)",
    "current_price": "decimal(18,4)",
    "trade_id": "string",
    "account_id": "string",
    "dividend_amount": "decimal(18,4)",
    "ex_date": "date",
    "eps_actual": "decimal(18,4)",
    "eps_estimate": "decimal(18,4)",
    "surprise_pct": "decimal(18,4)",
    "required_amount": "decimal(18,2)",
}


def flatten(events: DataFrame) -> DataFrame:
    """One typed column per attribute; NULL where an event lacks it."""
    return events.select(
        "event_ts",
        "symbol",
        "event_type",
        *[
            F.try_variant_get("event_attr", f"$.{key}", kind).alias(key)
            for key, kind in ATTRIBUTES.items()
        ],
    )


def order_events_with_trades(events: DataFrame, trades: DataFrame) -> DataFrame:
    """Order events next to the trade they name, NULLs where it is unknown."""
    # The event types that name a trade.
    order_types = ["order_placed", "order_filled", "order_cancelled"]
    orders = events.where(F.col("event_type").isin(order_types)).select(
        "event_ts",
        "event_type",
        F.try_variant_get("event_attr", "$.trade_id", "string").alias("trade_id"),
    )
    spark = events.sparkSession
    # Both sides are read, and events parsed, once; what decides on the join looks at what was written.
    orders = settled(orders, new_folder(spark, "order-events"))
    # A trade delivered twice must not double its events.
    columns = ["symbol", "side", "quantity", "amount", "status"]
    known = trades.groupBy("trade_id").agg(F.max(F.struct(*columns)).alias("t")).select("trade_id", "t.*")
    known = settled(known, new_folder(spark, "known-trades"))
    return lookup_join(orders, known, "trade_id", "left", spread_by="event_ts")
