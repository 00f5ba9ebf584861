"""Declared table schemas, and the cast every row passes before it is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

NUMBER = DecimalType(38, 0)
PRICE = DecimalType(18, 4)
MONEY = DecimalType(18, 2)
# A sum of MONEY over a whole market outgrows 18 digits, so sums are kept wide.
MONEY_SUM = DecimalType(38, 2)
PRICE_SUM = DecimalType(38, 4)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Column names, order and types of the three feeds.
TRADES = _table(
    trade_id=StringType(),
    account_id=StringType(),
    symbol=StringType(),
    trade_ts=TimestampNTZType(),
    side=StringType(),
    quantity=NUMBER,
    price=PRICE,
    amount=MONEY,
    exchange=StringType(),
    status=StringType(),
)
MARKET_EVENTS = _table(
    event_ts=TimestampNTZType(),
    symbol=StringType(),
    event_type=StringType(),
    event_attr=VariantType(),
)
POSITIONS = _table(
    symbol=StringType(),
    account_id=StringType(),
    quantity=NUMBER,
    avg_cost=PRICE,
    cost_basis=MONEY,
    current_price=PRICE,
    market_value=MONEY,
    unrealized_pnl=MONEY,
    updated_at=TimestampNTZType(),
)

# The derived tables.
POSITION_CONTEXT = _table(
    avg_market_price=PRICE,
    total_position_qty=NUMBER,
    total_market_value=MONEY_SUM,
)
TRADES_ENRICHED = StructType(TRADES.fields + POSITION_CONTEXT.fields)
# The declared target of the append job: narrower than the sums that feed it.
TRADE_METRICS = _table(
    trade_hour=TimestampNTZType(),
    symbol=StringType(),
    trade_count=LongType(),
    total_volume=NUMBER,
    total_notional=MONEY,
    avg_price=PRICE,
    buy_count=LongType(),
    sell_count=LongType(),
)

RAW_TABLES = {
    "trades_raw": TRADES,
    "market_events_raw": MARKET_EVENTS,
    "positions_raw": POSITIONS,
}
# What a loaded row carries besides the declared columns.
LINEAGE = _table(_src_file=StringType(), _load_ts=TimestampType())


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Shape ``df`` to ``schema``: names matched ignoring case, values cast.

    A declared column the input lacks becomes NULL and an undeclared one is
    dropped. A value that does not fit its type fails the job.
    """
    have = {field.name.lower(): field for field in df.schema.fields}
    columns = []
    for want in schema.fields:
        found = have.get(want.name.lower())
        if found is None:
            columns.append(F.lit(None).cast(want.dataType).alias(want.name))
        elif found.dataType == want.dataType:
            columns.append(F.col(f"`{found.name}`").alias(want.name))
        else:
            columns.append(F.col(f"`{found.name}`").cast(want.dataType).alias(want.name))
    return df.select(*columns)
