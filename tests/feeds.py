"""Small feeds made by hand or at random, and ways to land and compare them."""

import json
import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from tradeflow.schemas import MARKET_EVENTS, POSITIONS, TRADES

SYMBOLS = ["QRX", "LMN", "ETF1", "BOND-7", "UNHELD", None]


def bag(df, *columns):
    """The rows as a multiset, so that order does not matter and repeats do."""
    rows = df.select(*columns) if columns else df
    return Counter(tuple(row) for row in rows.collect())


def trade(**over):
    row = dict(
        trade_id="T1", account_id="K-0001", symbol="QRX",
        trade_ts=datetime(2025, 11, 3, 9, 41, 27), side="BUY", quantity=Decimal(100),
        price=Decimal("47.2500"), amount=Decimal("4725.00"), exchange="XETR", status="filled",
    )
    row.update(over)
    return tuple(row[name] for name in TRADES.names)


def position(**over):
    row = dict(
        symbol="QRX", account_id="K-0001", quantity=Decimal(10), avg_cost=Decimal("100.0000"),
        cost_basis=Decimal("1000.00"), current_price=Decimal("110.0000"),
        market_value=Decimal("1100.00"), unrealized_pnl=Decimal("100.00"),
        updated_at=datetime(2025, 11, 3, 8, 0),
    )
    row.update(over)
    return tuple(row[name] for name in POSITIONS.names)


def trades(spark, *rows):
    return spark.createDataFrame(list(rows), TRADES)


def positions(spark, *rows):
    return spark.createDataFrame(list(rows), POSITIONS)


def random_trades(rng: random.Random, n: int, batch: int, hot: str | None = None):
    rows = []
    for i in range(n):
        quantity, cents = rng.randint(10, 1000), rng.randint(100, 90000)
        symbol = hot if hot and rng.random() < 0.4 else rng.choice(SYMBOLS)
        rows.append(
            trade(
                trade_id=f"TRD-{batch:03d}-{i:04d}", account_id=f"K-{rng.randint(1, 9):04d}",
                symbol=symbol, side=rng.choice(["BUY", "SELL", "buy", None]),
                trade_ts=datetime(2026, 1, 30, 22) + timedelta(seconds=rng.randint(0, 5 * 3600)),
                quantity=Decimal(quantity), price=Decimal(cents) / 100,
                amount=Decimal(quantity * cents) / 100,
                status=rng.choice(["pending", "filled", "cancelled", "rejected"]),
            )
        )
    return rows


def random_positions(rng: random.Random, n: int):
    rows = []
    for _ in range(n):
        quantity, cost, now = rng.randint(1, 500), rng.randint(100, 9000), rng.randint(100, 9000)
        rows.append(
            position(
                symbol=rng.choice([s for s in SYMBOLS if s != "UNHELD"]),
                account_id=rng.choice(["K-0001", "K-0002", "K-0003", None]),
                quantity=Decimal(quantity), avg_cost=Decimal(cost) / 100,
                cost_basis=Decimal(quantity * cost) / 100, current_price=Decimal(now) / 100,
                market_value=Decimal(quantity * now) / 100,
                unrealized_pnl=Decimal(quantity * (now - cost)) / 100,
            )
        )
    return rows


def random_events(rng: random.Random, n: int):
    return [
        {
            "EVENT_TS": str(datetime(2026, 1, 30, 22) + timedelta(seconds=rng.randint(0, 9000))),
            "SYMBOL": rng.choice(SYMBOLS),
            "EVENT_TYPE": rng.choice(["order_filled", "price_alert", None]),
            "EVENT_ATTR": {"source": "market_data", "trade_id": f"TRD-001-{i:04d}"},
        }
        for i in range(n)
    ]


def land_trades(stage, name, rows):
    Path(stage).mkdir(parents=True, exist_ok=True)
    text = [",".join(TRADES.names).upper()]
    text += [",".join("" if v is None else str(v) for v in row) for row in rows]
    Path(stage, name).write_text("\n".join(text) + "\n")


def land_events(stage, name, rows):
    Path(stage).mkdir(parents=True, exist_ok=True)
    Path(stage, name).write_text(json.dumps(rows, indent=2))


def land_positions(stage, name, rows):
    """As the feed is written elsewhere: doubles, and the time as text."""
    Path(stage).mkdir(parents=True, exist_ok=True)
    def column(name, values):
        if name in ("symbol", "account_id"):
            return pa.array(values, pa.string())
        if name == "updated_at":
            return pa.array([str(v) for v in values], pa.string())
        if name == "quantity":
            return pa.array([int(v) for v in values], pa.int64())
        return pa.array([float(v) for v in values], pa.float64())

    columns = dict(zip(POSITIONS.names, zip(*rows)))
    table = pa.table({n.upper(): column(n, list(vs)) for n, vs in columns.items()})
    pq.write_table(table, Path(stage, name))


def events_frame(spark, rows):
    from pyspark.sql import functions as F

    flat = [(r["EVENT_TS"], r["SYMBOL"], r["EVENT_TYPE"], json.dumps(r["EVENT_ATTR"])) for r in rows]
    df = spark.createDataFrame(flat, "event_ts string, symbol string, event_type string, attr string")
    return df.select(
        F.col("event_ts").cast("timestamp_ntz"), "symbol", "event_type",
        F.parse_json("attr").alias("event_attr"),
    ).to(MARKET_EVENTS)
