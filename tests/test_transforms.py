"""Hand-made rows for the semantics that are easy to get wrong."""

import random
from datetime import datetime
from decimal import Decimal

import duckdb
import pytest
from feeds import bag, position, positions, random_positions, random_trades, trade, trades
from pyspark.sql import functions as F

from tradeflow.functions import exact_mean, hour_of
from tradeflow.operators import enrich, events, joins, rollups

METRICS = rollups.TRADE_METRICS
D = Decimal


def metrics_of(spark, *rows):
    return {(r["trade_hour"], r["symbol"]): r for r in METRICS.query(trades(spark, *rows)).collect()}


def test_hour_edges(spark):
    found = metrics_of(
        spark,
        trade(trade_ts=datetime(2025, 11, 3, 9, 59, 59, 999999)),
        trade(trade_ts=datetime(2025, 11, 3, 10, 0, 0)),
    )
    assert sorted(found) == [(datetime(2025, 11, 3, 9), "QRX"), (datetime(2025, 11, 3, 10), "QRX")]


def test_hour_that_the_session_zone_skips(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.sql("SELECT TIMESTAMP_NTZ '2026-03-08 02:30:15.5' AS ts").select(
            F.expr(hour_of("ts")).cast("string")
        )
        assert row.first()[0] == "2026-03-08 02:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_odd_sides_count_as_trades_only(spark):
    found = metrics_of(spark, trade(), trade(side="buy"), trade(side=None), trade(side="SELL"))
    (row,) = found.values()
    assert (row["trade_count"], row["buy_count"], row["sell_count"]) == (4, 1, 1)


def test_cancelled_trades_count(spark):
    found = metrics_of(spark, trade(status="cancelled"), trade(status="rejected"))
    assert next(iter(found.values()))["trade_count"] == 2


def test_null_symbol_and_null_hour_are_groups(spark):
    found = metrics_of(spark, trade(symbol=None), trade(trade_ts=None), trade(symbol=None))
    assert found[(datetime(2025, 11, 3, 9), None)]["trade_count"] == 2
    assert found[(None, "QRX")]["trade_count"] == 1


def test_sums_of_only_nulls_are_null(spark):
    (row,) = metrics_of(spark, trade(quantity=None, price=None, amount=None)).values()
    assert row["total_volume"] is None and row["avg_price"] is None and row["trade_count"] == 1


@pytest.mark.parametrize(
    "prices, mean",
    [
        (["1.0000", "1.0001"], "1.0001"),  # 1.00005 rounds up
        (["1.0000", "1.0000", "1.0001"], "1.0000"),
        (["0.0000"] * 10000 + ["0.4999"], "0.0000"),
    ],
)
def test_mean_rounds_half_up_once(spark, prices, mean):
    rows = spark.createDataFrame([(D(p),) for p in prices], "p decimal(18,4)")
    assert rows.agg(exact_mean(F.sum("p"), F.count("p"))).first()[0] == D(mean)


def test_unmatched_and_null_symbols_keep_their_trade(spark):
    held = positions(spark, position(), position(symbol=None))
    rows = trades(spark, trade(), trade(trade_id="T2", symbol="NONE"), trade(trade_id="T3", symbol=None))
    for found in (enrich.enrich_trades(rows, held), enrich.enrich_trades_sql(rows, held)):
        assert bag(found, "trade_id", "total_position_qty") == {
            ("T1", D(10)): 1, ("T2", None): 1, ("T3", None): 1,
        }


def test_many_positions_of_a_symbol_do_not_multiply_trades(spark):
    held = positions(spark, *[position(account_id=f"A{i}", current_price=D(i)) for i in range(3)])
    found = enrich.enrich_trades(trades(spark, trade()), held).collect()
    assert [(r["avg_market_price"], r["total_position_qty"]) for r in found] == [(D("1.0000"), D(30))]


def test_same_holding_twice_adds_up(spark):
    (row,) = rollups.POSITION_SUMMARY.query(positions(spark, position(), position())).collect()
    assert (row["account_count"], row["total_shares"]) == (1, D(20))


def test_accounts_are_counted_distinct_and_null_not_at_all(spark):
    held = [position(account_id=a) for a in ("A", "B", "A", None, None)]
    (row,) = rollups.POSITION_SUMMARY.query(positions(spark, *held)).collect()
    assert (row["account_count"], row["total_shares"]) == (2, D(50))


def test_latest_price_prefers_newest_then_highest(spark):
    late = datetime(2026, 2, 1)
    held = positions(
        spark, position(current_price=D(900)), position(current_price=D(5), updated_at=late),
        position(current_price=D(7), updated_at=late), position(updated_at=None, current_price=D(99)),
    )
    assert bag(enrich.latest_price(held)) == {("QRX", D("7.0000"), late): 1}


def test_event_attributes_by_type(spark):
    rows = [
        ("earnings_release", '{"eps_actual": 4.25, "surprise_pct": -3.66, "source": "market_data"}'),
        ("dividend_announced", '{"dividend_amount": 0.5, "ex_date": "2026-02-01"}'),
        ("margin_call", '{"account_id": "A", "required_amount": 10000.126}'),
        ("corporate_action", "{}"),
        ("price_alert", '{"threshold_price": "not a number"}'),
    ]
    df = spark.createDataFrame(rows, "event_type string, attr string").select(
        F.lit(None).cast("timestamp_ntz").alias("event_ts"), F.lit("QRX").alias("symbol"),
        "event_type", F.parse_json("attr").alias("event_attr"),
    )
    found = {r["event_type"]: r for r in events.flatten(df).collect()}
    assert found["earnings_release"]["eps_actual"] == D("4.2500")
    assert found["earnings_release"]["surprise_pct"] == D("-3.6600")
    assert str(found["dividend_announced"]["ex_date"]) == "2026-02-01"
    assert found["margin_call"]["required_amount"] == D("10000.13")
    assert found["corporate_action"]["source"] is None
    assert found["price_alert"]["threshold_price"] is None


# --- the lookup join ------------------------------------------------------------


@pytest.fixture
def no_planned_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def skewed(spark, n=30000):
    """A third of the rows share one key, a third have none."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 3 == 1, F.concat(F.lit("K"), F.col("id") % 500))
        .alias("k"),
        F.concat(F.lit("T"), "id").alias("trade_id"),
    )


def lookup_of(spark):
    return spark.range(400).select(
        F.concat(F.lit("K"), "id").alias("k"), F.col("id").alias("v")
    ).union(spark.sql("SELECT 'HOT', -1L")).union(spark.sql("SELECT CAST(NULL AS STRING), -2L"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, no_planned_broadcast, how):
    rows, lookup = skewed(spark), lookup_of(spark)
    found = joins.lookup_join(rows, lookup, "k", how, spread_by="trade_id", limit=0)
    assert found.columns == ["k", "trade_id", "v"]
    assert bag(found) == bag(rows.join(lookup, "k", how).select("k", "trade_id", "v"))


def test_salt_spreads_the_hot_and_the_missing_key(spark, no_planned_broadcast):
    rows, lookup = skewed(spark), lookup_of(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = joins.lookup_join(rows, lookup, "k", "left", spread_by="trade_id", limit=0)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "SortMergeJoin" in found._jdf.queryExecution().toString()
    assert max(sizes) < 30000 / 4


def test_frequent_keys_are_those_above_an_even_share(spark):
    ((key, salts),) = joins.frequent_keys(skewed(spark), "k", 8)
    assert key == "HOT" and 25 < salts < 40
    assert joins.frequent_keys(spark.range(30000), "id", 8) == []
    assert joins.frequent_keys(spark.range(0), "id", 8) == []


def test_broadcast_only_below_the_limit(spark):
    small = spark.range(10).select("id", F.repeat(F.lit("x"), 100).alias("text"))
    assert joins.fits_broadcast(small, 10 * (2 * 24 + 16 + 100))
    assert not joins.fits_broadcast(small, 10 * (2 * 24 + 16 + 100) - 1)
    assert not joins.fits_broadcast(small, 0)
    assert not joins.fits_broadcast(small.select(F.array("id").alias("a")))


def test_enrich_by_shuffle_equals_enrich_by_broadcast(spark, no_planned_broadcast):
    rng = random.Random(5)
    rows = trades(spark, *random_trades(rng, 400, 1, hot="QRX"))
    context = enrich.positions_agg(positions(spark, *random_positions(rng, 60)))
    assert bag(enrich.with_context(rows, context, limit=0)) == bag(enrich.with_context(rows, context))


# --- random feeds against another engine -------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_random_feeds_equal_sql(spark, seed):
    rng = random.Random(seed)
    rows = trades(spark, *random_trades(rng, 500, 1, hot="QRX"))
    held = positions(spark, *random_positions(rng, 80))
    con = duckdb.connect()
    con.register("trades", rows.toArrow())
    con.register("positions", held.toArrow())
    want = con.execute("""
        SELECT date_trunc('hour', trade_ts), symbol, count(*), sum(quantity), sum(amount),
               CAST(sum(CASE WHEN side = 'BUY' THEN 1 ELSE 0 END) AS BIGINT),
               CAST(sum(CASE WHEN side = 'SELL' THEN 1 ELSE 0 END) AS BIGINT)
        FROM trades GROUP BY ALL""").fetchall()
    assert bag(METRICS.query(rows).drop("avg_price")) == bag_of(want)
    want = con.execute("""
        SELECT trade_id, p.q, p.v FROM trades t LEFT JOIN
          (SELECT symbol, sum(quantity) q, sum(market_value) v FROM positions GROUP BY symbol) p
        ON p.symbol = t.symbol""").fetchall()
    found = enrich.enrich_trades(rows, held)
    assert bag(found, "trade_id", "total_position_qty", "total_market_value") == bag_of(want)
    want = con.execute("""
        SELECT symbol, count(DISTINCT account_id), sum(quantity), sum(cost_basis),
               sum(market_value), sum(unrealized_pnl) FROM positions GROUP BY symbol""").fetchall()
    assert bag(rollups.POSITION_SUMMARY.query(held).drop("avg_current_price")) == bag_of(want)


def bag_of(rows):
    from collections import Counter

    return Counter(tuple(row) for row in rows)


def test_stored_by_key_joins_without_a_shuffle(spark):
    rng = random.Random(21)
    rows = trades(spark, *random_trades(rng, 3000, 1, hot="QRX"))
    held = positions(spark, *random_positions(rng, 40))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        enrich.store_enriched(rows, held, "kept", 8)
        found = enrich.read_enriched(spark, "kept")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert bag(found) == bag(enrich.enrich_trades(rows, held))
        salts = spark.table("kept_trades").where("symbol = 'QRX'").select("_salt").distinct().count()
        assert salts > 8 and spark.table("kept_trades").where("symbol is null").select("_salt").distinct().count() > 8
        more = held.unionByName(positions(spark, position(symbol="UNHELD"), position(symbol="NEW")))
        enrich.store_context(more, "kept", 8)
        assert bag(enrich.read_enriched(spark, "kept")) == bag(enrich.enrich_trades(rows, more))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for table in ("kept_trades", "kept_trades_salts", "kept_context"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
