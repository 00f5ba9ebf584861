"""The SQL each registered query is checked against, for DuckDB.

Written from the meaning of the query, not from its Spark form. Every
statement runs over the whole of the tables it names.
"""

from __future__ import annotations

_TRADE_ID = """'TRD-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
             || '-' || CAST(CAST(l_shipdate AS DATE) AS VARCHAR)"""
_TRADE_TS = "l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 613) % 86400)"

_FEED_TS = f"CASE WHEN l_orderkey % 97 <> 0 THEN {_TRADE_TS} END"

_TRADES = f"""
trades AS (
  SELECT {_TRADE_ID} AS trade_id,
         CAST(o_custkey AS VARCHAR) AS account_id,
         CASE WHEN p_type = 'PROMO' THEN l_partkey || '-WI' ELSE CAST(l_partkey AS VARCHAR) END
           AS symbol,
         {_FEED_TS} AS trade_ts,
         CASE l_returnflag WHEN 'A' THEN 'BUY' WHEN 'R' THEN 'SELL' END AS side,
         CAST(l_quantity AS DECIMAL(38, 0)) AS quantity,
         CAST(p_retailprice AS DECIMAL(18, 4)) AS price,
         CAST(CAST(l_quantity AS DECIMAL(9, 0)) * CAST(p_retailprice AS DECIMAL(9, 2))
              AS DECIMAL(18, 2)) AS amount,
         l_linestatus AS exchange,
         o_orderstatus AS status
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN part ON p_partkey = l_partkey
)"""

_POSITIONS = f"""
held AS (
  SELECT l_partkey, l_suppkey,
         CAST(sum(CAST(l_quantity AS DECIMAL(18, 0))) AS DECIMAL(18, 0)) AS quantity,
         max({_TRADE_TS}) AS updated_at
  FROM lineitem
  GROUP BY l_partkey, l_suppkey
),
priced AS (
  SELECT held.*,
         CAST(p_retailprice AS DECIMAL(9, 2)) AS cost,
         CAST(CAST(p_retailprice AS DECIMAL(9, 2))
              + CAST(l_suppkey % 7 AS DECIMAL(9, 0)) * CAST(0.13 AS DECIMAL(9, 2))
              AS DECIMAL(12, 2)) AS now
  FROM held JOIN part ON p_partkey = l_partkey
),
positions AS (
  SELECT CAST(l_partkey AS VARCHAR) AS symbol,
         CAST(l_suppkey AS VARCHAR) AS account_id,
         CAST(quantity AS DECIMAL(38, 0)) AS quantity,
         CAST(cost AS DECIMAL(18, 4)) AS avg_cost,
         CAST(quantity * cost AS DECIMAL(18, 2)) AS cost_basis,
         CAST(now AS DECIMAL(18, 4)) AS current_price,
         CAST(quantity * now AS DECIMAL(18, 2)) AS market_value,
         CAST(quantity * (now - cost) AS DECIMAL(18, 2)) AS unrealized_pnl,
         updated_at
  FROM priced
)"""

_EVENTS = f"""
market_events AS (
  SELECT ts AS event_ts, CAST(user_id AS VARCHAR) AS symbol, event_type,
         'market_data' AS source, CAST(NULL AS VARCHAR) AS trade_id,
         CAST(NULL AS VARCHAR) AS account_id, event_type AS alert_type,
         CAST(json_extract(props, '$.k') AS DECIMAL(18, 4)) AS threshold_price,
         CAST(value AS DECIMAL(18, 4)) AS current_price
  FROM events
  UNION ALL
  SELECT {_FEED_TS}, CAST(l_partkey AS VARCHAR),
         CASE o_orderstatus WHEN 'F' THEN 'order_filled' WHEN 'O' THEN 'order_placed'
                            ELSE 'order_cancelled' END,
         'trading_system', {_TRADE_ID}, CAST(o_custkey AS VARCHAR), NULL, NULL, NULL
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
)"""


def _mean(column: str) -> str:
    """The mean of a non-negative 4-digit decimal, rounded half up in integers."""
    units = f"CAST(sum({column}) * 10000 AS HUGEINT)"
    n = f"count({column})"
    return f"CAST(CAST((2 * {units} + {n}) // (2 * {n}) AS DECIMAL(20, 0)) * 0.0001 AS DECIMAL(18, 4))"


_METRICS = f"""
  SELECT date_trunc('hour', trade_ts) AS trade_hour, symbol,
         count(*) AS trade_count,
         CAST(sum(quantity) AS DECIMAL(38, 0)) AS total_volume,
         CAST(sum(amount) AS DECIMAL(38, 2)) AS total_notional,
         {_mean("price")} AS avg_price,
         CAST(sum(CASE WHEN side = 'BUY' THEN 1 ELSE 0 END) AS BIGINT) AS buy_count,
         CAST(sum(CASE WHEN side = 'SELL' THEN 1 ELSE 0 END) AS BIGINT) AS sell_count
  FROM trades
  GROUP BY date_trunc('hour', trade_ts), symbol"""

_AGG = f"""
positions_agg AS (
  SELECT symbol,
         {_mean("current_price")} AS avg_market_price,
         CAST(sum(quantity) AS DECIMAL(38, 0)) AS total_position_qty,
         CAST(sum(market_value) AS DECIMAL(38, 2)) AS total_market_value
  FROM positions
  GROUP BY symbol
)"""

_ENRICHED = f"""
enriched AS (
  SELECT trades.*, avg_market_price, total_position_qty, total_market_value
  FROM trades LEFT JOIN positions_agg USING (symbol)
)"""

_ALL_TRADES = f"WITH {_TRADES} SELECT * FROM trades"
_ALL_POSITIONS = f"WITH {_POSITIONS} SELECT * FROM positions"
_ALL_EVENTS = f"""WITH {_EVENTS}
SELECT event_ts, symbol, event_type, source, trade_id, account_id, current_price
FROM market_events"""
_ALL_ENRICHED = f"WITH {_TRADES}, {_POSITIONS}, {_AGG}, {_ENRICHED} SELECT * FROM enriched"
_ALL_METRICS = f"WITH {_TRADES} {_METRICS}"

_EVENT_SUMMARY = f"""WITH {_EVENTS}
SELECT date_trunc('hour', event_ts) AS event_hour, symbol, event_type, count(*) AS event_count
FROM market_events
GROUP BY date_trunc('hour', event_ts), symbol, event_type"""

_POSITION_SUMMARY = f"""WITH {_POSITIONS}
SELECT symbol,
       count(DISTINCT account_id) AS account_count,
       CAST(sum(quantity) AS DECIMAL(38, 0)) AS total_shares,
       CAST(sum(cost_basis) AS DECIMAL(38, 2)) AS total_cost_basis,
       CAST(sum(market_value) AS DECIMAL(38, 2)) AS total_market_value,
       CAST(sum(unrealized_pnl) AS DECIMAL(38, 2)) AS total_unrealized_pnl,
       {_mean("current_price")} AS avg_current_price
FROM positions
GROUP BY symbol"""

_DELIVERED = f"""
delivered AS (
  SELECT 'trades' AS feed, CAST(CAST(account_id AS BIGINT) % 3 + 1 AS INTEGER) AS delivery
  FROM trades
  UNION ALL
  SELECT 'positions', CAST(CAST(account_id AS BIGINT) % 3 + 1 AS INTEGER) FROM positions
  UNION ALL
  SELECT 'market_events', CAST(coalesce(minute(event_ts), 0) % 3 + 1 AS INTEGER) FROM market_events
)"""

# Positions arrive in three deliveries, loaded as batches 0 to 2.
_BATCHES = "batches AS (SELECT CAST(account_id AS BIGINT) % 3 AS batch FROM positions)"
_TAKEN = f"""WITH {_TRADES}, {_POSITIONS}, taken AS (
  SELECT 'trades_enriched_dt' AS name, (SELECT count(*) FROM trades) + (SELECT count(*) FROM positions) AS rows_taken
  UNION ALL SELECT 'trade_metrics_dt', (SELECT count(*) FROM trades)
  UNION ALL SELECT 'position_summary_dt', (SELECT count(*) FROM positions)
)
"""

ORACLES: dict[str, str] = {
    "scan_csv_trades": _ALL_TRADES,
    "scan_json_events": _ALL_EVENTS,
    "scan_json_ranges": _ALL_EVENTS,
    "scan_parquet_positions": _ALL_POSITIONS,
    "scan_pattern": f"""WITH {_TRADES}, {_POSITIONS}, {_EVENTS}, {_DELIVERED}
SELECT feed, delivery, count(*) AS row_count FROM delivered GROUP BY feed, delivery""",
    "copy_into_once": _ALL_TRADES,
    "pipe_batches": _ALL_POSITIONS,
    "pipe_notices": _ALL_TRADES,
    "pipe_refresh": _ALL_EVENTS,
    "stop_resume": _ALL_TRADES,
    "sink_overwrite": _ALL_ENRICHED,
    "sink_append": f"""WITH {_TRADES}, metrics AS ({_METRICS})
SELECT * REPLACE (CAST(total_notional AS DECIMAL(18, 2)) AS total_notional) FROM metrics
UNION ALL
SELECT * REPLACE (CAST(total_notional AS DECIMAL(18, 2)) AS total_notional) FROM metrics""",
    "conform_schema": """
SELECT CAST(l_orderkey AS VARCHAR) AS trade_id,
       CAST(NULL AS VARCHAR) AS account_id,
       CAST(l_partkey AS VARCHAR) AS symbol,
       l_shipdate AS trade_ts,
       CAST(NULL AS VARCHAR) AS side,
       CAST(l_quantity AS DECIMAL(38, 0)) AS quantity,
       CAST(NULL AS DECIMAL(18, 4)) AS price,
       CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount,
       CAST(NULL AS VARCHAR) AS exchange,
       CAST(NULL AS VARCHAR) AS status
FROM lineitem""",
    "positions_agg": f"WITH {_POSITIONS}, {_AGG} SELECT * FROM positions_agg",
    "enrich_trades": _ALL_ENRICHED,
    "enrich_trades_sql": _ALL_ENRICHED,
    "enrich_stored": _ALL_ENRICHED,
    "enrich_procedure": f"""WITH {_TRADES}, {_POSITIONS}, {_AGG}, {_ENRICHED}
SELECT 'TRADES_ENRICHED refreshed' AS status, count(*) AS row_count,
       count(avg_market_price) AS rows_with_context
FROM enriched""",
    "trade_metrics": _ALL_METRICS,
    "market_event_summary": _EVENT_SUMMARY,
    "position_summary": _POSITION_SUMMARY,
    "latest_price": f"""WITH {_POSITIONS}
SELECT symbol, current_price AS latest_price, updated_at AS priced_at
FROM positions
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY updated_at DESC, current_price DESC) = 1""",
    "events_flattened": f"""WITH {_EVENTS}
SELECT event_ts, symbol, event_type, source, alert_type AS priority, alert_type,
       threshold_price, current_price, trade_id, account_id,
       current_price AS dividend_amount,
       CASE WHEN source = 'market_data' THEN CAST(event_ts AS DATE) END AS ex_date,
       current_price AS eps_actual, threshold_price AS eps_estimate, threshold_price AS surprise_pct,
       CAST(threshold_price AS DECIMAL(18, 2)) AS required_amount
FROM market_events""",
    "order_event_join": f"""WITH {_TRADES}, {_EVENTS}
SELECT e.trade_id, e.event_ts, e.event_type, t.symbol, t.side, t.quantity, t.amount, t.status
FROM market_events e LEFT JOIN trades t ON t.trade_id = e.trade_id
WHERE e.event_type IN ('order_placed', 'order_filled', 'order_cancelled')""",
    "changes_since": f"""WITH {_TRADES}
SELECT * FROM trades WHERE CAST(account_id AS BIGINT) % 3 + 1 > 1""",
    "stream_status": """
SELECT 'TRADES_RAW_STREAM' AS stream, false AS has_data
UNION ALL SELECT 'MARKET_EVENTS_RAW_STREAM', (SELECT count(*) > 0 FROM events)
UNION ALL SELECT 'POSITIONS_RAW_STREAM', (SELECT count(*) > 0 FROM lineitem)""",
    "run_if_new": f"""WITH {_TRADES}
SELECT side, count(*) AS trade_count, CAST(1 AS INTEGER) AS times_run FROM trades GROUP BY side""",
    "chain_enrich_metrics": _ALL_METRICS,
    "enrich_incremental": _ALL_ENRICHED,
    "metrics_incremental": _ALL_METRICS,
    "event_summary_incremental": _EVENT_SUMMARY,
    "position_summary_incremental": _POSITION_SUMMARY,
    "event_counts_live": _EVENT_SUMMARY,
    "account_counts_live": f"""WITH {_POSITIONS}
SELECT symbol, count(DISTINCT account_id) AS account_count FROM positions GROUP BY symbol""",
    "full_refresh": _POSITION_SUMMARY,
    "upsert_enriched": f"""WITH {_TRADES}, {_POSITIONS}, {_AGG}, {_ENRICHED}
SELECT * REPLACE (CASE status WHEN 'F' THEN 'filled' ELSE status END AS status) FROM enriched""",
    "usage_top_recent": """
SELECT event_id AS run_id, event_type AS unit, ts AS start_time, value AS credits_used
FROM events
WHERE event_type IN ('click', 'purchase', 'view')
ORDER BY ts DESC NULLS FIRST, event_id
LIMIT 200""",
    "recent_window": """
SELECT event_id AS run_id, event_type AS unit, ts AS start_time,
       value / 1000 AS elapsed_sec, value / 2 / 1000 AS exec_sec
FROM events
WHERE event_type IN ('click', 'purchase', 'view')
  AND ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
ORDER BY ts DESC NULLS FIRST, event_id
LIMIT 200""",
    "load_history": f"""WITH {_TRADES}, {_POSITIONS}, {_EVENTS}, {_DELIVERED}
SELECT feed || '_raw' AS table_name, delivery, 'LOADED' AS status,
       CAST(count(*) AS BIGINT) AS row_count
FROM delivered GROUP BY feed, delivery""",
    "pipe_usage": f"""WITH {_TRADES}, {_POSITIONS}, {_EVENTS}, {_DELIVERED}
SELECT feed || '_pipe' AS pipe_name, count(DISTINCT delivery) AS runs, count(*) AS rows_inserted
FROM delivered GROUP BY feed""",
    "load_history_sql": f"""WITH {_TRADES}, {_POSITIONS}, {_EVENTS}, {_DELIVERED}
SELECT feed || '_raw' AS table_name, delivery, 'LOADED' AS status,
       CAST(count(*) AS BIGINT) AS row_count
FROM delivered GROUP BY feed, delivery""",
    "pipe_status": f"""WITH {_TRADES}, {_POSITIONS}, {_EVENTS}, {_DELIVERED}
SELECT 'trades_pipe' AS pipe_name, 'STOPPED' AS execution_state, true AS healthy,
       count(*) AS rows_inserted, count(DISTINCT delivery) AS triggers, CAST(0 AS BIGINT) AS files_failed,
       CAST(0 AS BIGINT) AS files_pending, true AS all_files_logged
FROM delivered WHERE feed = 'trades'""",
    "refresh_history": f"""WITH {_POSITIONS}, {_BATCHES}
SELECT name, CAST(version AS BIGINT) AS version, 'INCREMENTAL' AS refresh_action,
       CAST(upto AS BIGINT) AS upto_batch, true AS finished,
       (SELECT count(*) FROM batches WHERE batch > since AND batch <= upto) AS rows_taken
FROM (VALUES ('position_summary_dt', 1, -1, 0), ('position_summary_dt', 2, 0, 1),
             ('position_context', 1, -1, 2)) AS log(name, version, since, upto)""",
    "table_lag": f"""WITH {_POSITIONS}, {_BATCHES}
SELECT name, 'positions_raw' AS source,
       (SELECT count(DISTINCT batch) FROM batches WHERE batch > upto) AS batches_behind,
       (SELECT count(*) FROM batches WHERE batch > upto) AS rows_behind,
       CASE WHEN upto >= 0 THEN upto < 2 END AS late
FROM (VALUES ('position_summary_dt', 1), ('position_context', 2), ('never_refreshed', -1)) AS lag(name, upto)""",
    "lag_due": _TAKEN + "SELECT name, CAST(1 AS BIGINT) AS refreshes, rows_taken FROM taken",
    "suspend_table": _TAKEN + """SELECT name, CAST(1 AS BIGINT) AS refreshes, rows_taken FROM taken
WHERE name <> 'trade_metrics_dt'""",
}
