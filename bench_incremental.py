"""Refreshing after a batch of about 1 % next to refreshing from scratch.

Prints one JSON line; BENCH_SF_DIR and BENCH_CPUS as in bench.py.
"""

from __future__ import annotations

import json
import os
import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bench import build_session, timed  # noqa: E402
from bindings.landing import deliver  # noqa: E402
from tradeflow.sources.driver_tables import raw_table  # noqa: E402
from tradeflow.sources.formats import FEEDS  # noqa: E402
from tradeflow.streaming import refresh  # noqa: E402
from tradeflow.streaming.ingest import load_new_files  # noqa: E402
from tradeflow.workspace import new_folder  # noqa: E402

TABLES = {
    "trades_enriched_dt": refresh.TRADES_ENRICHED_DT,
    "trade_metrics_dt": refresh.TRADE_METRICS_DT,
    "market_event_summary_dt": refresh.MARKET_EVENT_SUMMARY_DT,
    "position_summary_dt": refresh.POSITION_SUMMARY_DT,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(os.environ.get("BENCH_CPUS", "8"))
    stage, root = new_folder(spark, "bench-stage"), new_folder(spark, "bench-root")
    # A whole minute of the hour holds about one row in sixty.
    small = {
        "trades": F.minute("trade_ts") == 7,
        "positions": F.minute("updated_at") == 7,
        "market_events": F.minute("event_ts") == 7,
    }

    def load(batch: int, feed: str, wanted) -> float:
        rows = raw_table(spark, sf_dir, FEEDS[feed].table).where(wanted)
        deliver(rows, feed, stage, batch)
        return timed(lambda: load_new_files(spark, feed, stage, root))

    def refreshed(*names: str) -> dict[str, float]:
        return {n: timed(lambda: TABLES[n].refresh(spark, root)) for n in names}

    result = {"sf": Path(sf_dir).name.removeprefix("sf")}
    result["load_large"] = {f: load(1, f, ~is_small) for f, is_small in small.items()}
    result["first_refresh"] = refreshed(*TABLES)
    result["load_small_trades"] = load(2, "trades", small["trades"])
    result["refresh_new_trades"] = refreshed("trades_enriched_dt", "trade_metrics_dt")
    result["load_small_events"] = load(2, "market_events", small["market_events"])
    result["refresh_new_events"] = refreshed("market_event_summary_dt")
    result["load_small_positions"] = load(2, "positions", small["positions"])
    result["refresh_new_positions"] = refreshed("position_summary_dt", "trades_enriched_dt")
    result["full_refresh"] = {
        n: timed(lambda: table.refresh_fully(spark, root)) for n, table in TABLES.items()
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
