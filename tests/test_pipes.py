"""Pipes that are told of files, what they report, live aggregates, and other stores."""

import random
import time
from collections import Counter
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from feeds import bag, land_events, land_positions, land_trades, position, random_positions, random_trades, trade
from pyspark.sql import functions as F

from tradeflow.operators import rollups
from tradeflow.plans import jobs, reports
from tradeflow.schemas import POSITIONS, TRADES
from tradeflow.sources import versions
from tradeflow.sources.formats import FEEDS, scan
from tradeflow.streaming import changes, ingest, live, refresh, runs
from tradeflow.workspace import Store, subfolders


@pytest.fixture
def stage(tmp_path):
    folder = tmp_path / "stage"
    folder.mkdir()
    return str(folder)


def loaded_ids(spark, root):
    return sorted(r["trade_id"] for r in ingest.raw_rows(spark, root, "trades_raw").collect())


def status_of(spark, root, state, stage=None):
    until = time.monotonic() + 60
    while True:
        row = reports.pipe_status(spark, root, "trades", stage).first()
        if row["execution_state"] == state or time.monotonic() > until:
            return row
        time.sleep(0.2)


def test_only_files_that_were_told_of_are_loaded_and_once(spark, stage, root):
    notices = f"{root}/notices"
    for i in range(6):
        land_trades(stage, f"trades_{i}.csv", [trade(trade_id=f"T{i}")])

    def tell(*names):
        files = ingest.list_stage(spark, FEEDS["trades"], stage)
        ingest.announce(files.where(F.element_at(F.split("file_name", "/"), -1).isin([f"trades_{n}.csv" for n in names])), notices)

    tell(0, 1)
    tell(1, 2)
    ingest.load_new_files(spark, "trades", stage, root, notices=notices)
    assert loaded_ids(spark, root) == ["T0", "T1", "T2"]
    tell(2, 3, 3)
    ingest.load_new_files(spark, "trades", stage, root, notices=notices)
    assert loaded_ids(spark, root) == ["T0", "T1", "T2", "T3"]
    tell(4)
    tell(0)
    ingest.load_new_files(spark, "trades", stage, root, notices=notices)
    assert loaded_ids(spark, root) == ["T0", "T1", "T2", "T3", "T4"]
    left = spark.read.schema(ingest.NOTICE).json(notices).select(F.col("_metadata.file_path")).distinct().count()
    assert left <= 3  # those of batches that are done go
    assert reports.pipe_status(spark, root, "trades", stage).first()["files_pending"] == 1


def test_status_of_a_pipe_from_another_session(spark, stage, root):
    other = spark.newSession()
    assert reports.pipe_status(other, root, "trades", stage).first()["execution_state"] == "NEVER_STARTED"
    for i in range(3):
        land_trades(stage, f"trades_{i}.csv", random_trades(random.Random(i), 5, i))
    pipe = ingest.start_pipe(spark, "trades", stage, root, every="1 second", files_per_batch=2)
    pipe.processAllAvailable()
    running = status_of(other, root, "RUNNING", stage)
    assert running["healthy"] and running["files_seen"] == 3 and running["files_pending"] == 0
    pipe.stop()
    land_trades(stage, "trades_9.csv", random_trades(random.Random(9), 5, 9))
    stopped = status_of(other, root, "STOPPED", stage)
    assert (stopped["triggers"], stopped["files_per_trigger"], stopped["files_pending"], stopped["rows_inserted"]) == (2, 1.5, 1, 15)
    assert stopped["healthy"] and stopped["last_error"] is None


def test_status_of_a_pipe_that_failed(spark, stage, root):
    Path(stage, "trades_1.csv").write_text("h\nT1,A1,QRX,2025-11-03 09:41:27,BUY,xx,1,1,XLON,filled\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest.load_new_files(spark, "trades", stage, root)
    row = status_of(spark, root, "STOPPED", stage)
    assert not row["healthy"] and row["last_error"] and row["files_pending"] == 1


def test_load_history_as_a_table_function(spark, stage, root):
    own = spark.newSession()
    reports.register_load_history(own, root)
    assert own.sql("SELECT * FROM load_history('trades_raw')").count() == 0
    for i in range(3):
        land_trades(stage, f"trades_{i}.csv", random_trades(random.Random(i), 5 + i, i))
        ingest.load_new_files(spark, "trades", stage, root)
    columns = ["table_name", "file_name", "file_size", "row_count", "last_load_time", "status", "error"]
    want = bag(reports.load_history(spark, root, "trades_raw", n=2), *columns)
    assert bag(own.sql("SELECT * FROM load_history(n => 2, tbl => 'TRADES_RAW') ORDER BY last_load_time DESC"), *columns) == want
    assert own.sql("SELECT * FROM load_history(tbl => 'trades_raw', since => current_timestamp() + INTERVAL 1 HOUR)").count() == 0
    assert own.sql("SELECT sum(row_count) FROM load_history(since => TIMESTAMP'2000-01-01', tbl => 'trades_raw')").first()[0] == 18


def test_marks_do_not_pile_up(spark, root):
    for batch in (0, 3, 2, 7, 7):
        changes.mark_seen(spark, root, "a/b c", {"trades_raw": batch, "positions_raw": 0})
    assert changes.seen(spark, root, "a/b c", "trades_raw") == 7
    assert changes.seen(spark, root, "other", "trades_raw") == -1
    assert len(Store(spark, f"{root}/logs/marks/a%2Fb%20c/trades_raw").sizes()) == 1


def some_events(rng, hours):
    return [{"EVENT_TS": f"2025-11-03 {h:02d}:{rng.randrange(60):02d}:00" if h is not None else None,
             "SYMBOL": rng.choice(["A", "B", None]), "EVENT_TYPE": rng.choice(["x", "y"]), "EVENT_ATTR": {}} for h in hours for _ in range(20)]


def test_live_event_counts(spark, stage, root, monkeypatch):
    monkeypatch.setattr(live, "FOLD_AFTER", 2)
    rng = random.Random(2)
    live.count_events(spark, root)
    assert live.read(spark, root, live.EVENT_COUNTS).count() == 0
    for i, hours in enumerate([[9, 10], [11], [1, None, 9], [23], [9]]):  # the third brings rows that come late
        land_events(stage, f"events_{i}.json", some_events(rng, hours))
        ingest.load_new_files(spark, "market_events", stage, root)
        for _ in range(1 + i % 2):
            live.count_events(spark, root)
        want = rollups.EVENT_SUMMARY.query(ingest.raw_rows(spark, root, "market_events_raw"))
        assert bag(live.read(spark, root, live.EVENT_COUNTS)) == bag(want)
    assert live.EVENT_COUNTS.last_refresh(spark, root)["version"] >= 1


def test_live_account_counts(spark, stage, root):
    rng = random.Random(3)
    for i in range(3):
        land_positions(stage, f"positions_{i}.parquet", random_positions(rng, 30) + [position(account_id=None, symbol=f"N{i}")])
        ingest.load_new_files(spark, "positions", stage, root)
        if i == 1:  # a batch that is stored anew before the stream has seen it, and after
            live.count_accounts(spark, root)
            rows = spark.createDataFrame(ingest.raw_rows(spark, root, "positions_raw", after=0, upto=1).drop("_batch").collect())
            rows.write.mode("overwrite").parquet(f"{ingest.raw_path(root, 'positions_raw')}/_batch=1")
        live.count_accounts(spark, root)
        want = ingest.raw_rows(spark, root, "positions_raw").groupBy("symbol").agg(F.count_distinct("account_id").alias("account_count"))
        assert bag(live.read(spark, root, live.ACCOUNT_COUNTS)) == bag(want)


def test_order_follows_the_sources(spark):
    names = lambda tables: [t.table.name for t in refresh.in_order(tables)]
    both = [refresh.TRADE_METRICS_DT, refresh.TRADES_ENRICHED_DT]
    assert names(both) == names(both[::-1]) == ["trades_enriched_dt", "trade_metrics_dt"]
    found = names([refresh.TRADE_METRICS_DT, refresh.POSITION_CONTEXT, refresh.TRADES_ENRICHED_DT])
    assert found == ["position_context", "trades_enriched_dt", "trade_metrics_dt"]


def test_a_pass_keeps_to_the_batches_it_began_with(spark, stage, root, monkeypatch):
    def deliver(i):
        land_trades(stage, f"trades_{i}.csv", random_trades(random.Random(i), 10, i))
        land_positions(stage, f"positions_{i}.parquet", random_positions(random.Random(i), 10))
        for feed in ("trades", "positions"):
            ingest.load_new_files(spark, feed, stage, root)

    deliver(0)
    inner, late = refresh.RollupTable.refresh, []

    def refresh_while_loading(self, *args):
        if not late:
            late.append(deliver(1))
        return inner(self, *args)

    monkeypatch.setattr(refresh.RollupTable, "refresh", refresh_while_loading)
    lags = [(refresh.TRADE_METRICS_DT, 0), (refresh.POSITION_SUMMARY_DT, 0), (refresh.TRADES_ENRICHED_DT, 0)]
    refresh.refresh_due(spark, root, lags=lags)
    reached = [t.table.last_refresh(spark, root)["inputs"] for t, _ in lags]
    assert reached == [{"trades_raw": 0}, {"positions_raw": 0}, {"trades_raw": 0, "positions_raw": 0}]
    refresh.refresh_due(spark, root, lags=lags, now=datetime.now(timezone.utc) + timedelta(seconds=1))
    assert refresh.TRADE_METRICS_DT.table.last_refresh(spark, root)["inputs"] == {"trades_raw": 1}
    metrics = rollups.TRADE_METRICS.query(ingest.raw_rows(spark, root, "trades_raw"))
    assert bag(refresh.TRADE_METRICS_DT.read(spark, root)) == bag(metrics)


def test_run_log_by_day(spark, root):
    def entry(i, day):
        at = datetime(2025, 11, day, 12, i, tzinfo=timezone.utc)
        return (f"r{i}-{day}", "transform", "s", "SUCCEEDED", at, at, 1.0, 1.0, i, None)

    for day in (1, 2, 3):
        for i in range(3):
            runs.enter_runs(spark, root, [entry(i, day)])
    since = runs.run_log(spark, root, since=datetime(2025, 11, 3, 12, 1, tzinfo=timezone.utc))
    assert sorted(r["run_id"] for r in since.collect()) == ["r1-3", "r2-3"]
    assert len(since.inputFiles()) <= 9 and "day#" in since._jdf.queryExecution().toString()
    whole = bag(runs.run_log(spark, root))
    assert runs.fold_runs(spark, root, before=date(2025, 11, 3)) == 6 and runs.fold_runs(spark, root, before=date(2025, 11, 3)) == 0
    assert bag(runs.run_log(spark, root)) == whole
    assert [len(subfolders(spark, f"{runs.run_log_path(root)}/day=2025-11-0{d}")) for d in (1, 2, 3)] == [1, 1, 3]


def test_a_fold_that_died_counts_nothing_twice(spark, root, monkeypatch):
    at = datetime(2025, 11, 1, tzinfo=timezone.utc)
    for i in range(3):
        runs.enter_runs(spark, root, [(f"r{i}", "u", "s", "SUCCEEDED", at, at, 1.0, 1.0, i, None)])
    with monkeypatch.context() as broken:
        broken.setattr(runs, "remove_folder", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            runs.fold_runs(spark, root, before=date(2025, 12, 1))
    assert sorted(r["run_id"] for r in runs.run_log(spark, root).collect()) == ["r0", "r1", "r2"]
    runs.fold_runs(spark, root, before=date(2025, 12, 1))
    assert sorted(r["run_id"] for r in runs.run_log(spark, root).collect()) == ["r0", "r1", "r2"]


def test_a_replaced_table_is_never_missing(spark, root):
    path = f"{root}/table"
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, path)
    versions.replace_table(spark.range(3), path)
    reader = versions.read_table(spark, path)
    with pytest.raises(Exception, match="(?i)divide"):
        versions.replace_table(spark.range(3).selectExpr("1 / (id - 1) AS id"), path)
    spark.range(7).write.parquet(f"{path}/v-000009")
    Path(path, "v-000009", "_SUCCESS").unlink()  # a writer that died
    assert versions.read_table(spark, path).count() == 3
    versions.replace_table(spark.range(5), path)
    assert reader.count() == 3 and versions.read_table(spark, path).count() == 5
    versions.replace_table(spark.range(6), path)
    assert versions.read_table(spark, path).count() == 6 and len(subfolders(spark, path)) == 2


@pytest.fixture(params=["scheme", "default"])
def elsewhere(spark, tmp_path, request):
    """A folder that plain paths of this machine don't reach: by a scheme, or by another default file system."""
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    store = f"viewfs://{tmp_path.name.replace('_', '-')}"  # Hadoop keeps a file system for good
    conf.set(f"fs.viewfs.mounttable.{store.removeprefix('viewfs://')}.link./kept", f"file://{tmp_path}")
    if request.param == "default":
        conf.set("fs.defaultFS", f"{store}/")
    yield f"{store}/kept" if request.param == "scheme" else "/kept"
    conf.set("fs.defaultFS", before)


def test_feeds_on_another_store(spark, elsewhere, tmp_path):
    folder, stage, root = tmp_path / "in", f"{elsewhere}/in", f"{elsewhere}/root"
    rng = random.Random(5)
    folder.mkdir()
    for i in range(2):
        land_trades(folder, f"trades_{i}.csv", random_trades(rng, 20, i))
        land_positions(folder, f"positions_{i}.parquet", random_positions(rng, 20))
        land_events(folder, f"events_{i}.json", some_events(rng, [9]))
        for feed in FEEDS:
            ingest.load_new_files(spark, feed, stage, root)
        refresh.refresh_due(spark, root, now=datetime.now(timezone.utc) + timedelta(hours=i))
        assert bag(ingest.raw_rows(spark, root, "trades_raw"), *TRADES.names) == bag(scan(spark, FEEDS["trades"], stage), *TRADES.names)
    assert scan(spark, FEEDS["market_events"], stage).count() == 40
    assert scan(spark, FEEDS["positions"], stage).select(*POSITIONS.names).count() == 40
    assert refresh.TRADE_METRICS_DT.table.last_refresh(spark, root)["version"] == 2
    assert bag(refresh.TRADE_METRICS_DT.read(spark, root)) == bag(rollups.TRADE_METRICS.query(ingest.raw_rows(spark, root, "trades_raw")))
    refresh.TRADE_METRICS_DT.compact(spark, root)
    refresh.TRADE_METRICS_DT.compact(spark, root)
    assert subfolders(spark, f"{root}/curated/trade_metrics_dt") and (tmp_path / "root" / "curated" / "trade_metrics_dt").is_dir()
    for n in (3, 5):
        jobs.overwrite(spark.range(n), f"{root}/whole")
    assert versions.read_table(spark, f"{root}/whole").count() == 5
    assert Counter(p.name for p in (tmp_path / "root" / "whole").iterdir()) == {"v-000001": 1, "v-000002": 1}
