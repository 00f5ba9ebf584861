"""Steps whose number of tasks, files or jobs must not grow faster than the rows."""

import json
import random
import time
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from feeds import bag, land_events, random_positions, random_trades
from pyspark.sql import functions as F

from bindings import deliveries, landing
from tradeflow.operators import rollups
from tradeflow.plans import jobs
from tradeflow.schemas import MARKET_EVENTS, POSITIONS, TRADES, TRADES_ENRICHED, conform
from tradeflow.sources import driver_tables, json_arrays
from tradeflow.sources.formats import FEEDS, scan
from tradeflow.streaming import ingest, live, refresh
from tradeflow.workspace import Store, settled, subfolders


def many_events(spark, n):
    return spark.range(n).select(
        F.lit(None).cast("timestamp_ntz").alias("event_ts"), F.col("id").cast("string").alias("symbol"), F.lit("x").alias("event_type"),
        F.parse_json(F.lit("{}")).alias("event_attr"))


def files_in(spark, folder):
    return [n for n in Store(spark, folder).sizes() if not n.startswith(("_", "."))]


def test_a_delivery_has_as_many_files_whatever_its_size(spark, tmp_path):
    folder = landing.deliver(many_events(spark, 450_000), "market_events", str(tmp_path), 1, 2)
    assert len(files_in(spark, folder)) == 2
    assert scan(spark, FEEDS["market_events"], str(tmp_path)).select("symbol").distinct().count() == 450_000


def test_deliveries_of_written_tables_shuffle_nothing(spark, tmp_path, root):
    spark.createDataFrame(random_positions(random.Random(1), 400), POSITIONS).repartition(4).write.parquet(root)
    table = landing.whole_files(spark.read.schema(POSITIONS).parquet(root))
    assert table.rdd.getNumPartitions() == 4
    jobs = []
    real = type(table).repartition
    type(table).repartition = lambda self, *a: jobs.append(a) or real(self, *a)
    try:
        folder = landing.deliver(table, "positions", str(tmp_path), 1, 3)
        assert jobs == [] and len(files_in(spark, folder)) == 3
        assert bag(scan(spark, FEEDS["positions"], str(tmp_path)).select(*POSITIONS.names)) == bag(table)
        none = table.where("quantity < 0").unionByName(table.limit(3))  # tasks without a row: dealt out after all
        folder = landing.deliver(none, "positions", str(tmp_path), 2, 3)
        assert spark.read.parquet(folder).count() == 3
    finally:
        type(table).repartition = real


def test_a_query_stages_its_own_feeds(spark):
    sf_dir = "/root/testdata/sf0.001"
    mine = f"{sf_dir}/"  # another spelling, so a stage of its own
    stage = deliveries.stage_with(spark, mine, "positions")
    assert all("positions" in n for n in subfolders(spark, stage)) and len(subfolders(spark, stage)) == deliveries.DELIVERIES
    assert deliveries.stage_with(spark, mine, "positions", "trades") == stage
    assert len(subfolders(spark, stage)) == 2 * deliveries.DELIVERIES


@pytest.fixture
def tables(spark, tmp_path):
    """Tables as the driver gives them, with a line whose order is missing and one whose part is."""
    at, rng = str(tmp_path / "tables"), random.Random(8)
    times = [datetime(2025, 11, 3 + d) for d in range(5)]
    lines = [(o, rng.randrange(40), rng.randrange(30), n, float(rng.randrange(1, 50)), rng.choice("ARN"), rng.choice("OF"), rng.choice(times))
             for o in range(600) for n in range(1, 4)]
    orders = [(o, rng.randrange(20), rng.choice("FOP")) for o in range(599)]
    events = [(i, t + timedelta(minutes=7 * i), i % 9, "view", i / 4, '{"k": 3}') for i, t in enumerate(times * 8)]
    for name, rows, schema in (
        ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                            "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string"),
        ("part", [(p, rng.choice(["PROMO", "STD"]), 900.25 + p) for p in range(39)], "p_partkey long, p_type string, p_retailprice double"),
        ("events", events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return at


def _as_text(rows, names):
    return bag(rows.select([F.col(n).cast("string").alias(n) for n in names]))


def test_feeds_are_delivered_without_being_written_first(spark, tables, monkeypatch):
    joined = []
    real = driver_tables.lookup_join
    monkeypatch.setattr(driver_tables, "lookup_join", lambda rows, lookup, key, *a, **k: joined.append(key) or real(rows, lookup, key, *a, **k))
    stage = deliveries.stage_with(spark, tables, *FEEDS)
    assert joined.count("l_orderkey") == 1  # lines are shuffled to their orders once, for trades and events
    assert not any(driver_tables.is_written(spark, tables, feed.table) for feed in FEEDS.values())
    found = {name: _as_text(scan(spark, feed, stage), feed.schema.names) for name, feed in FEEDS.items()}
    batches = [f.split("/")[-2] for feed in FEEDS.values() for f in ingest.list_stage(spark, feed, stage).toPandas()["file_name"]]
    assert {batches.count(b) for b in set(batches)} == {deliveries.files_per_delivery(spark)}
    monkeypatch.setattr(driver_tables, "_written", {})  # from here on as for a job that takes the tables themselves
    for name, feed in FEEDS.items():
        assert found[name] == _as_text(driver_tables.raw_table(spark, tables, feed.table), feed.schema.names)
    again = deliveries.new_folder(spark, "again")
    for name, feed in FEEDS.items():
        deliveries.deliver_feed(spark, tables, name, again)
        assert found[name] == _as_text(scan(spark, feed, again), feed.schema.names)


def test_rows_of_fewer_tasks_still_fill_all_files(spark, tmp_path):
    rows = many_events(spark, 60_000).coalesce(2)
    folder = landing.deliver(rows, "market_events", str(tmp_path), 1, 4, 2, gathered=True)
    assert len(files_in(spark, folder)) == 8
    assert bag(scan(spark, FEEDS["market_events"], str(tmp_path)), "symbol") == bag(rows, "symbol")


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "2k")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def test_a_task_of_a_delivery_writes_several_files_of_events(spark, tmp_path):
    rows = many_events(spark, 60_000).coalesce(2)
    folder = landing.deliver(rows, "market_events", str(tmp_path), 1, 2, 3)
    assert len(files_in(spark, folder)) == 6
    assert bag(scan(spark, FEEDS["market_events"], str(tmp_path)), "symbol") == bag(rows, "symbol")
    folder = landing.deliver(many_events(spark, 3), "market_events", str(tmp_path), 2, 1, 3)
    assert len(files_in(spark, folder)) == 3  # some hold an empty array


def test_files_of_a_pipe_are_read_as_one_text(spark, tmp_path, root, monkeypatch):
    # More than Spark keeps in one range by default, with strings that hold all signs.
    rows = [{"EVENT_TYPE": f'e{i}"\\}},[{{', "SYMBOL": "x" * 4000, "EVENT_ATTR": {"n": i}} for i in range(1200)]
    land_events(str(tmp_path), "events_1.json", rows)
    monkeypatch.setattr(json_arrays, "_starts", None)  # reading by ranges would fail
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    ingest.load_new_files(spark, "market_events", str(tmp_path), root)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert bag(ingest.raw_rows(spark, root, "market_events_raw"), "event_type", "symbol") == {(r["EVENT_TYPE"], r["SYMBOL"]): 1 for r in rows}


def test_a_session_that_names_a_size_keeps_it(spark, small_ranges):
    with ingest.whole_texts(spark, FEEDS["market_events"]):
        assert spark.conf.get("spark.sql.files.openCostInBytes") == "2k"


def test_parts_of_a_text_end_after_a_brace(monkeypatch):
    monkeypatch.setattr(json_arrays, "PART_BYTES", 5)
    text = b'[{"a": "}]\\""}, {"b": {}}] []'
    parts = list(json_arrays._parts(text))
    assert b"".join(parts) == text and len(parts) > 2 and all(p.endswith(b"}") for p in parts[:-1])
    cut = json_arrays.Cutter("t")
    assert [e for p in parts for e in cut.elements(p)] == [b'{"a": "}]\\""}', b'{"b": {}}']


def test_written_tables_are_packed_tight(spark, tmp_path, root):
    rows = spark.createDataFrame(random_positions(random.Random(5), 300), POSITIONS)
    landing.deliver(rows, "positions", str(tmp_path), 1, 2)
    ingest.load_new_files(spark, "positions", str(tmp_path), root)
    refresh.POSITION_SUMMARY_DT.refresh(spark, root)
    for folder in (str(tmp_path), f"{root}/raw", f"{root}/curated/position_summary_dt"):
        files = [f for f in Path(folder).rglob("*.parquet") if f.is_file()]
        assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)


def test_many_small_ranges_take_few_tasks(spark, tmp_path, small_ranges, monkeypatch):
    monkeypatch.setattr(json_arrays, "RANGES_AT_ONCE", 50)  # their starts don't fit one broadcast
    rows = [{"EVENT_TYPE": f"e{i}", "SYMBOL": "}" * (i % 90), "EVENT_ATTR": {"n": i}} for i in range(9000)]
    for k in range(3):
        Path(tmp_path, f"events_{k}.json").write_text(json.dumps(rows[k * 3000:(k + 1) * 3000]))
    pieces = spark.read.text(str(tmp_path), lineSep="}")
    assert pieces.rdd.getNumPartitions() > 300
    assert json_arrays._gathered(pieces).rdd.getNumPartitions() <= 16 * spark.sparkContext.defaultParallelism
    found = scan(spark, FEEDS["market_events"], str(tmp_path))
    assert bag(found, "event_type", "symbol") == {(r["EVENT_TYPE"], r["SYMBOL"]): 1 for r in rows}


def test_a_batch_of_events_is_published_by_slot_and_once(spark, tmp_path, root, monkeypatch):
    monkeypatch.setattr(live, "ROWS_PER_SLOT", 50)
    rng = random.Random(4)
    land_events(str(tmp_path), "events_1.json", [
        {"EVENT_TS": "2025-11-03 09:00:00", "SYMBOL": str(rng.randrange(90)), "EVENT_TYPE": "x", "EVENT_ATTR": {}} for _ in range(300)])
    ingest.load_new_files(spark, "market_events", str(tmp_path), root)
    live.count_events(spark, root)
    batch = f"{live._published(root)}/_batch=0"
    slots = subfolders(spark, batch)
    assert len(slots) > 3 and all(len([n for n in Store(spark, f"{batch}/{s}").sizes() if n.endswith(".parquet")]) == 1 for s in slots)
    # A publication that was lost before its last slots were in place.
    Store(spark, batch).drop("_SUCCESS")
    Store(spark, f"{batch}/{slots[0]}").remove()
    assert live.publish_events(spark, root) == [0] and live.publish_events(spark, root) == []
    assert sorted(subfolders(spark, batch)) == sorted(slots)
    assert all(len([n for n in Store(spark, f"{batch}/{s}").sizes() if n.endswith(".parquet")]) == 1 for s in slots)
    whole = spark.read.schema(rollups.EVENT_SUMMARY.schema).option("recursiveFileLookup", True).parquet(batch)
    assert bag(whole) == bag(rollups.EVENT_SUMMARY.query(ingest.raw_rows(spark, root, "market_events_raw")))


def test_a_full_refresh_writes_its_rows_once(spark, tmp_path, root):
    table = refresh.POSITION_SUMMARY_DT
    rows = spark.createDataFrame(random_positions(random.Random(7), 60), POSITIONS)
    landing.deliver(rows, "positions", str(tmp_path), 1, 2)
    ingest.load_new_files(spark, "positions", str(tmp_path), root)
    table.refresh(spark, root)
    table.refresh_fully(spark, root)
    table.compact(spark, root)
    assert not subfolders(spark, f"{root}/scratch")
    assert bag(table.read(spark, root)) == bag(table.rollup.query(rows))
    at = table.table.last_refresh(spark, root)
    assert set(at["first_version"].values()) == {3} and refresh.FRESH in at["first_version"]


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return {n.split("/")[-1] for n in found.split() if "/shuffle_" in n}


def test_a_written_step_leaves_no_shuffle_files(spark, root):
    before, until = shuffle_files(spark), time.monotonic() + 20
    rows = settled(spark.range(20_000).groupBy((F.col("id") % 5_000).alias("key")).count(), root)
    assert rows.count() == 5_000
    left = lambda: [n for n in shuffle_files(spark) - before if n.endswith(".data")]
    while len(left()) > 1 and time.monotonic() < until:  # they go a moment later; the count's own file may stay
        time.sleep(0.1)
    assert len(left()) <= 1
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")


@pytest.mark.parametrize("feed", FEEDS)
def test_a_delivery_leaves_the_stage_before_the_next_comes(spark, tables, root, monkeypatch, feed):
    there, stages, real = [], set(), ingest.load_new_files

    def load(spark, name, stage, *a, **k):
        stages.add(stage)
        there.append(subfolders(spark, stage))
        return real(spark, name, stage, *a, **k)

    monkeypatch.setattr(deliveries, "load_new_files", load)
    told = []
    deliveries.load_by_delivery(spark, tables, feed, root, then=lambda session, at, batch: told.append(batch))
    assert len(stages) == 1 and [len(folders) for folders in there] == [1] * deliveries.DELIVERIES and told == [0, 1, 2]
    assert not any(subfolders(spark, stage) for stage in stages)
    schema = FEEDS[feed].schema
    found = _as_text(ingest.raw_rows(spark, root, FEEDS[feed].table), schema.names)
    assert found == _as_text(driver_tables.raw_table(spark, tables, FEEDS[feed].table), schema.names)
    deliveries.stage_with(spark, tables, feed)  # what all share stays where it is, and is loaded from there
    deliveries.load_by_delivery(spark, tables, feed, f"{root}-again")
    assert len(there[-1]) == deliveries.DELIVERIES == len(subfolders(spark, deliveries.stage_with(spark, tables, feed)))
    assert found == _as_text(ingest.raw_rows(spark, f"{root}-again", FEEDS[feed].table), schema.names)


def test_staged_events_are_packed_unless_they_are_to_be_cut(spark, tables):
    sizes = {}
    for packed in (True, False):
        stage = deliveries.stage_with(spark, tables, "market_events", packed=packed)
        files = ingest.list_stage(spark, FEEDS["market_events"], stage).collect()
        assert all(f["file_name"].endswith(".zst.json") == packed for f in files)
        sizes[packed] = len(files), sum(f["file_size"] for f in files), _as_text(scan(spark, FEEDS["market_events"], stage), MARKET_EVENTS.names)
    assert sizes[True][0] == sizes[False][0] and sizes[True][2] == sizes[False][2]
    assert sizes[True][1] < sizes[False][1] / 2


def test_packed_arrays_are_read_whole_beside_others(spark, tmp_path, small_ranges, monkeypatch):
    monkeypatch.setattr(json_arrays, "PART_BYTES", 700)
    rows = [{"EVENT_TYPE": f'e{i}"\\}},[{{', "SYMBOL": "é}" * (i % 900), "EVENT_ATTR": {"n": i}} for i in range(900)]
    for k, ending in enumerate((".gz.json", ".zst.json", ".json")):
        with pa.output_stream(str(tmp_path / f"events_{k}{ending}"), compression={0: "gzip", 1: "zstd"}.get(k)) as file:
            file.write(json.dumps(rows[k::3], ensure_ascii=False).encode())
    for name in ("events_small.json", "events_plain.gz.json"):  # the second is packed by its name only
        land_events(str(tmp_path), name, rows[:2])
    found = scan(spark, FEEDS["market_events"], str(tmp_path))
    want = Counter((r["EVENT_TYPE"], r["SYMBOL"]) for r in [*rows, *rows[:2], *rows[:2]])
    assert bag(found, "event_type", "symbol") == want
    names = {f.rsplit("/", 1)[-1] for (f,) in bag(found, "_src_file")}
    assert names == {"events_0.gz.json", "events_1.zst.json", "events_2.json", "events_small.json", "events_plain.gz.json"}
    whole = Path(tmp_path, "events_1.zst.json").read_bytes()
    Path(tmp_path, "events_1.zst.json").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception, match="cut off|[Tt]runcated"):
        scan(spark, FEEDS["market_events"], str(tmp_path)).collect()


def test_an_upserted_batch_is_written_once(spark, root):
    table = jobs.UpsertTable(parts=4, merge_after=2)
    rows = conform(spark.createDataFrame(random_trades(random.Random(3), 40, 1), TRADES), TRADES_ENRICHED)
    table.upsert(spark, root, rows, version=0)
    table.upsert(spark, root, rows.where("status = 'filled'"), version=1)
    assert not subfolders(spark, f"{root}/scratch")
    assert bag(table.read(spark, root)) == bag(rows)
    before = table.table.last_refresh(spark, root)
    with pytest.raises(ValueError, match="occurs twice"):
        table.upsert(spark, root, rows.unionByName(rows.limit(1)), version=2)
    assert table.table.last_refresh(spark, root) == before and bag(table.read(spark, root)) == bag(rows)
    assert subfolders(spark, f"{root}/stage/trades_enriched_by_id") == ["_v=1", "_v=2"]
