"""Files to RAW tables: what is read, and that it is read once."""

import json
import os
import random
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from feeds import (
    bag,
    land_events,
    land_positions,
    land_trades,
    random_positions,
    random_trades,
    trade,
)
from pyspark.sql import functions as F

from tradeflow.schemas import MARKET_EVENTS, POSITIONS, TRADES, conform
from tradeflow.plans import reports
from tradeflow.sources import json_arrays
from tradeflow.sources.formats import FEEDS, scan
from tradeflow.streaming import ingest

HEADER = ",".join(n.upper() for n in TRADES.names)


@pytest.fixture
def stage(tmp_path):
    # The folder above the stage names a feed, which must not match anything.
    folder = tmp_path / "trades.csv-events.json-positions.parquet" / "stage"
    folder.mkdir(parents=True)
    return str(folder)


def loaded(spark, root, table, *columns):
    schema = FEEDS[{f.table: n for n, f in FEEDS.items()}[table]].schema
    return bag(ingest.raw_rows(spark, root, table), *(columns or schema.names))


def test_csv_quotes_positions_and_empty_fields(spark, stage):
    Path(stage, "trades_1.csv").write_text(
        "A,B,C,D,E,F,G,H,I,J\n"
        'T1,A1,"X ""q"", y",2025-11-03 09:41:27,BUY,100,47.25,4725.00,XLON,filled\n'
        'T2,A1,,2026-03-08 02:30:00,,7,1.00005,,"",filled\n'
    )
    rows = scan(spark, FEEDS["trades"], stage).orderBy("trade_id").collect()
    assert rows[0]["symbol"] == 'X "q", y'
    assert rows[0]["price"] == Decimal("47.2500")
    assert rows[1]["symbol"] is None and rows[1]["side"] is None and rows[1]["amount"] is None
    assert rows[1]["trade_ts"] == datetime(2026, 3, 8, 2, 30)


def test_csv_time_in_a_zone_that_skips_it(spark, stage):
    land_trades(stage, "trades_1.csv", [trade(trade_ts=datetime(2026, 3, 8, 2, 30))])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert scan(spark, FEEDS["trades"], stage).first()["trade_ts"] == datetime(2026, 3, 8, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("quantity", ["xx", "1.2.3"])
def test_bad_number_stops_the_load(spark, stage, root, quantity):
    Path(stage, "trades_1.csv").write_text(
        f"{HEADER}\nT1,A1,QRX,2025-11-03 09:41:27,BUY,{quantity},1,1,XLON,filled\n"
    )
    with pytest.raises(Exception, match="(?i)malformed"):
        scan(spark, FEEDS["trades"], stage).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest.load_new_files(spark, "trades", stage, root)
    assert ingest.latest_batch(spark, root, "trades_raw") == -1
    assert not loaded(spark, root, "trades_raw")


def test_json_keys_in_any_case_and_order(spark, stage):
    attr = {"trade_id": "T1", "nested": [1, {"x": None}]}
    land_events(stage, "events_1.json", [
        {"EVENT_TS": "2025-11-03 09:41:00", "SYMBOL": "QRX", "EVENT_TYPE": "t", "EVENT_ATTR": attr},
        {"event_attr": attr, "event_type": "t", "symbol": "QRX", "event_ts": "2025-11-03 09:41:00"},
        {"Event_Ts": "2025-11-03 09:41:00", "Symbol": "QRX", "Event_Type": "t", "eVENT_aTTR": attr, "x": 1},
        {"EVENT_TS": None, "EVENT_TYPE": "t"},
    ])
    Path(stage, "events_empty.json").write_text("[]")
    rows = scan(spark, FEEDS["market_events"], stage)
    assert rows.schema[:4] == MARKET_EVENTS[:4]
    found = bag(rows.select("event_ts", "symbol", "event_type", F.to_json("event_attr")))
    assert found == {
        (datetime(2025, 11, 3, 9, 41), "QRX", "t", json.dumps(dict(sorted(attr.items())), separators=(",", ":"))): 3,
        (None, None, "t", None): 1,
    }


def test_json_that_is_cut_off_stops_the_load(spark, stage):
    Path(stage, "events_1.json").write_text('[{"EVENT_TS": "2025-11-03 09:41:00", "SYM')
    with pytest.raises(Exception, match="(?i)malformed"):
        scan(spark, FEEDS["market_events"], stage).collect()


def test_parquet_types_missing_and_extra_columns(spark, stage):
    land_positions(stage, "positions_1.parquet", random_positions(random.Random(1), 5))
    pq.write_table(
        pa.table({"symbol": ["Z"], "Account_Id": ["A"], "NOTE": ["dropped"], "current_price": [1.23456]}),
        Path(stage, "positions_2.parquet"),
    )
    rows = scan(spark, FEEDS["positions"], stage)
    assert rows.columns == POSITIONS.names + ["_src_file"]
    assert [f.dataType for f in rows.schema[:9]] == [f.dataType for f in POSITIONS]
    assert rows.count() == 6
    z = rows.where("symbol = 'Z'").first()
    assert (z["account_id"], z["current_price"], z["avg_cost"]) == ("A", Decimal("1.2346"), None)
    assert rows.where("avg_cost IS NOT NULL AND updated_at IS NOT NULL").count() == 5


def test_pattern_looks_below_the_stage_only(spark, stage):
    rows = random_trades(random.Random(1), 3, 1)
    land_trades(f"{stage}/2026/trades_a", "part-0.csv", rows)
    land_trades(stage, "rejects.csv", rows)
    land_trades(stage, "trades.csv.bak", rows)
    assert scan(spark, FEEDS["trades"], stage).count() == 3
    assert scan(spark, FEEDS["trades"], stage, pattern=".*[.]csv").count() == 6
    Path(stage, "other.csv").write_text("not,a,trade\nx,y,z\n")
    assert scan(spark, FEEDS["trades"], stage).count() == 3


def test_conform_casts_loudly(spark):
    df = spark.createDataFrame([("x",)], "QUANTITY string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, TRADES).collect()


def test_each_file_once_whichever_way_it_is_loaded(spark, stage, root):
    rng = random.Random(3)
    first, second = random_trades(rng, 20, 1), random_trades(rng, 20, 2)
    land_trades(stage, "trades_1.csv", first)
    ingest.load_new_files(spark, "trades", stage, root)
    ingest.load_new_files(spark, "trades", stage, root)
    assert sum(loaded(spark, root, "trades_raw").values()) == 20

    land_trades(stage, "trades_2.csv", second)
    # Old enough that Spark's own default would skip it.
    os.utime(Path(stage, "trades_2.csv"), (1.6e9, 1.6e9))
    pipe = ingest.start_pipe(spark, "trades", stage, root, every="1 second")
    pipe.processAllAvailable()
    pipe.stop()
    log = ingest.load_log(spark, root, "trades_raw")
    assert bag(log, "_batch", "row_count") == {(0, 20): 1, (1, 20): 1}
    assert sorted(loaded(spark, root, "trades_raw", "trade_id")) == sorted((r[0],) for r in first + second)


def test_replayed_batch_replaces_itself(spark, stage, root):
    """A batch that fails after storing its rows is run again, not added."""
    land_trades(stage, "trades_1.csv", random_trades(random.Random(4), 20, 1))
    calls = []

    def fails_once(session, at, batch):
        calls.append(batch)
        if len(calls) == 1:
            raise RuntimeError("lost after the batch was stored")

    with pytest.raises(Exception, match="lost after"):
        ingest.load_new_files(spark, "trades", stage, root, then=fails_once)
    ingest.load_new_files(spark, "trades", stage, root, then=fails_once)
    assert calls == [0, 0]
    assert sum(loaded(spark, root, "trades_raw").values()) == 20
    assert ingest.load_log(spark, root, "trades_raw").count() == 1


def test_rows_stored_without_a_log_entry_are_not_read(spark, stage, root, monkeypatch):
    land_trades(stage, "trades_1.csv", random_trades(random.Random(4), 20, 1))
    with monkeypatch.context() as broken:
        broken.setattr(ingest, "load_log_path", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivision"):
            ingest.load_new_files(spark, "trades", stage, root)
    assert not loaded(spark, root, "trades_raw")
    ingest.load_new_files(spark, "trades", stage, root)
    assert sum(loaded(spark, root, "trades_raw").values()) == 20


def test_file_without_rows_is_logged(spark, stage, root):
    land_trades(stage, "trades_empty.csv", [])
    land_trades(stage, "trades_1.csv", [trade()])
    ingest.load_new_files(spark, "trades", stage, root)
    log = ingest.load_log(spark, root, "trades_raw")
    assert bag(log.select(F.element_at(F.split("file_name", "/"), -1), "row_count")) == {
        ("trades_empty.csv", 0): 1, ("trades_1.csv", 1): 1,
    }


def test_names_that_look_like_globs(spark, stage, root):
    for i, name in enumerate(["trades[1].csv", "trades{a,b}.csv", "trades *?.csv", "trades %41é.csv"]):
        land_trades(stage, name, [trade(trade_id=f"T{i}")])
    ingest.load_new_files(spark, "trades", stage, root)
    assert sorted(x for (x,) in loaded(spark, root, "trades_raw", "trade_id")) == ["T0", "T1", "T2", "T3"]
    assert scan(spark, FEEDS["trades"], stage).count() == 4


@pytest.mark.parametrize("above", ["trades.csv x", "trades.csv [1]", "trades.csv %20"])
def test_pattern_below_a_stage_that_is_spelled_otherwise(spark, tmp_path, above):
    folder = tmp_path / above / "my stage"
    land_trades(folder, "other.csv", [trade()])
    land_trades(folder, "trades 1.csv", [trade()])
    land_events(folder, "events 1.json", [{"EVENT_TYPE": "x"}])
    assert scan(spark, FEEDS["trades"], str(folder)).count() == 1
    assert scan(spark, FEEDS["market_events"], str(folder)).count() == 1


def test_parquet_files_that_disagree_on_a_type(spark, stage, root):
    for name, quantity in [("a", pa.array([1, 2])), ("b", pa.array([1.0, None])), ("c", pa.array(["3", "4"]))]:
        pq.write_table(pa.table({"SYMBOL": ["X", "Y"], "QUANTITY": quantity}), Path(stage, f"positions_{name}.parquet"))
    ingest.load_new_files(spark, "positions", stage, root)
    assert loaded(spark, root, "positions_raw", "quantity") == {(Decimal(1),): 2, (Decimal(2),): 1, (None,): 1, (Decimal(3),): 1, (Decimal(4),): 1}
    assert scan(spark, FEEDS["positions"], stage).count() == 6


@pytest.mark.parametrize("feed, good, bad", [
    ("trades", f"{HEADER}\nT1,A1,S,2025-11-03 09:41:27,BUY,1,1,1,XLON,filled\n", f"{HEADER}\nT1,A1,S,2025-11-03 09:41:27,BUY,x,1,1,XLON,filled\n"),
    ("market_events", '[{"EVENT_TYPE": "x"}]', '[{"EVENT_TYPE": "x"}, {"EVENT'),
])
def test_pipe_skips_bad_files_and_says_so(spark, stage, root, feed, good, bad):
    table, kind = FEEDS[feed].table, FEEDS[feed].name_glob[1:]
    word = feed.split("_")[-1]
    for i in range(5):
        Path(stage, f"{word}_{i}{kind}").write_text(bad if i == 2 else good)
    pipe = ingest.start_pipe(spark, feed, stage, root, every="1 second")
    pipe.processAllAvailable()
    pipe.stop()
    assert sum(loaded(spark, root, table).values()) == 4
    history = reports.load_history(spark, root, table).collect()
    assert sorted(r["status"] for r in history) == ["FAILED"] + ["LOADED"] * 4
    (failed,) = [r for r in history if r["status"] == "FAILED"]
    assert f"{word}_2" in failed["file_name"] and failed["row_count"] == 0 and failed["error"]


def cut(text, size, borders=()):
    """Elements of an array read in parts of about ``size`` bytes, in ranges that begin at ``borders``."""
    data = text.encode()
    ends = [i + 1 for i, b in enumerate(data) if b == ord("}")]
    starts = [0] + [min((e for e in ends if e >= b), default=len(data)) for b in borders] + [len(data)]
    shape, found, fragments = json_arrays.Shape(), [], []
    for number, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
        own = json_arrays.Cutter("x", bool(shape.flips), shape.nests[0])
        at = a
        while at < b:
            to = min((e for e in ends if e >= at + size and e <= b), default=b)
            found += own.elements(data[at:to])
            shape.add(data[at:to])
            at = to
        own.end(b == len(data))
        fragments += [(number, *f) for f in own.fragments]
        if b == len(data) and not own.arrays and not number:
            raise own.malformed("not an array")
    whole, open_parts = [], []
    for _, kind, part, *_ in fragments:
        open_parts = [part] if kind == json_arrays.BEGINS else [*open_parts, part]
        if kind == json_arrays.ENDS and (text := b"".join(open_parts).strip()):
            whole.append(text)
    return [json.loads(x) for x in found + whole]


VALUES = [{"a": 'x,]}"\\'}, [1, [2, "}"]], "a\\\"[b", None, 3.5, {"é漢": {"b": []}}, "\\\\", {}, {"k": "}{}[,]"}, {"n": {"m": {"o": "\\\\\""}}}]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_array_elements_in_parts(size):
    for text in (json.dumps(VALUES), json.dumps(VALUES, indent=2, ensure_ascii=False), "\ufeff " + json.dumps(VALUES) + "\n "):
        assert cut(text, size) == VALUES
    assert cut(" [ ] ", size) == [] and cut("[1]\n [] [2, 3]\n", size) == [1, 2, 3]
    for broken in ("", " ", "{}", "[1", "[1] 2", "[1]]", '["a]', "[1,]", "[,1]", "[1}", "[1] ,[2]", '[{"a": 1]}'):
        with pytest.raises(ValueError, match="malformed"):
            cut(broken, size)


@pytest.mark.parametrize("seed", range(3))
def test_arrays_cut_anywhere(seed):
    rng = random.Random(seed)
    text = json.dumps(VALUES * 3, indent=rng.choice([None, 1]))
    key = lambda x: json.dumps(x, sort_keys=True)
    for _ in range(60):
        borders = sorted(rng.randrange(len(text)) for _ in range(rng.randrange(5)))
        assert sorted(cut(text, rng.randrange(1, 60), borders), key=key) == sorted(VALUES * 3, key=key)


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few thousand bytes, as a large file has of many megabytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "4k")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def events_with_borders(rng, n):
    """Events whose strings hold brackets, quotes and commas, so that ranges begin in the middle of them."""
    return [{"EVENT_TYPE": f"e{i}", "SYMBOL": rng.choice(['a"}],[{', "}" * rng.randrange(300), "\\", "\\\"}", "plain"]),
             "EVENT_ATTR": {"k": {"l": [{"m": "}" * rng.randrange(50)}]}, "n": i}} for i in range(n)]


def test_one_array_in_many_ranges(spark, stage, small_ranges):
    rng = random.Random(8)
    rows = events_with_borders(rng, 3000)
    Path(stage, "events_big.json").write_text(json.dumps(rows))
    Path(stage, "events_marked.json").write_text("\ufeff" + json.dumps(rows[:300], indent=3) + "\n")
    Path(stage, "events_closed.json").write_text("[" + json.dumps(rows[:40]).removeprefix("[") + "\n[" + json.dumps(rows[40:90]).removeprefix("["))
    Path(stage, "events_small.json").write_text(json.dumps(rows[:3]))
    found = scan(spark, FEEDS["market_events"], stage)
    assert found.rdd.getNumPartitions() > 100
    got = bag(found.select(F.element_at(F.split("_src_file", "/"), -1), "event_type", "symbol", F.expr("try_variant_get(event_attr, '$.n', 'int')")))
    want = {}
    for name, some in (("big", rows), ("marked", rows[:300]), ("closed", rows[:90]), ("small", rows[:3])):
        for r in some:
            key = (f"events_{name}.json", r["EVENT_TYPE"], r["SYMBOL"], r["EVENT_ATTR"]["n"])
            want[key] = want.get(key, 0) + 1
    assert got == want


@pytest.mark.parametrize("text", [" ", "[1", "{}", '[{"EVENT_TYPE": "x}"}', "[{}]]", "[{}] x", '[{"EVENT_TYPE": "x"}, {"EVENT'])
@pytest.mark.parametrize("rows", [0, 400])
def test_malformed_arrays_stop_the_read(spark, stage, small_ranges, text, rows):
    before = json.dumps(events_with_borders(random.Random(1), rows))[:-1] + ", " if rows else ""
    text = text.removeprefix("[") if rows else text
    Path(stage, "events_1.json").write_text(before + text)
    with pytest.raises(Exception, match="(?i)malformed"):
        scan(spark, FEEDS["market_events"], stage).collect()


def test_large_array_takes_little_memory():
    """A task's memory follows the batch of pieces, not the file."""
    import resource

    part = b",".join(b'{"EVENT_TYPE": "x", "EVENT_ATTR": {"k": [1, 2, 3]}}' for _ in range(80_000))
    own, n = json_arrays.Cutter("x"), 0
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for i in range(150):
        n += len(own.elements((b"," if i else b"[") + part))
    n += len(own.elements(b"]"))
    own.end(True)
    assert n == 150 * 80_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000
