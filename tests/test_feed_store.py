import json
import tempfile

from pyspark.sql import functions as F

from helpers import envelopes
from tickengine.operators import feed as FD
from tickengine.operators import store as S
from tickengine.operators.parse import parse_candles


def candle_msg(symbol, timeframe="1m", minute=0, close="2", final=True):
    return json.dumps({"event": "candle.closed" if final else "candle.updated", "exchange": "ibkr",
                       "symbol": symbol, "currency": "EUR", "timeframe": timeframe,
                       "openTime": f"2024-01-15T09:{minute:02d}:00Z", "closeTime": f"2024-01-15T09:{minute:02d}:59.999Z",
                       "open": "1", "high": "3", "low": "0.5", "close": close, "volume": "10", "tickCount": 3,
                       "isFinal": final, "publishedAt": "2024-01-15T09:01:00Z"})


def test_route_semantics(spark):
    msgs = envelopes(spark, [candle_msg("ASML"), candle_msg("SAP", "5m"), "not json", json.dumps({"symbol": 5})])
    subs = spark.createDataFrame(
        [("all", None, None), ("blank", "  ", ""), ("asml", " asml ", None), ("asml1m", "ASML", "1m"),
         ("m5", None, " 5m "), ("sap1m", "sap", "1m")], "client_id string, symbol string, timeframe string")
    got = sorted((r.client_id, r.offset) for r in FD.route(msgs, subs, salt=3).collect())
    assert got == sorted([
        ("all", 0), ("all", 1), ("all", 2), ("all", 3), ("blank", 0), ("blank", 1), ("blank", 2), ("blank", 3),
        ("asml", 0), ("asml1m", 0), ("m5", 1),
    ])


def test_chart_series_and_metrics(spark):
    hist = envelopes(spark, [candle_msg("ASML", minute=0, close="2"), candle_msg("ASML", minute=1, close="0.1")])
    live = envelopes(spark, [candle_msg("ASML", minute=1, close="5", final=False),
                             json.dumps({"openTime": "2024-01-15T09:02:00Z", "open": "", "high": "1", "low": "1",
                                         "close": "1"})], start_offset=10)
    s = {r.time: (r.close, r.color) for r in FD.chart_series(hist, live).collect()}
    t0 = 1705309200
    assert s == {t0: (2.0, "#26a69a"), t0 + 60: (5.0, "#26a69a")}
    m = FD.feed_metrics(live, spark.createDataFrame([("c", None, None)], "client_id string, symbol string, timeframe string")).first()
    assert (m.message_count, m.last_close) == (1, "5")  # the message without a valid open is not counted


def test_store_roundtrip_keeps_text_partitions(spark):
    msgs = envelopes(spark, [candle_msg("0012"), candle_msg("BRK/B"), candle_msg("0012", minute=1, final=False)])
    parsed = parse_candles(msgs).where("bad_reason is null").drop("bad_reason")
    rows = S.store_rows(S.final_only(parsed))
    path = tempfile.mkdtemp(prefix="tickengine-store-")
    S.write_store(rows, path)
    store = S.read_store(spark, path)
    assert sorted(r.symbol for r in store.select("symbol").collect()) == ["0012", "BRK/B"]
    h = S.store_history(store, "0012", "1m", "2024-01-15")
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and h.count() == 1
    assert h.first().tradingDate == "2024-01-15" and h.first().date == "2024-01-15"


def test_latest_state_and_history(spark):
    msgs = envelopes(spark, [candle_msg("ASML", final=False, close="1"), candle_msg("ASML", final=True, close="2"),
                             candle_msg("ASML", minute=1, final=False, close="3")])
    parsed = parse_candles(msgs).where("bad_reason is null").drop("bad_reason")
    live = S.live_rows(S.latest_state(parsed))
    h = S.history(live, "ASML", None, "2024-01-15").collect()
    assert [(r.close, r.isFinal) for r in h] == [("2", True), ("3", False)]
    assert S.history(live, "asml", "1m", "2024-01-15").count() == 0          # Q12: history is case-sensitive
    # A malformed or missing date is today's, which has no candles here but has this one
    today = live.withColumn("trading_date", F.date_format(F.current_date(), "yyyy-MM-dd"))
    for date in ("not-a-date", "2024-02-30", None, "", "2024-1-5"):
        assert S.history(live, "ASML", "1m", date).count() == 0
        assert S.history(today, "ASML", "1m", date).count() == 2


def test_chart_points_number_rules(spark):
    base = {"openTime": "2024-01-15T09:00:30.500Z", "open": "1", "high": " 2 ", "low": "0", "close": "1"}
    msgs = [json.dumps({**base, "volume": "abc"}), json.dumps({**base, "volume": "Infinity"}),
            json.dumps({k: v for k, v in base.items()}), json.dumps({**base, "close": "x"}),
            json.dumps({**base, "low": ""}), json.dumps({**base, "openTime": "nope"})]
    pts = FD.chart_points(envelopes(spark, msgs)).orderBy("offset").collect()
    assert [(p.time, p.volume) for p in pts] == [(1705309230, 0.0), (1705309230, float("inf")), (1705309230, 0.0)]


def test_compaction_keeps_rows_and_merges_files(spark):
    import glob

    path = tempfile.mkdtemp(prefix="tickengine-compact-")
    for minute in range(4):
        msgs = envelopes(spark, [candle_msg("ASML", minute=minute), candle_msg("SAP", minute=minute)],
                         start_offset=minute * 10)
        parsed = parse_candles(msgs).where("bad_reason is null").drop("bad_reason")
        S.write_store(S.store_rows(parsed), path)
    before = S.read_store(spark, path).drop("storedAt").collect()
    files = lambda root: len(glob.glob(f"{root}/**/*.parquet", recursive=True))
    n_before = files(path)
    assert S.compact_store(spark, path, "2024-01-15") == 8 and S.compact_store(spark, path, "2024-01-15") == 8
    assert S.compact_store(spark, path, "2024-01-16") == 0
    after = S.read_store(spark, path).drop("storedAt").collect()
    assert sorted(map(tuple, before)) == sorted(map(tuple, after))
    assert files(S.closed_root(path)) == 2 < n_before == files(path)


def test_feed_metrics_counts_chart_points_only(spark):
    subs = spark.createDataFrame([("c", None, None)], "client_id string, symbol string, timeframe string")
    msgs = envelopes(spark, [candle_msg("ASML", close="2"), json.dumps({"symbol": "ASML", "timeframe": "1m"}),
                             candle_msg("ASML", minute=1, close="4")])
    m = FD.feed_metrics(msgs, subs).first()
    assert (m.message_count, m.last_close, m.last_open_time) == (2, "4", "2024-01-15T09:01:00Z")


def test_write_options(spark):
    from tickengine.operators import options as O
    from tickengine.sources.proxy import option_proxy

    path = tempfile.mkdtemp(prefix="tickengine-oi-")
    snaps = option_proxy(spark, "/root/testdata/sf0.001")
    ratio = O.put_call_ratio(snaps)
    O.write_options(snaps, path)
    assert spark.read.parquet(f"{path}/snapshots").count() == snaps.count()
    assert spark.read.parquet(f"{path}/put_call_ratio").count() == ratio.count()


def test_route_with_partial_pattern_classes(spark):
    msgs = envelopes(spark, [candle_msg("ASML"), "not json"])
    exact = spark.createDataFrame([("e", "asml", "1m")], "client_id string, symbol string, timeframe string")
    assert sorted((r.client_id, r.offset) for r in FD.route(msgs, exact).collect()) == [("e", 0)]
    anyone = spark.createDataFrame([("w", None, " ")], "client_id string, symbol string, timeframe string")
    assert sorted((r.client_id, r.offset) for r in FD.route(msgs, anyone).collect()) == [("w", 0), ("w", 1)]
    nobody = spark.createDataFrame([], "client_id string, symbol string, timeframe string")
    assert FD.route(msgs, nobody).count() == 0


def test_metric_counts_take_the_last_batch_by_number(spark, tmp_path):
    from tickengine.streaming.sinks import read_metric_counts

    subs = spark.createDataFrame([("a", None, None)], "client_id string, symbol string, timeframe string")
    for batch, messages in ((9, ["ASML"]), (10, ["ASML", "ASML", "SAP"])):
        counts = FD.metric_counts(envelopes(spark, [candle_msg(s, close=str(batch)) for s in messages]))
        counts.write.parquet(f"{tmp_path}/counts/batch={batch}")
    got = FD.metrics_of(read_metric_counts(spark, f"{tmp_path}/counts"), subs).collect()
    assert [(r.client_id, r.message_count, r.last_close) for r in got] == [("a", 3, "10")]
