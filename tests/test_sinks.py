import json
import tempfile

import pytest

from pyspark.sql import functions as F

from helpers import envelopes, tick
from tickengine.operators import candles as C
from tickengine.operators import store as S
from tickengine.operators.parse import good_ticks, parse_candles, parse_ticks
from tickengine.schema import ENVELOPE_TICKS, PROXY_TICKS
from tickengine.sources.envelope import replay_stream
from tickengine.sources.proxy import tick_proxy
from tickengine.streaming import candle_state as CS
from tickengine.streaming import sinks as K

from conftest import SF_SMALL


def proxy_candle_envelopes(spark):
    return S.candle_messages(C.candle_revisions(tick_proxy(spark, SF_SMALL), PROXY_TICKS, "1m"))


def test_store_stream_equals_batch_rows(spark):
    env = proxy_candle_envelopes(spark)
    base = tempfile.mkdtemp(prefix="tickengine-k2-")
    env.coalesce(2).write.parquet(f"{base}/src")
    q = K.store_stream(replay_stream(spark, f"{base}/src"), f"{base}/store", f"{base}/ckpt")
    q.awaitTermination(300)
    got = S.read_store(spark, f"{base}/store").drop("storedAt")
    want = S._to_layout(K.stored_candles(env)).drop("storedAt").withColumnsRenamed({c: f"path_{c}" for c in S.RAW})
    want = want.withColumnsRenamed({raw: c for c, raw in S.RAW.items()})
    assert got.count() == want.count() == env.where(F.col("value").contains('"isFinal":true')).count()
    assert got.exceptAll(want.select(got.columns)).count() == 0


def test_live_table_versions(spark):
    def msg(close, final, ticks):
        return json.dumps({"event": "candle.closed" if final else "candle.updated", "exchange": "e", "symbol": "S",
                           "currency": "EUR", "timeframe": "1m", "openTime": "2024-01-15T09:00:00Z",
                           "closeTime": "2024-01-15T09:00:59.999Z", "open": "1", "high": "3", "low": "1",
                           "close": close, "volume": "0", "tickCount": ticks, "isFinal": final, "publishedAt": ""})

    table = K.LiveTable(spark, tempfile.mkdtemp(prefix="tickengine-k4-"))
    assert table.read().count() == 0

    def rows(msgs, offset):
        return parse_candles(envelopes(spark, msgs, start_offset=offset)).where("bad_reason is null").drop("bad_reason")

    seen = lambda: [(r.close, r.is_final) for r in table.read().collect()]
    table.append(rows([msg("1", False, 1), msg("2", False, 2)], 0), "q", 1)
    assert seen() == [("2", 0)]
    table.append(rows([msg("3", True, 3)], 10), "q", 2)
    table.append(rows([msg("3", True, 3)], 10), "q", 2)   # the batch is run again
    assert seen() == [("3", 1)]
    table.compact("2024-01-15")
    table.append(rows([msg("1", False, 1), msg("2", False, 2)], 0), "other", 0)   # a new checkpoint reads from the start
    assert seen() == [("3", 1)]
    table.append(rows([msg("4", True, 2)], 20), "other", 1)   # the last arrival wins, whatever its tick count
    table.compact("2024-01-15")
    assert seen() == [("4", 1)]


def test_live_stream(spark):
    env = proxy_candle_envelopes(spark)
    base = tempfile.mkdtemp(prefix="tickengine-k4s-")
    env.coalesce(1).write.parquet(f"{base}/src")
    table = K.LiveTable(spark, f"{base}/live")
    q = K.live_stream(replay_stream(spark, f"{base}/src", max_files_per_trigger=1), table, f"{base}/ckpt")
    q.awaitTermination(300)
    parsed = parse_candles(env).where("bad_reason is null").drop("bad_reason")
    want = S.live_rows(S.latest_state(parsed))
    got = table.read()
    assert got.count() == want.count()
    assert got.exceptAll(want.select(got.columns)).count() == 0


def test_instrument_far_behind_the_others_loses_nothing(spark):
    # B's ticks are hours older than everything read before them
    a = [tick(m, 0, last=3) for m in range(180, 190)]
    b = [tick(0, 20, last=5, symbol="B"), tick(1, 0, last=6, symbol="B"), tick(0, 30, last=7, symbol="B")]
    base = tempfile.mkdtemp(prefix="tickengine-lag-")
    envelopes(spark, a).coalesce(1).write.mode("append").parquet(f"{base}/src")
    envelopes(spark, b, start_offset=100).coalesce(1).write.mode("append").parquet(f"{base}/src")
    CS.run_replay(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", files_per_trigger=1, timeout_s=300)
    out = spark.read.parquet(f"{base}/sink")
    got = CS.latest_candles(out).select("symbol", "open_us", "tick_count").collect()
    want = C.candles(good_ticks(parse_ticks(envelopes(spark, a + b))), ENVELOPE_TICKS).select(
        "symbol", "open_us", "tick_count").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    # accepted and late ticks add up to the input
    assert sum(r.tick_count for r in got) + CS.late_rows(out).count() == len(a) + len(b)


def test_unfinished_replay_raises(spark):
    base = tempfile.mkdtemp(prefix="tickengine-cut-")
    envelopes(spark, [tick(m, 0, last=1) for m in range(50)]).repartition(40).write.parquet(f"{base}/src")
    with pytest.raises(TimeoutError):
        CS.run_replay(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", files_per_trigger=1, timeout_s=0.5)


def test_processing_time_does_not_close_a_backlog_early(spark):
    # the minute is long past on the wall clock and comes in three batches: one candle, no late tick
    base = tempfile.mkdtemp(prefix="tickengine-ptimer-")
    for k in range(3):
        envelopes(spark, [tick(0, 10 * k + 5, last=k + 1)], start_offset=k).coalesce(1).write.mode("append").parquet(f"{base}/src")
    CS.run_replay(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", files_per_trigger=1, timer="processing", timeout_s=300, settle_s=3)
    out = spark.read.parquet(f"{base}/sink")
    assert [(r.tick_count, r.close) for r in CS.latest_candles(out, drain=False).collect()] == [(3, "3.0000000000")]
    assert CS.late_rows(out).count() == 0 and CS.candle_rows(out).where("is_final").count() == 0


def test_processing_time_closes_a_live_instrument(spark):
    import time

    now = int(time.time() * 1_000_000)
    start = now - now % 60_000_000 - 60_000_000 + 59_000_000   # the last second of the minute before this one
    base = tempfile.mkdtemp(prefix="tickengine-plive-")
    live = envelopes(spark, [tick(0, 0, last=1)]).withColumn(
        "value", F.regexp_replace("value", '"sourceTimestamp":"[^"]*"', f'"sourceTimestamp":"{time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(start // 1_000_000))}"')
    ).withColumn("timestamp", F.timestamp_micros(F.lit(now)))
    live.coalesce(1).write.parquet(f"{base}/src")
    CS.run_replay(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", timer="processing", timeout_s=300, settle_s=8)
    assert CS.candle_rows(spark.read.parquet(f"{base}/sink")).where("is_final").count() == 1


