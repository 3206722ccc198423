import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickengine.operators import candles as C
from tickengine.operators.parse import good_ticks, parse_ticks
from tickengine.schema import ENVELOPE_TICKS
from tickengine.sources.envelope import tick_envelopes
from tickengine.sources.proxy import tick_proxy
from tickengine.streaming import candle_state as CS

from conftest import SF_SMALL

COLS = ["exchange", "symbol", "open_us", "open", "high", "low", "close", "volume", "tick_count"]


def batch_candles(env):
    c = C.candles(good_ticks(parse_ticks(env)), ENVELOPE_TICKS, "1m")
    return c.select(*[F.col(x).cast("string") if x in ("open", "high", "low", "close", "volume") else x for x in COLS])


def stream_candles(spark, sink):
    out = CS.latest_candles(spark.read.parquet(sink))
    dec = lambda c: F.col(c).cast("decimal(28,10)").cast("string")
    return out.select(*[dec(x).alias(x) if x in ("open", "high", "low", "close", "volume") else x for x in COLS])


@pytest.mark.parametrize("files", [1, 3])
def test_stream_equals_batch(spark, files):
    env = tick_envelopes(tick_proxy(spark, SF_SMALL))
    base = tempfile.mkdtemp(prefix="tickengine-stream-")
    n = CS.write_replay_files(env, f"{base}/src", steps=files)
    CS.run_replay(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", timeout_s=300, files_per_trigger=n)
    got, want = stream_candles(spark, f"{base}/sink"), batch_candles(env)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_restart_from_checkpoint(spark):
    env = tick_envelopes(tick_proxy(spark, SF_SMALL))
    base = tempfile.mkdtemp(prefix="tickengine-restart-")
    hi = env.agg(F.max("offset")).first()[0]
    cut = hi // 2
    env.where(F.col("offset") <= cut).coalesce(1).write.mode("append").parquet(f"{base}/src")
    CS.run_replay(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", timeout_s=300)
    env.where(F.col("offset") > cut).coalesce(1).write.mode("append").parquet(f"{base}/src")
    CS.run_replay(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", timeout_s=300)  # resumes
    got, want = stream_candles(spark, f"{base}/sink"), batch_candles(env)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # one final per candle in the stream output itself
    finals = CS.candle_rows(spark.read.parquet(f"{base}/sink")).where("is_final")
    assert finals.groupBy("exchange", "symbol", "open_us").count().where("count > 1").count() == 0


def test_per_tick_revisions_equal_batch_revisions(spark):
    env = tick_envelopes(tick_proxy(spark, SF_SMALL))
    base = tempfile.mkdtemp(prefix="tickengine-revs-")
    n = CS.write_replay_files(env, f"{base}/src", steps=2)
    CS.run_replay(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", timeout_s=300, files_per_trigger=n, per_tick=True)
    out = CS.candle_rows(spark.read.parquet(f"{base}/sink"))
    num = lambda c: F.col(c).cast("decimal(28,10)")
    cols = ["exchange", "symbol", "open_us", "tick_count", "is_final"]
    got = out.select(*cols, *[num(c).alias(c) for c in ("open", "high", "low", "close", "volume")])
    revs = C.candle_revisions(good_ticks(parse_ticks(env)), ENVELOPE_TICKS, "1m")
    want = revs.select(*cols, *[num(c).alias(c) for c in ("open", "high", "low", "close", "volume")])
    # every update matches; closes match except the last open candle per instrument (closed only by a drain)
    updates = want.where(~F.col("is_final"))
    assert got.where(~F.col("is_final")).exceptAll(updates).count() == 0
    assert updates.exceptAll(got.where(~F.col("is_final"))).count() == 0
    closed = got.where("is_final")
    assert closed.exceptAll(want.where("is_final")).count() == 0
    open_left = want.where("is_final").exceptAll(closed)
    assert open_left.count() == want.select("exchange", "symbol").distinct().count()


def test_stream_late_ticks_equal_batch_late_ticks(spark):
    from tickengine.operators.late import late_ticks

    env = tick_envelopes(tick_proxy(spark, SF_SMALL))
    base = tempfile.mkdtemp(prefix="tickengine-late-")
    n = CS.write_replay_files(env, f"{base}/src", steps=3)
    CS.run_replay(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", timeout_s=300, files_per_trigger=n)
    got = CS.late_rows(spark.read.parquet(f"{base}/sink")).select("exchange", "symbol", "event_us", "open_us")
    want = late_ticks(good_ticks(parse_ticks(env)), ENVELOPE_TICKS).select(
        "exchange", "symbol", "event_us", F.col("bucket").alias("open_us"))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_timeframes_of_one_stream_equal_their_batches(spark):
    env = tick_envelopes(tick_proxy(spark, SF_SMALL))
    base = tempfile.mkdtemp(prefix="tickengine-timeframes-")
    n = CS.write_replay_files(env, f"{base}/src", steps=3)
    CS.run_replay(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", ("1m", "1h"), timeout_s=300, files_per_trigger=n)
    num = lambda c: F.col(c).cast("decimal(28,10)")
    cols = ["timeframe", "exchange", "symbol", "open_us", "tick_count"]
    values = [num(c).alias(c) for c in ("open", "high", "low", "close", "volume")]
    got = CS.latest_candles(spark.read.parquet(f"{base}/sink")).select(*cols, *values)
    ticks = good_ticks(parse_ticks(env))
    want = C.candles(ticks, ENVELOPE_TICKS, "1m").unionByName(C.candles(ticks, ENVELOPE_TICKS, "1h")).select(*cols, *values)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


class Kept:
    """An instrument's state between calls, on a clock of its own."""

    def __init__(self):
        self.get, self.exists, self.hasTimedOut, self.now_ms, self.wait_ms = None, False, False, 0, None

    def update(self, values):
        self.get, self.exists = values, True

    def getCurrentProcessingTimeMs(self):
        return self.now_ms

    def setTimeoutDuration(self, wait_ms):
        self.wait_ms = wait_ms


def test_a_timeout_closes_the_timeframes_that_are_due():
    minute = 60_000_000
    start = 60 * minute
    rows = pd.DataFrame({
        "event_us": [start + 1], "price": ["2"], "size": ["1"], "cumulative_volume": [None], "currency": ["EUR"], "partition": [0],
        "offset": [0], "record_us": [start + 1], "price_u": [2 * 10**10], "size_u": [10**10], "cum_u": [0], "exact": [True]})
    state, fn = Kept(), CS._timeframes_fn(("1m", "1h"), 2_000_000, False, "processing")
    state.now_ms = start // 1000 + 5
    opened = pd.concat(fn(("x", "a"), iter([rows]), state))
    assert opened.timeframe.tolist() == ["1m", "1h"] and not opened.is_final.any()
    assert state.wait_ms == 62_000 - 5
    state.now_ms, state.hasTimedOut, state.wait_ms = start // 1000 + 62_000, True, None
    closed = pd.concat(fn(("x", "a"), iter([]), state))
    assert closed.timeframe.tolist() == ["1m"] and closed.is_final.all()
    assert state.wait_ms == 3_540_000  # the hour's candle is next
    state.now_ms, state.wait_ms = start // 1000 + 3_602_000, None
    closed = pd.concat(fn(("x", "a"), iter([]), state))
    assert closed.timeframe.tolist() == ["1h"] and closed.is_final.all() and state.wait_ms is None
