"""The registered queries: each reads the test tables at ``sf_dir`` and returns a DataFrame whose columns match
the DuckDB oracle of the same name (:mod:`.oracle`). Times are compared as epoch micros."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import candles as C
from ..operators import parse as P
from ..operators import quotes as Q
from ..operators import feed as FD
from ..operators import options as O
from ..operators import store as S
from ..functions.text import iso_instant, resolve_date
from ..operators.late import late_ticks
from ..schema import ENVELOPE_TICKS, PROXY_TICKS, TIMEFRAME_SECONDS
from ..session import materialize, prepare
from ..sources.envelope import learning_events, received_records, replay_stream, tick_envelopes
from ..sources.proxy import option_envelopes, option_proxy, raw_snapshots, tick_proxy
from ..streaming import candle_state as CS
from ..streaming import sinks as K
from ..streaming.quote_state import throttle_stream

Query = Callable[[SparkSession, str], DataFrame]


def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return tick_proxy(spark, sf_dir)


def q_candles_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.candles(_ticks(spark, sf_dir), PROXY_TICKS, "1m")


def q_late_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_ticks(_ticks(spark, sf_dir), PROXY_TICKS, "1m").select(
        "exchange", "symbol", "event_id", "arrival", "ts_us", "bucket", "price_c"
    )


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parse_ticks(tick_envelopes(_ticks(spark, sf_dir)))


def _cents(c: str):
    return (F.col(c) * 100).cast("bigint")


def q_parse_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.good_ticks(_parsed(spark, sf_dir)).select(
        "partition", "offset", "exchange", "symbol", "currency",
        _cents("price").alias("price_c"), F.col("size").cast("bigint").alias("size"),
        F.col("cumulative_volume").cast("bigint").alias("cum"), "event_us", "price_source",
    )


def q_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.bad_records(_parsed(spark, sf_dir)).select("topic", "partition", "offset", "key", "reason")


def q_price_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir)
    return parsed.groupBy("exchange", "symbol", F.coalesce("price_source", F.lit("none")).alias("price_source")).agg(
        F.count(F.lit(1)).alias("n")
    )


def q_candles_1m_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = P.good_ticks(_parsed(spark, sf_dir))
    return _candles_in_cents(C.candles(ticks, ENVELOPE_TICKS, "1m"))


def _candles_in_cents(c: DataFrame) -> DataFrame:
    return c.select(
        "exchange", "symbol", "currency", "timeframe", "open_us", "close_us",
        *[_cents(x).alias(x) for x in ("open", "high", "low", "close")],
        F.col("volume").cast("bigint").alias("volume"), "tick_count",
    )


# the proxy's quote signature and throttle interval (its quotes are ~40 s apart per instrument, so the
# producer's 250 ms default would never bite)
QUOTE_SIGNATURE = ("bid_c", "size")
THROTTLE_MS = 15_000
QUOTE_KEYS = ["exchange", "symbol"]


def q_session_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Q.label_sessions(_ticks(spark, sf_dir), "ts_us")
    return t.select("exchange", "symbol", "event_id", "ts_us", "session", F.col("isPremarket").alias("is_premarket"))


def q_quote_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Q.quote_changes(_ticks(spark, sf_dir), QUOTE_KEYS, "ts_us", "event_id", QUOTE_SIGNATURE)
    return t.select("exchange", "symbol", "event_id", "ts_us", "bid_c", "size")


def q_quote_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Q.quote_throttle(_ticks(spark, sf_dir), QUOTE_KEYS, "ts_us", "event_id", QUOTE_SIGNATURE, THROTTLE_MS)
    return t.select("exchange", "symbol", "event_id", "ts_us", "bid_c", "size")


def q_quote_throttle_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 + F7 live: the quotes of three replayed steps (cut by time) through the keyed-state throttle."""
    base = CS.scratch_dir(spark, "quotes")
    quotes = materialize(_ticks(spark, sf_dir).select(*QUOTE_KEYS, "ts_us", "event_id", *QUOTE_SIGNATURE))
    cuts = quotes.approxQuantile("ts_us", [1 / 3, 2 / 3], 0.01)
    for lo, hi in zip([None, *cuts], [*cuts, None], strict=True):
        part = quotes if lo is None else quotes.where(F.col("ts_us") > lo)
        part = part if hi is None else part.where(F.col("ts_us") <= hi)
        part.repartition(CS.REPLAY_FILES).write.mode("append").parquet(f"{base}/source")
    stream = spark.readStream.schema(quotes.schema).option("maxFilesPerTrigger", str(CS.REPLAY_FILES)).parquet(f"{base}/source")
    out = throttle_stream(stream, QUOTE_KEYS, "ts_us", "event_id", QUOTE_SIGNATURE, THROTTLE_MS)
    out.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(
        f"{base}/sink").awaitTermination()
    return spark.read.parquet(f"{base}/sink")


def q_candle_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _revision_columns(C.candle_revisions(_ticks(spark, sf_dir), PROXY_TICKS, "1m"))


def _revision_columns(r: DataFrame) -> DataFrame:
    return r.select("exchange", "symbol", "timeframe", "open_us", "rev", "event", "open", "high", "low", "close",
                    "volume", "tick_count", "is_final")


def _timeframe_query(timeframe: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return C.candles(_ticks(spark, sf_dir), PROXY_TICKS, timeframe)

    q.__name__ = f"q_candles_{timeframe}"
    return q


def q_rollup_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: 1-minute candles rolled up to 5 minutes (volume and late rule of the 1-minute candles)."""
    return C.rollup(C.candles(_ticks(spark, sf_dir), PROXY_TICKS, "1m"), "5m")


def q_rollup_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.rollup(C.rollup(C.candles(_ticks(spark, sf_dir), PROXY_TICKS, "1m"), "5m"), "1h")


def _candle_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.candle_messages(C.candle_revisions(_ticks(spark, sf_dir), PROXY_TICKS, "1m"))


def _parsed_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = P.parse_candles(_candle_envelopes(spark, sf_dir))
    return parsed.where(F.col("bad_reason").isNull()).drop("bad_reason")


def q_store_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.store_rows(S.final_only(_parsed_candles(spark, sf_dir)))
    return rows.drop("storedAt")


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.live_rows(S.latest_state(_parsed_candles(spark, sf_dir)))


def q_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _live(spark, sf_dir)


def q_live_after_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: a batch that is written twice, and a day compacted between two batches, change nothing."""
    table = K.LiveTable(spark, CS.scratch_dir(spark, "live"))
    parsed = materialize(_parsed_candles(spark, sf_dir))
    odd = F.pmod(F.xxhash64("exchange", "symbol"), F.lit(2)) == 1
    table.append(parsed.where(odd), "q", 0)
    table.append(parsed.where(odd), "q", 0)
    table.compact(HISTORY_DATE)
    table.append(parsed.where(~odd), "q", 1)
    return table.read()


def q_live_after_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: the live stream run again over the same messages with a new checkpoint changes nothing."""
    base = CS.scratch_dir(spark, "live")
    files = CS.write_replay_files(_candle_envelopes(spark, sf_dir), f"{base}/source", steps=2)
    table = K.LiveTable(spark, f"{base}/live")
    for run in ("a", "b"):
        K.live_stream(replay_stream(spark, f"{base}/source", files), table, f"{base}/checkpoint-{run}").awaitTermination()
    return table.read()


def q_store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final candles streamed to the store under names that collide once cleaned (``x0/a`` and ``x0_a``), one
    day compacted, another written after it, read back."""
    base = CS.scratch_dir(spark, "store")
    revs = C.candle_revisions(_ticks(spark, sf_dir), PROXY_TICKS, "1m")
    sep = F.when(F.col("open_us") % 120_000_000 == 0, F.lit("/")).otherwise(F.lit("_"))
    named = revs.withColumn("symbol", F.concat("exchange", sep, "symbol"))
    files = CS.write_replay_files(S.candle_messages(named), f"{base}/source", steps=2)
    K.store_stream(replay_stream(spark, f"{base}/source", files), f"{base}/store", f"{base}/checkpoint").awaitTermination()
    S.compact_store(spark, f"{base}/store", HISTORY_DATE)
    S.compact_store(spark, f"{base}/store", HISTORY_DATE)
    return S.read_store(spark, f"{base}/store").drop("storedAt")


def q_store_late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: final candles appended to days that are compacted already (every third candle after the first compaction, every
    third after the second): all are read."""
    path = f"{CS.scratch_dir(spark, 'store')}/store"
    rows = materialize(S.store_rows(S.final_only(_parsed_candles(spark, sf_dir))))
    third = F.expr("kafkaOffset div 60000000") % 3
    for step in range(3):
        S.write_store(rows.where(third == step), path)
        if step < 2:
            S.compact_store(spark, path, HISTORY_DATE)
    read = S.read_store(spark, path).drop("storedAt")
    return read.withColumnsRenamed({f"path_{c}": f"_p_{c}" for c in ("exchange", "symbol", "timeframe")})


HISTORY_SYMBOL = "click"
HISTORY_DATE = "2024-01-15"


def q_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.history(_live(spark, sf_dir), HISTORY_SYMBOL, "1m", HISTORY_DATE)


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscribers derived from `nation`: symbols in mixed case, padded, blank or absent; timeframes likewise."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    k = F.col("n_nationkey")
    sym = (
        F.when(k % 8 == 0, F.lit(None)).when(k % 8 == 1, F.lit(" click ")).when(k % 8 == 2, F.lit("VIEW"))
        .when(k % 8 == 3, F.lit("")).when(k % 8 == 4, F.lit("purchase")).when(k % 8 == 5, F.lit("Signup"))
        .when(k % 8 == 6, F.lit("error")).otherwise(F.lit("nope"))
    )
    g = (k / 8).cast("int") % 4
    tf = F.when(g == 0, F.lit(None)).when(g == 1, F.lit("1m")).when(g == 2, F.lit(" 1m ")).otherwise(F.lit("5m"))
    return n.select(k.cast("string").alias("client_id"), sym.alias("symbol"), tf.alias("timeframe"))


def q_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = FD.route(_candle_envelopes(spark, sf_dir), subscriptions(spark, sf_dir))
    return r.select("client_id", "partition", "offset", "key")


CHART_SPLIT_US = 1705320000000000  # 2024-01-15 12:00 UTC: history before, live from one minute earlier on


def q_chart_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    revs = materialize(C.candle_revisions(_ticks(spark, sf_dir), PROXY_TICKS, "1m"))
    hist = S.candle_messages(revs.where(F.col("is_final") & (F.col("open_us") < CHART_SPLIT_US)))
    live = S.candle_messages(revs.where(F.col("open_us") >= CHART_SPLIT_US - 60_000_000))
    return FD.chart_series(hist, live)


def q_chart_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P27 over every final candle."""
    c = C.candles(_ticks(spark, sf_dir), PROXY_TICKS, "1m").withColumn("at", iso_instant(F.col("open_us")))
    at = F.when(F.col("tick_count") > 1, F.col("at"))
    return c.select("exchange", "symbol", "open_us", FD.price_label(F.col("close") / 100.0).alias("price"),
                    FD.axis_label((F.col("open_us") / 1_000_000).cast("long")).alias("axis"),
                    FD.update_label(at).alias("updated"), FD.date_label(at).alias("day"))


def q_feed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FD.feed_metrics(_candle_envelopes(spark, sf_dir), subscriptions(spark, sf_dir))


def q_feed_metrics_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 after loading history: final candles before the split, then the live revisions from it on."""
    revs = materialize(C.candle_revisions(_ticks(spark, sf_dir), PROXY_TICKS, "1m"))
    loaded = S.candle_messages(revs.where(F.col("is_final") & (F.col("open_us") < CHART_SPLIT_US)))
    live = S.candle_messages(revs.where((F.col("open_us") >= CHART_SPLIT_US) & (F.col("symbol") != "error")))
    return FD.feed_metrics(live, subscriptions(spark, sf_dir), loaded)


def q_history_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: the rows of the history (one symbol and day) as they come out, and whether each follows the one before."""
    out = S.history(_live(spark, sf_dir), HISTORY_SYMBOL, "1m", HISTORY_DATE).withColumn("_at", F.monotonically_increasing_id())
    before = F.lag("openTime").over(Window.orderBy("_at"))
    return out.select("exchange", "openTime", F.coalesce(before <= F.col("openTime"), F.lit(True)).alias("in_order"))


def q_history_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date parameters (given, missing, not a date, no such day) for every customer."""
    prepare(spark)
    k = F.col("c_custkey")
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 400).cast("int")), "yyyy-MM-dd")
    text = (F.when(k % 5 == 0, day).when(k % 5 == 1, F.lit(None)).when(k % 5 == 2, F.lit("2024-02-30"))
            .when(k % 5 == 3, F.concat(F.lit(" "), day)).otherwise(F.lit("today")))
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return c.select(k.alias("c_custkey"), resolve_date(text).cast("string").alias("day"))


def replay_input(spark: SparkSession, env: DataFrame, steps: int = 3) -> tuple[str, int]:
    """Envelopes as replay files: the folder of a run, and the files of a step."""
    base = CS.scratch_dir(spark, "replay")
    return base, CS.write_replay_files(env, f"{base}/source", steps)


def replayed(spark: SparkSession, base: str, files: int, per_tick: bool = False, timeframe: str | Sequence[str] = "1m") -> DataFrame:
    """The stream's output over replay files, step by step, until all are read."""
    run = CS.scratch_dir(spark, "run")
    CS.run_replay(spark, f"{base}/source", f"{run}/sink", f"{run}/checkpoint", timeframe, files_per_trigger=files, per_tick=per_tick)
    return spark.read.parquet(f"{run}/sink")


def drained(out: DataFrame) -> DataFrame:
    """A6 + W4 over the stream's output, in cents."""
    dec = lambda c: (F.col(c).cast("decimal(28,10)") * 100).cast("bigint")
    return CS.latest_candles(out).select(
        "exchange", "symbol", "currency", "timeframe", "open_us", "close_us",
        *[dec(x).alias(x) for x in ("open", "high", "low", "close")],
        F.col("volume").cast("decimal(28,10)").cast("bigint").alias("volume"), "tick_count",
    )


def q_candles_1m_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming candle builder over the proxy messages replayed in three arrival-ordered steps (three
    micro-batches), drained at the end; equal to the batch candles of the same messages."""
    return drained(replayed(spark, *replay_input(spark, tick_envelopes(_ticks(spark, sf_dir)))))


def q_candles_timeframes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 in the stream: the candles of every timeframe from one fold of the messages, drained at the end; equal to the
    batch candles of each timeframe."""
    return drained(replayed(spark, *replay_input(spark, tick_envelopes(_ticks(spark, sf_dir))), timeframe=tuple(TIMEFRAME_SECONDS)))


def q_feed_metrics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 over a stream: the candle messages replayed in three steps through the stateful counts, whose last state meets
    the subscriptions."""
    base, files = replay_input(spark, _candle_envelopes(spark, sf_dir))
    K.metrics_stream(replay_stream(spark, f"{base}/source", files), f"{base}/counts", f"{base}/checkpoint").awaitTermination()
    return FD.metrics_of(K.read_metric_counts(spark, f"{base}/counts"), subscriptions(spark, sf_dir))


def q_late_ticks_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 / W5 in the stream: every tick that the builder skipped."""
    out = CS.late_rows(replayed(spark, *replay_input(spark, tick_envelopes(_ticks(spark, sf_dir)))))
    cents = (F.col("price").cast("decimal(28,10)") * 100).cast("bigint")
    return out.select("exchange", "symbol", "event_us", F.col("open_us").alias("bucket"), cents.alias("price_c"))


def q_candles_lagging_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One instrument is read hours after all others (its messages come last): nothing of it is lost."""
    env = tick_envelopes(_ticks(spark, sf_dir))
    lag = F.when(F.col("key") == "x0:click", F.lit(1 << 40)).otherwise(0)
    return drained(replayed(spark, *replay_input(spark, env.withColumn("offset", F.col("offset") + lag))))


def moved_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every instrument moves from partition 2 to partition 1 half-way, where offsets start again."""
    env = tick_envelopes(_ticks(spark, sf_dir))
    half = env.agg((F.max("offset") / 2).cast("long")).first()[0] or 0
    first = F.col("offset") < half
    return env.withColumns({"partition": F.when(first, 2).otherwise(1), "offset": F.when(first, F.col("offset")).otherwise(F.col("offset") - half)})


def q_candles_moved_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = C.candles(P.good_ticks(P.parse_ticks(moved_envelopes(spark, sf_dir))), ENVELOPE_TICKS.with_chunk(256), "1m")
    return _candles_in_cents(c)


def q_candles_moved_partition_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drained(replayed(spark, *replay_input(spark, moved_envelopes(spark, sf_dir), steps=1)))


def q_candles_1m_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 512 arrivals: candles and late ticks run across many of them."""
    return C.candles(_ticks(spark, sf_dir), PROXY_TICKS.with_chunk(512), "1m")


def q_candle_revisions_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _revision_columns(C.candle_revisions(_ticks(spark, sf_dir), PROXY_TICKS.with_chunk(512), "1m"))


def q_oi_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return O.select_chain(option_proxy(spark, sf_dir), max_expiries=2, strikes_per_expiry=10).select(
        "underlying", "snapshot_date", "expiry", "strike", "right", "open_interest", "arrival"
    )


def q_oi_put_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    r = O.put_call_ratio(option_proxy(spark, sf_dir))
    # the ratio compared exactly, in parts per million (floor)
    ppm = F.when(F.col("call_oi") > 0, F.expr("(put_oi * 1000000) div call_oi"))
    return r.select("underlying", "snapshot_date", "call_oi", "put_oi", ppm.alias("put_call_ppm"))


def q_learning_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The learning producer's messages for every `events` row, as the consumer prints them."""
    prepare(spark)
    return received_records(learning_events(spark.read.parquet(f"{sf_dir}/events.parquet")))


def q_oi_from_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + A7: the ratio series computed from option OI messages (JSON round trip of the snapshots)."""
    prepare(spark)
    snaps = O.parse_option_snapshots(option_envelopes(option_proxy(spark, sf_dir)))
    r = O.put_call_ratio(snaps)
    ppm = F.when(F.col("call_oi") > 0, F.expr("(put_oi * 1000000) div call_oi"))
    return r.select("underlying", "snapshot_date", "call_oi", "put_oi", ppm.alias("put_call_ppm"))


def moved_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option messages of a topic that grew half-way: the later snapshots of every contract are in partition 1, where
    offsets start again, below those of partition 2. Record times rise with the arrivals."""
    env = option_envelopes(option_proxy(spark, sf_dir))
    half = env.agg((F.max("offset") / 2).cast("long")).first()[0] or 0
    first = F.col("offset") < half
    return env.withColumns({"partition": F.when(first, 2).otherwise(1), "offset": F.when(first, F.col("offset")).otherwise(F.col("offset") - half),
                            "timestamp": F.timestamp_seconds(F.lit(1779700000) + F.col("offset"))})


def _ratio_parts(ratio: DataFrame) -> DataFrame:
    ppm = F.when(F.col("call_oi") > 0, F.expr("(put_oi * 1000000) div call_oi"))
    return ratio.select("underlying", "snapshot_date", "call_oi", "put_oi", ppm.alias("put_call_ppm"))


def q_oi_moved_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + A7: the ratio follows the arrivals, not the offsets, when contracts move to another partition."""
    prepare(spark)
    return _ratio_parts(O.put_call_ratio(O.parse_option_snapshots(moved_options(spark, sf_dir))))


def q_oi_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the messages of a moved topic through the stream into the tables, in two steps; the stored ratio."""
    prepare(spark)
    base = CS.scratch_dir(spark, "options")
    env = materialize(moved_options(spark, sf_dir))
    for part in (2, 1):
        env.where(F.col("partition") == part).repartition(CS.REPLAY_FILES).write.mode("append").parquet(f"{base}/source")
    O.options_stream(replay_stream(spark, f"{base}/source", CS.REPLAY_FILES), f"{base}/tables", f"{base}/checkpoint").awaitTermination()
    return _ratio_parts(O.read_ratio(spark, f"{base}/tables"))


def _half_strikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    half = (F.lit(100) + F.col("arrival") % 40 * F.lit(2.5)).cast("decimal(10,1)")
    return option_envelopes(option_proxy(spark, sf_dir).withColumn("strike", half))


def q_oi_half_strikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 / O2 on strikes such as 102.5, from messages."""
    snaps = O.parse_option_snapshots(_half_strikes(spark, sf_dir))
    return O.select_chain(snaps, max_expiries=2, strikes_per_expiry=10).select(
        "underlying", "snapshot_date", "expiry", (F.col("strike") * 10).cast("bigint").alias("strike_tenths"), "right",
        "open_interest", "arrival")


def q_oi_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 for options: messages broken by rule, and why."""
    n = F.col("offset")
    value = (F.when(n % 7 == 0, F.substring("value", 1, 20)).when(n % 7 == 1, F.lit("[1]"))
             .when(n % 7 == 2, F.regexp_replace("value", "OpenInterest", "Other")).otherwise(F.col("value")))
    key = F.when(n % 7 == 3, F.lit("x")).otherwise(F.col("key"))
    value = F.when(n % 7 == 3, F.regexp_replace("value", '"right":"[CP]"', '"right":"X"')).otherwise(value)
    env = _half_strikes(spark, sf_dir).withColumns({"value": value, "key": key})
    return O.bad_option_records(env).select("topic", "partition", "offset", "key", "reason")


def q_snapshot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor snapshots -> producer messages."""
    raw = raw_snapshots(_ticks(spark, sf_dir))
    return Q.snapshot_events(raw).select(
        "key", "source", "symbol", "bid", "bidSize", "ask", "askSize", "last", "lastSize", "close", "volume",
        "sourceTimestamp", "publishedAt", "session", "isPremarket", "conId", "primaryExchange")


def q_candle_revisions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 / W2 streaming: one revision per accepted tick and one close per superseded candle, from the keyed-state
    stream over three replay steps (no drain: each instrument's last candle stays open)."""
    out = CS.candle_rows(replayed(spark, *replay_input(spark, tick_envelopes(_ticks(spark, sf_dir))), per_tick=True))
    dec = lambda c: (F.col(c).cast("decimal(28,10)") * 100).cast("bigint")
    return out.select(
        "exchange", "symbol", "open_us", "is_final", "tick_count",
        *[dec(x).alias(x) for x in ("open", "high", "low", "close")],
        F.col("volume").cast("decimal(28,10)").cast("bigint").alias("volume"),
    )


QUERIES: dict[str, Query] = {
    "candles_1m": q_candles_1m,
    "late_ticks": q_late_ticks,
    "parse_ticks": q_parse_ticks,
    "bad_records": q_bad_records,
    "price_source": q_price_source,
    "candles_1m_parsed": q_candles_1m_parsed,
    "session_label": q_session_label,
    "quote_changes": q_quote_changes,
    "quote_throttle": q_quote_throttle,
    "quote_throttle_stream": q_quote_throttle_stream,
    "candle_revisions": q_candle_revisions,
    **{f"candles_{tf}": _timeframe_query(tf) for tf in ("1s", "5m", "15m", "1h", "1d")},
    "rollup_5m": q_rollup_5m,
    "rollup_1h": q_rollup_1h,
    "store_rows": q_store_rows,
    "latest_state": q_latest_state,
    "history": q_history,
    "route": q_route,
    "chart_series": q_chart_series,
    "feed_metrics": q_feed_metrics,
    "feed_metrics_history": q_feed_metrics_history,
    "candles_1m_stream": q_candles_1m_stream,
    "candles_timeframes_stream": q_candles_timeframes_stream,
    "feed_metrics_stream": q_feed_metrics_stream,
    "late_ticks_stream": q_late_ticks_stream,
    "candles_lagging_stream": q_candles_lagging_stream,
    "candles_moved_partition": q_candles_moved_partition,
    "candles_moved_partition_stream": q_candles_moved_partition_stream,
    "candles_1m_chunks": q_candles_1m_chunks,
    "candle_revisions_chunks": q_candle_revisions_chunks,
    "chart_labels": q_chart_labels,
    "history_rank": q_history_rank,
    "history_dates": q_history_dates,
    "oi_half_strikes": q_oi_half_strikes,
    "oi_bad_records": q_oi_bad_records,
    "live_after_retry": q_live_after_retry,
    "live_after_restart": q_live_after_restart,
    "store_roundtrip": q_store_roundtrip,
    "store_late_arrivals": q_store_late_arrivals,
    "oi_moved_partition": q_oi_moved_partition,
    "oi_tables": q_oi_tables,
    "oi_selection": q_oi_selection,
    "oi_put_call": q_oi_put_call,
    "learning_events": q_learning_events,
    "oi_from_messages": q_oi_from_messages,
    "snapshot_events": q_snapshot_events,
    "candle_revisions_stream": q_candle_revisions_stream,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
