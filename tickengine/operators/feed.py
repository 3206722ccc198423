"""The live feed and the chart's data rules.

Routing (H2) sends every candle message to every subscription whose symbol (case-insensitive) and timeframe
match, a null subscription field matching anything; a message without routing fields goes only to
subscriptions with neither field. The reference loops over all clients per message; here the theta condition
becomes one null-safe equi-join on subscription patterns (see :func:`route`). The join strategy is left to
the optimizer: AQE turns it into a broadcast when the runtime size of the subscriptions is below the broadcast
threshold (a checked size), and keeps a sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import json_fields as J
from .chunks import last_by_arrival

# The chart's volume bar colours
UP_COLOUR = "#26a69a"
DOWN_COLOUR = "#ef5350"

STREAM_SALT = 8


def normalize_subscriptions(subs: DataFrame) -> DataFrame:
    """Symbol trimmed and upper-cased, timeframe trimmed, blanks become wildcards (null)."""
    return subs.select(
        "client_id",
        F.nullif(F.upper(F.trim(F.col("symbol"))), F.lit("")).alias("sub_symbol"),
        F.nullif(F.trim(F.col("timeframe")), F.lit("")).alias("sub_timeframe"),
    )


def routing_fields(messages: DataFrame) -> DataFrame:
    """``route_symbol`` (upper-cased) and ``route_timeframe`` from the message JSON: both non-empty strings,
    or both null."""
    x = J.extract(J.parse(messages), ("symbol", "timeframe"))
    sym, tf = J.string_field("symbol"), J.string_field("timeframe")
    both = sym.isNotNull() & tf.isNotNull()
    x = x.select(*messages.columns, F.when(both, F.upper(sym)).alias("route_symbol"), F.when(both, tf).alias("route_timeframe"))
    return J.settle(x)


def route(messages: DataFrame, subscriptions: DataFrame, salt: int | None = None) -> DataFrame:
    """One row per (subscription, message) to deliver: ``client_id`` plus the message columns.
    ``messages`` may be a stream."""
    return deliver(routing_fields(messages), subscriptions, messages.columns, salt)


def deliver(m: DataFrame, subscriptions: DataFrame, columns: list[str], salt: int | None = None) -> DataFrame:
    """``columns`` of the rows of ``m`` (with ``route_symbol`` and ``route_timeframe``) for every subscription that
    matches.

    Every subscription has one pattern (symbol or null, timeframe or null). A message can only match four
    patterns: (symbol, timeframe), (symbol, null), (null, timeframe), (null, null) -- or just (null, null) when
    it has no routing fields. So the theta join becomes one null-safe equi-join of the messages' patterns with
    the subscriptions' patterns, reading the messages once. A hot symbol or the all-wildcard pattern makes a skewed
    partition, which AQE splits at run time: only that partition's subscriptions are read by several tasks, so the
    subscriptions are never copied for the sake of patterns that are not hot. Micro-batches of a stream are not planned
    anew at run time: there messages carry a hash salt over ``salt`` tasks (default ``STREAM_SALT``, whatever the number
    of shuffle partitions) and the subscriptions are repeated per salt.
    """
    salt = salt or (STREAM_SALT if m.isStreaming else 1)
    s = normalize_subscriptions(subscriptions)
    cols = [F.col(c) for c in columns]
    rs, rt = F.col("route_symbol"), F.col("route_timeframe")
    none = F.lit(None).cast("string")
    # which wildcard classes exist (at most four rows): messages only emit patterns some subscription can have
    classes = {(r[0], r[1]) for r in s.select(F.col("sub_symbol").isNotNull(), F.col("sub_timeframe").isNotNull())
               .distinct().collect()}
    wanted = [(True, True, rs, rt), (True, False, rs, none), (False, True, none, rt), (False, False, none, none)]
    parsed_patterns = [F.struct(a.alias("p_symbol"), b.alias("p_timeframe"))
                       for has_sym, has_tf, a, b in wanted if (has_sym, has_tf) in classes]
    wildcard = [F.struct(none.alias("p_symbol"), none.alias("p_timeframe"))] if (False, False) in classes else []
    if not classes:
        return m.select(F.lit(None).cast("string").alias("client_id"), *cols).where(F.lit(False))
    # a message without routing fields only reaches all-wildcard subscriptions (null: no rows after explode)
    patterns = F.when(rs.isNotNull(), F.array(*parsed_patterns)).otherwise(
        F.array(*wildcard) if wildcard else F.lit(None))
    salted = [F.pmod(F.xxhash64(*cols), F.lit(int(salt))).alias("_salt")] if salt > 1 else []
    probes = m.select(*cols, *salted, F.explode(patterns).alias("_p")).select(
        *cols, *(["_salt"] if salted else []), "_p.p_symbol", "_p.p_timeframe")
    copies = [F.explode(F.sequence(F.lit(0), F.lit(int(salt) - 1))).alias("_salt")] if salted else []
    subs = s.select("client_id", "sub_symbol", "sub_timeframe", *copies)
    cond = probes.p_symbol.eqNullSafe(subs.sub_symbol) & probes.p_timeframe.eqNullSafe(subs.sub_timeframe)
    if salted:
        cond = cond & (probes._salt == subs._salt)
    return probes.join(subs, cond).select("client_id", *cols)


INSTRUMENT = ["exchange", "symbol", "timeframe"]


def _points(messages: DataFrame) -> DataFrame:
    """P21, P25 / P26 on every message, from one settled parse: the instrument, routing fields, ``time``, OHLC,
    ``volume``, ``color`` and ``_ok`` (the chart accepts it), and the close / openTime / publishedAt texts. Prices may
    be text or JSON numbers."""
    names = ("openTime", "open", "high", "low", "close", "volume", "publishedAt")
    x = J.extract(J.parse(messages), (*names, *INSTRUMENT))
    text = ("openTime", "publishedAt")
    read = lambda n: J.string_field(n, allow_empty=True) if n in text else J.string_or_number_field(n)
    sym, tf = J.string_field("symbol"), J.string_field("timeframe")
    both = sym.isNotNull() & tf.isNotNull()
    inst = [J.string_field(n, allow_empty=True).alias(n) for n in INSTRUMENT]
    x = x.select(*messages.columns, *inst, F.when(both, F.upper(sym)).alias("route_symbol"), F.when(both, tf).alias("route_timeframe"),
                 *[read(n).alias(f"_{n}") for n in names])
    num = lambda c: F.trim(F.col(c)).try_cast("double")
    ts = F.col("_openTime").try_cast("timestamp")
    x = x.select(
        *messages.columns, *INSTRUMENT, "route_symbol", "route_timeframe",
        F.col("_close").alias("last_close"), F.col("_openTime").alias("last_open_time"), F.col("_publishedAt").alias("last_update"),
        F.floor(F.unix_micros(ts) / 1_000_000).cast("long").alias("time"),
        *[F.when(F.col(f"_{n}") != "", num(f"_{n}")).alias(n) for n in ("open", "high", "low", "close")],
        F.when(F.col("_volume").isNull(), F.lit(0.0)).otherwise(F.coalesce(num("_volume"), F.lit(float("nan"))))
        .alias("volume"),
    )
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    ok = F.col("time").isNotNull()
    for c in ("open", "high", "low", "close"):
        ok = ok & finite(c)
    # Number(volume ?? "0") || 0: NaN (unparsable) becomes 0, +-Infinity stays
    x = x.withColumn("volume", F.when(F.col("volume").isNull() | F.isnan("volume"), F.lit(0.0)).otherwise(F.col("volume")))
    x = x.withColumn("color", F.when(F.col("close") >= F.col("open"), F.lit(UP_COLOUR)).otherwise(F.lit(DOWN_COLOUR)))
    return J.settle(x.withColumn("_ok", ok))


def chart_points(messages: DataFrame) -> DataFrame:
    """Candle messages -> chart points of their instrument. Dropped: missing or empty openTime / OHLC, or any
    value that is not a finite number. time = floor(epoch seconds of openTime); volume that is not a number is 0."""
    return _points(messages).where(F.col("_ok")).drop("_ok", "route_symbol", "route_timeframe", "last_close", "last_open_time", "last_update")


def chart_series(history: DataFrame, live: DataFrame) -> DataFrame:
    """The bars of every instrument's chart after loading ``history`` then applying ``live`` messages: per
    instrument and bar time the last message wins (history first, then live in arrival order). Both inputs are candle
    message envelopes."""
    h = chart_points(history).withColumn("_src", F.lit(0))
    lv = chart_points(live).withColumn("_src", F.lit(1))
    bar = F.struct("open", "high", "low", "close", "volume", "color")
    last = last_by_arrival(h.unionByName(lv), [*INSTRUMENT, "time"], INSTRUMENT, bar, F.unix_micros("timestamp"), ("_src",), ("key",))
    return last.select(*INSTRUMENT, "time", "_l.*")


_LAST = ("last_close", "last_open_time", "last_update")


def metric_counts(messages: DataFrame) -> DataFrame:
    """A8 ahead of the subscriptions: per routing fields and partition, the messages the chart accepted (``_n``), the last
    of them by offset (``_l``, ``_at``) and the first record time (``_seen``). ``messages`` may be a stream (update mode)."""
    at = F.struct("offset", "key")
    return _points(messages).where(F.col("_ok")).groupBy("route_symbol", "route_timeframe", "partition").agg(
        F.count(F.lit(1)).alias("_n"), F.max_by(F.struct(*_LAST), at).alias("_l"), F.max(at).alias("_at"), F.min("timestamp").alias("_seen"))


def feed_metrics(messages: DataFrame, subscriptions: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Per subscriber, the number of messages the chart accepted (those that parse into a candle point) and the
    latest accepted message's close, open time and publish time.

    ``history`` (candle envelopes that were loaded before the feed started) sets what a subscriber starts from: all its
    rows count, if the chart accepts one of them, and its last candle by open time is the last message until a live one
    comes. Messages are parsed once and folded by routing fields (partial aggregates) before any are copied to
    subscribers, so what is delivered is a row per symbol and timeframe."""
    return metrics_of(metric_counts(messages), subscriptions, history)


def metrics_of(counts: DataFrame, subscriptions: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """:func:`feed_metrics` from the rows of :func:`metric_counts`, which a stream may have kept."""
    last = F.struct(*_LAST)
    at = F.struct("offset", "key")
    per = counts.withColumn("_seen", F.min("_seen").over(Window.partitionBy("partition")))
    # live after history; partitions by their first record, then offsets
    pos = F.struct(F.lit(1).alias("src"), F.lit("").alias("open"), "_seen", "partition", "_at")
    per_key = per.groupBy("route_symbol", "route_timeframe").agg(
        F.sum("_n").alias("_n"), F.lit(True).alias("_any"), F.max_by("_l", pos).alias("_l"), F.max(pos).alias("_pos"))
    if history is not None:
        loaded = _points(history)
        pos = F.struct(F.lit(0).alias("src"), F.coalesce("last_open_time", F.lit("")).alias("open"), F.col("timestamp").alias("_seen"),
                       "partition", at.alias("_at"))
        loaded = loaded.groupBy("route_symbol", "route_timeframe").agg(
            F.count(F.lit(1)).alias("_n"), F.max("_ok").alias("_any"), F.max_by(last, pos).alias("_l"), F.max(pos).alias("_pos"))
        per_key = per_key.unionByName(loaded)
    got = deliver(per_key, subscriptions, ["_n", "_any", "_l", "_pos"])
    live = F.col("_pos.src") == 1
    out = got.groupBy("client_id").agg(
        F.sum("_n").alias("_all"), F.coalesce(F.sum(F.when(live, F.col("_n"))), F.lit(0)).alias("_live"), F.max(F.col("_any")).alias("_any"),
        F.coalesce(F.max(F.when(~live, F.col("_any"))), F.lit(False)).alias("_loaded"), F.max_by("_l", "_pos").alias("_l"))
    return out.where("_any").select("client_id", F.when(F.col("_loaded"), F.col("_all")).otherwise(F.col("_live")).alias("message_count"), "_l.*")


def price_label(c: Column) -> Column:
    """Price with two decimals (fixed locale: '.' decimal point, ',' thousands)."""
    return F.format_number(c, 2)


def axis_label(epoch_s: Column) -> Column:
    """HH:mm axis label (UTC)."""
    return F.date_format(F.timestamp_seconds(epoch_s), "HH:mm")


def update_label(ts_text: Column) -> Column:
    """HH:mm:ss of the last update, or 'No updates'."""
    t = ts_text.try_cast("timestamp")
    return F.coalesce(F.date_format(t, "HH:mm:ss"), F.lit("No updates"))


def date_label(ts_text: Column) -> Column:
    """Long date (e.g. 'Monday, January 15, 2024'), or 'No date'."""
    t = ts_text.try_cast("timestamp")
    return F.coalesce(F.date_format(t, "EEEE, MMMM d, yyyy"), F.lit("No date"))
