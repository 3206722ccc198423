"""Messages -> typed rows, and the split of records that do not parse.

One parse per record (``try_parse_json`` to VARIANT), one extraction per field, typed getters, then a reason
column: good rows have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import json_fields as J
from ..functions.text import key_part
from ..schema import PRICE

TICK_FIELDS = ("exchange", "symbol", "currency", "bid", "ask", "last", "close", "lastSize", "volume",
               "sourceTimestamp", "publishedAt")

CANDLE_FIELDS = ("event", "exchange", "symbol", "currency", "timeframe", "openTime", "closeTime", "open", "high",
                 "low", "close", "volume", "tickCount", "isFinal", "publishedAt")


def parse_ticks(envelopes: DataFrame) -> DataFrame:
    """Envelope -> tick columns ``exchange, symbol, currency, price, size, cumulative_volume, event_us,
    price_source`` plus ``bad_reason`` (null for a tick). The envelope columns are kept."""
    key = F.col("key")
    x = J.extract(J.parse(envelopes), TICK_FIELDS)
    x = x.select(
        *envelopes.columns,
        F.col(J.VARIANT).isNotNull().alias("_json"),
        "_is_object",
        # P5: field -> key part -> "unknown" (exchange); field -> key part (symbol)
        F.coalesce(J.string_field("exchange"), key_part(key, 0), F.lit("unknown")).alias("exchange"),
        F.coalesce(J.string_field("symbol"), key_part(key, 1)).alias("symbol"),
        J.string_field("currency").alias("currency"),
        J.decimal_field("bid").alias("_bid"),
        J.decimal_field("ask").alias("_ask"),
        J.decimal_field("last").alias("_last"),
        J.decimal_field("close").alias("_close"),
        F.coalesce(J.decimal_field("lastSize"), F.lit(0).cast(PRICE)).alias("size"),  # P9
        J.decimal_field("volume").alias("cumulative_volume"),
        # sourceTimestamp -> publishedAt -> record timestamp (millis)
        F.coalesce(
            J.instant_us("sourceTimestamp"),
            J.instant_us("publishedAt"),
            F.unix_millis(F.col("timestamp")) * 1000,
        ).alias("event_us"),
    )
    # Midpoint only when both sides are positive; P6: last -> midpoint -> close
    bid, ask, last, close = F.col("_bid"), F.col("_ask"), F.col("_last"), F.col("_close")
    x = x.withColumn("_mid", F.when((bid > 0) & (ask > 0), ((bid + ask) / 2).cast(PRICE)))
    mid = F.col("_mid")
    x = x.withColumn("price", F.coalesce(last, mid, close)).withColumn(
        "price_source",
        F.when(last.isNotNull(), "last").when(mid.isNotNull(), "midpoint").when(close.isNotNull(), "close"),
    )
    reason = (
        F.when(~F.col("_json"), "not_json")
        .when(~F.col("_is_object"), "not_object")
        .when(F.col("symbol").isNull(), "no_symbol")
        .when(F.col("price").isNull(), "no_price")
    )
    return J.settle(
        x.withColumn("bad_reason", reason).drop("_json", "_is_object", "_bid", "_ask", "_last", "_close", "_mid")
    )


def good_ticks(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("bad_reason").isNull()).drop("bad_reason")


def bad_records(parsed: DataFrame) -> DataFrame:
    """the records the parser skips, with their coordinates, for a dead-letter table."""
    return parsed.where(F.col("bad_reason").isNotNull()).select(
        "topic", "partition", "offset", "key", "value", F.col("bad_reason").alias("reason")
    )


def parse_candles(envelopes: DataFrame) -> DataFrame:
    """Candle messages -> stored-candle fields (text OHLCV as received) plus ``bad_reason``.

    Required: exchange, symbol, timeframe (strings, empty allowed), openTime, closeTime (instants), open, high,
    low, close (string or number). Defaults: event ``candle``, volume ``0``, tickCount 0, isFinal false,
    publishedAt ``""``; an empty currency is missing. Q11: OHLCV text that is not a number is reported as
    ``not_numeric`` rather than stored.
    """
    x = J.extract(J.parse(envelopes), CANDLE_FIELDS)
    s = lambda n: J.string_field(n, allow_empty=True)
    sn = J.string_or_number_field
    x = x.select(
        *envelopes.columns,
        F.col(J.VARIANT).isNotNull().alias("_json"),
        "_is_object",
        F.coalesce(s("event"), F.lit("candle")).alias("event"),
        s("exchange").alias("exchange"),
        s("symbol").alias("symbol"),
        F.nullif(s("currency"), F.lit("")).alias("currency"),
        s("timeframe").alias("timeframe"),
        J.instant_us("openTime").alias("open_us"),
        J.instant_us("closeTime").alias("close_us"),
        sn("open").alias("open"),
        sn("high").alias("high"),
        sn("low").alias("low"),
        sn("close").alias("close"),
        F.coalesce(sn("volume"), F.lit("0")).alias("volume"),
        F.coalesce(J.long_field("tickCount"), F.lit(0).cast("long")).alias("tickCount"),
        F.coalesce(J.boolean_field("isFinal"), F.lit(False)).alias("isFinal"),
        F.coalesce(s("publishedAt"), F.lit("")).alias("publishedAt"),
    )
    required = ["exchange", "symbol", "timeframe", "open_us", "close_us", "open", "high", "low", "close"]
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    numeric = F.lit(True)
    for c in ["open", "high", "low", "close", "volume"]:
        numeric = numeric & F.col(c).try_cast(PRICE).isNotNull()
    reason = (
        F.when(~F.col("_json"), "not_json")
        .when(~F.col("_is_object"), "not_object")
        .when(missing, "missing_field")
        .when(~numeric, "not_numeric")
    )
    return J.settle(x.withColumn("bad_reason", reason).drop("_json", "_is_object"))
