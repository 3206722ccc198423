"""Deterministic tick and option proxies derived from the test tables (see FIXTURES.md).

`events` becomes a quote stream: 30 days are compressed into the 12 hours 2024-01-15 06:00-18:00 UTC, an
arrival order that differs from event time is derived, and nulls, cumulative-volume resets and missing prices
are planted. Everything stays integer (cents, micros) so results compare exactly. `part` becomes option
open-interest snapshots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the proxy definition (FIXTURES.md §2, §3)
PROXY_DAY_START_US = 1705298400000000  # 2024-01-15 06:00:00 UTC
EVENTS_START_US = 1704067200000000  # 2024-01-01 00:00:00 UTC
TIME_COMPRESSION = 60
OPTION_FIRST_EXPIRY = "2026-06-19"
OPTION_FIRST_SNAPSHOT = "2026-05-25"
OPTION_UNDERLYING_PRICE = 195


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tick_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns: symbol, exchange, event_id, arrival, ts_us, price_c, cum, size, last_c, bid_c, ask_c, close_c."""
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    e = ev.select(
        F.col("event_type").alias("symbol"),
        F.concat(F.lit("x"), (F.col("user_id") % 2).cast("string")).alias("exchange"),
        eid,
        (
            eid
            + F.when(eid % 7 == 3, F.lit(12)).otherwise(F.lit(0))
            + F.when(eid % 11 == 5, F.lit(150)).otherwise(F.lit(0))
        ).alias("arrival"),
        (
            F.lit(PROXY_DAY_START_US)
            + F.expr(f"(unix_micros(cast(ts as timestamp)) - {EVENTS_START_US}) div {TIME_COMPRESSION}")
        ).alias("ts_us"),
        F.round(F.col("value") * 100).cast("bigint").alias("price_c"),
        F.when(eid % 5 == 0, F.lit(None)).otherwise((eid * 10) % 100000).alias("cum"),
        (eid % 4).alias("size"),
    )
    p = F.col("price_c")
    return e.select(
        "*",
        F.when(eid % 6 == 0, F.lit(None)).otherwise(p).alias("last_c"),
        F.when(eid % 4 == 2, F.lit(-1)).otherwise(p - 1).alias("bid_c"),
        (p + 3).alias("ask_c"),
        F.when(eid % 24 == 6, F.lit(None)).otherwise(p + 10).alias("close_c"),
    )


def proxy_offset() -> F.Column:
    """An arrival-ordered, unique Kafka-style offset for proxy rows without a global sort.

    arrival − event_id is one of 0, 12, 150, 162, so rows that share an arrival differ in that delay; a larger
    delay means a smaller event_id, which must come first. Offsets may have gaps, as Kafka's may.
    """
    delay = F.col("arrival") - F.col("event_id")
    slot = (
        F.when(delay == 162, 0).when(delay == 150, 1).when(delay == 12, 2).otherwise(3)
    )
    return F.col("arrival") * 4 + slot


def option_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option open-interest snapshots: arrival, underlying, expiry, strike, right, snapshot_date, open_interest,
    underlying_price."""
    part = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return part.select(
        k.alias("arrival"),
        F.col("p_brand").alias("underlying"),
        F.date_add(F.lit(OPTION_FIRST_EXPIRY).cast("date"), ((k % 8) * 7).cast("int")).alias("expiry"),
        (F.lit(100) + F.lit(5) * (k % 40)).cast("int").alias("strike"),
        F.when(k % 2 == 0, F.lit("C")).otherwise(F.lit("P")).alias("right"),
        F.date_add(F.lit(OPTION_FIRST_SNAPSHOT).cast("date"), (F.col("p_size") % 3).cast("int")).alias("snapshot_date"),
        ((k * 37) % 1000).alias("open_interest"),
        F.lit(OPTION_UNDERLYING_PRICE).cast("int").alias("underlying_price"),
    )


def raw_snapshots(ticks: DataFrame) -> DataFrame:
    """Vendor quote snapshots as the producer receives them, from proxy ticks: float prices with NaN for missing
    values, fractional sizes, and no quote time on every 13th row (``time_us`` null; ``published_us`` is the
    producer's clock, 5 ms after the quote)."""
    nan = F.lit(float("nan"))
    px = lambda c: F.coalesce(F.col(c) / F.lit(100.0), nan)
    eid = F.col("event_id")
    return ticks.select(
        "event_id", "symbol", F.lit("EUR").alias("currency"), F.lit("SMART").alias("ib_exchange"),
        F.when(F.col("exchange") == "x0", F.lit("AEB")).alias("primary_exchange"),
        (F.lit(1000) + F.col("event_id") % 5).alias("con_id"),
        px("bid_c").alias("bid"), F.lit(100.0).alias("bid_size"),
        px("ask_c").alias("ask"), F.lit(200.0).alias("ask_size"),
        px("last_c").alias("last"), (F.col("size") + F.lit(0.5)).cast("double").alias("last_size"),
        px("close_c").alias("close"), F.coalesce(F.col("cum").cast("double"), nan).alias("volume"),
        F.when(eid % 13 == 0, F.lit(None)).otherwise(F.col("ts_us")).alias("time_us"),
        (F.col("ts_us") + F.lit(5000)).alias("published_us"),
    )


def option_envelopes(options: DataFrame) -> DataFrame:
    """Option OI snapshot messages (key ``underlying:expiry:strike:right``) from the option proxy."""
    key = F.concat_ws(":", "underlying", F.col("expiry").cast("string"), F.col("strike").cast("string"), "right")
    oi = F.col("open_interest")
    msg = F.struct(
        F.lit("ibkr.option_oi").alias("event"), "underlying", F.col("expiry").cast("string").alias("expiry"),
        "strike", F.col("right").alias("right"), F.col("snapshot_date").cast("string").alias("snapshotDate"),
        F.when(F.col("right") == "C", oi).alias("callOpenInterest"),
        F.when(F.col("right") == "P", oi).alias("putOpenInterest"),
        F.col("underlying_price").alias("underlyingPrice"),
    )
    return options.select(
        key.alias("key"), F.to_json(msg).alias("value"), F.lit("market.options.oi.snapshot").alias("topic"),
        F.lit(0).cast("int").alias("partition"), F.col("arrival").alias("offset"),
        F.col("snapshot_date").cast("timestamp").alias("timestamp"),
    )
