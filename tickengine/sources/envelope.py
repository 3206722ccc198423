"""Record envelopes (key, value, topic, partition, offset, timestamp).

On a cluster the envelopes come from Kafka (``kafka_*``); anywhere else from envelope files written with the same
schema (``replay_*``), so every operator downstream is identical. The proxy builders turn the test tables into
envelopes whose values are the producer's JSON messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import iso_instant
from ..schema import ENVELOPE
from .proxy import proxy_offset

# Topic names
RAW_TICKS_TOPIC = "market.trades.raw"
CANDLES_TOPIC = "market.candles.1m"
OPTIONS_TOPIC = "market.options.oi.snapshot"
LEARNING_TOPIC = "learning-events"


def kafka_batch(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """S1/S2/S4 as a bounded read (Kafka connector package required on the cluster)."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
        .select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "topic",
            "partition",
            "offset",
            "timestamp",
        )
    )


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S1/S2 (``earliest``) and S3 (``latest``) as a stream; offsets live in the query checkpoint."""
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def replay_batch(spark: SparkSession, path: str) -> DataFrame:
    """Envelope files as a bounded input (folders inside ``path`` too)."""
    return spark.read.schema(ENVELOPE).option("recursiveFileLookup", "true").parquet(path)


def replay_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Envelope files as a stream (one file = one or more micro-batches)."""
    r = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def _cents(c: str):
    return (F.col(c) / 100).cast("decimal(20,2)")


def tick_envelopes(ticks: DataFrame, topic: str = RAW_TICKS_TOPIC) -> DataFrame:
    """M2 producer messages from proxy ticks: key ``exchange:symbol``, prices in units (cents / 100), sizes and
    the cumulative volume as integers, ``sourceTimestamp`` / ``publishedAt`` as ISO instants."""
    when = iso_instant(F.col("ts_us"))
    msg = F.struct(
        F.lit("ibkr.market_tick").alias("event"),
        F.concat_ws(":", F.lit("ibkr"), "symbol", F.lit("EUR"), "exchange").alias("source"),
        F.col("exchange").alias("exchange"),
        F.col("symbol").alias("symbol"),
        F.lit("EUR").alias("currency"),
        F.col("exchange").alias("ibExchange"),
        _cents("bid_c").alias("bid"),
        F.lit(100).alias("bidSize"),
        _cents("ask_c").alias("ask"),
        F.lit(100).alias("askSize"),
        _cents("last_c").alias("last"),
        F.col("size").alias("lastSize"),
        _cents("close_c").alias("close"),
        F.col("cum").alias("volume"),
        when.alias("sourceTimestamp"),
        when.alias("publishedAt"),
    )
    return ticks.select(
        F.concat_ws(":", "exchange", "symbol").alias("key"),
        F.to_json(msg, {"ignoreNullFields": "false"}).alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).cast("int").alias("partition"),
        proxy_offset().alias("offset"),
        F.timestamp_micros(F.col("ts_us")).alias("timestamp"),
    )


def learning_events(events: DataFrame, topic: str = LEARNING_TOPIC) -> DataFrame:
    """The learning producer's messages, one per row of ``events`` (n = event_id + 1): key
    ``user-{n % 3}``, value ``{"event":"page_view","count":n,"at":<instant>}``."""
    n = F.col("event_id") + 1
    at = iso_instant(F.unix_micros(F.col("ts").cast("timestamp")))
    return events.select(
        F.concat(F.lit("user-"), (n % 3).cast("string")).alias("key"),
        F.to_json(F.struct(F.lit("page_view").alias("event"), n.alias("count"), at.alias("at"))).alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def generated_events(spark: SparkSession, count: int = 10, topic: str = LEARNING_TOPIC) -> DataFrame:
    """The learning producer's own generator, n = 1..count (default 10), stamped with the current time."""
    n = F.col("id")
    at = iso_instant(F.unix_micros(F.current_timestamp()))
    return spark.range(1, int(count) + 1).select(
        F.concat(F.lit("user-"), (n % 3).cast("string")).alias("key"),
        F.to_json(F.struct(F.lit("page_view").alias("event"), n.alias("count"), at.alias("at"))).alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).cast("int").alias("partition"),
        (n - 1).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def received_records(envelopes: DataFrame) -> DataFrame:
    """The learning consumer's projection (what it prints)."""
    return envelopes.select("key", "value", "partition", "offset")
