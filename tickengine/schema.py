"""Message shapes and column conventions shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

PRICE = T.DecimalType(28, 10)

# Kafka record envelope (the Kafka source's own columns; the file-replay source uses the same type)
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# fields of a stored candle, in file order (partition directories repeat exchange, symbol, timeframe, date)
STORED_CANDLE = T.StructType(
    [
        T.StructField("event", T.StringType(), False),
        T.StructField("exchange", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("currency", T.StringType()),
        T.StructField("timeframe", T.StringType(), False),
        T.StructField("openTime", T.StringType(), False),
        T.StructField("closeTime", T.StringType(), False),
        T.StructField("tradingDate", T.StringType(), False),
        T.StructField("open", T.StringType(), False),
        T.StructField("high", T.StringType(), False),
        T.StructField("low", T.StringType(), False),
        T.StructField("close", T.StringType(), False),
        T.StructField("volume", T.StringType(), False),
        T.StructField("tickCount", T.LongType(), False),
        T.StructField("isFinal", T.BooleanType(), False),
        T.StructField("publishedAt", T.StringType(), False),
        T.StructField("storedAt", T.StringType(), False),
        T.StructField("kafkaKey", T.StringType()),
        T.StructField("kafkaTopic", T.StringType(), False),
        T.StructField("kafkaPartition", T.IntegerType(), False),
        T.StructField("kafkaOffset", T.LongType(), False),
    ]
)

# the live table (latest revision of every candle of the current day)
LIVE_CANDLE = T.StructType(
    [
        T.StructField("trading_date", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("timeframe", T.StringType()),
        T.StructField("open_time", T.StringType()),
        T.StructField("close_time", T.StringType()),
        T.StructField("open", T.StringType()),
        T.StructField("high", T.StringType()),
        T.StructField("low", T.StringType()),
        T.StructField("close", T.StringType()),
        T.StructField("volume", T.StringType()),
        T.StructField("tick_count", T.LongType()),
        T.StructField("is_final", T.IntegerType()),
        T.StructField("published_at", T.StringType()),
    ]
)

SUBSCRIPTION = T.StructType(
    [
        T.StructField("client_id", T.StringType(), False),
        T.StructField("symbol", T.StringType()),
        T.StructField("timeframe", T.StringType()),
    ]
)

# Timeframe names and their lengths in seconds (UTC-aligned buckets)
TIMEFRAME_SECONDS = {"1s": 1, "1m": 60, "5m": 300, "15m": 900, "1h": 3600, "1d": 86400}


def timeframe_micros(timeframe: str) -> int:
    try:
        return TIMEFRAME_SECONDS[timeframe] * 1_000_000
    except KeyError:
        raise ValueError(f"unknown timeframe {timeframe!r}; known: {sorted(TIMEFRAME_SECONDS)}") from None


@dataclass(frozen=True)
class TickSpec:
    """Column roles of a tick DataFrame.

    ``order`` is the arrival order inside a partition (Kafka: offset); an instrument's partitions follow one another by
    first record timestamp. ``seq`` is the order column that grows along the
    stream; arrival chunks are ``seq div chunk_size`` inside ``seq_prefix`` (Kafka: per partition). Chunks let a
    hot instrument's running state be computed by many tasks instead of one.
    """

    keys: tuple[str, ...] = ("exchange", "symbol")
    order: tuple[str, ...] = ("offset",)
    seq: str = "offset"
    seq_prefix: tuple[str, ...] = ("partition",)
    price: str = "price"
    size: str = "size"
    cum: str = "cumulative_volume"
    time_us: str = "event_us"
    currency: str | None = "currency"
    # arrivals of a chunk: bounds the ticks of one instrument in one task, and should be many per instrument
    chunk_size: int = 1 << 22
    # record timestamp: an instrument that moves to another partition continues there (null: one partition)
    record_time: str | None = None
    # one BIGINT with the same order as ``order``: lets min_by / max_by run as hash aggregates (a struct
    # ordering forces a sort of every tick)
    order_key: str | None = None

    def with_chunk(self, chunk_size: int) -> "TickSpec":
        return replace(self, chunk_size=chunk_size)


# ticks parsed from envelopes: offsets stay below 2^48 per partition
ENVELOPE_TICKS = TickSpec(order_key="`offset`", order=("offset",), record_time="timestamp")

# the FIXTURES proxy built from `events`: arrival = (arrival, event_id), integer cents
PROXY_TICKS = TickSpec(
    order=("arrival", "event_id"),
    seq="arrival",
    seq_prefix=(),
    price="price_c",
    size="size",
    cum="cum",
    time_us="ts_us",
    currency=None,
    # rows sharing an arrival differ in their delay arrival - event_id (0, 12, 150 or 162); larger delay first
    order_key="arrival * 4 + case arrival - event_id when 162 then 0 when 150 then 1 when 12 then 2 else 3 end",
)
