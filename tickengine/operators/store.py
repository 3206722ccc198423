"""Candle messages, the partitioned candle store, the live table and history.

Candle store layout: ``<root>/exchange=<e>/symbol=<s>/timeframe=<t>/date=<YYYY-MM-DD>/part-*.parquet`` with the
path segments cleaned (P17). Spark keeps partition columns in the path only, so the body holds the names as they came
under ``rawExchange``, ``rawSymbol`` and ``rawTimeframe``; readers get them back as ``exchange``, ``symbol`` and
``timeframe``, and two symbols that are cleaned to one segment (``A/B`` and ``A_B``) stay two. ``tradingDate`` stays in
the body and ``date`` is its path copy (Q14). The store is always read with an explicit schema and partition type
inference off, so a symbol such as ``0012`` stays text.

Compaction writes a closed day to a root of its own (``<root>-closed``), so it never touches files that a streaming
sink's log names. A compacted row keeps the name of the store file it came from (``sourceFile``); readers take the
compacted rows and the store's rows from all other files, so rows that are appended to a day after its compaction, in
whatever order, are read too. Files are never changed once written, and their names are unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import iso_instant, resolve_date, safe_path_segment, trading_date
from ..schema import STORED_CANDLE
from ..sources.envelope import CANDLES_TOPIC
from .chunks import last_by_arrival
from .parse import parse_candles

PARTITION_COLS = ["exchange", "symbol", "timeframe", "date"]


def _text(c: Column) -> Column:
    """Decimal / integer value as plain text (no exponent, no trailing zeros beyond the value's scale)."""
    return c.cast("string")


def candle_messages(revisions: DataFrame, topic: str | Column = CANDLES_TOPIC, partition: Column | None = None) -> DataFrame:
    """Candle revisions -> envelopes as the candle builder publishes them.

    Key ``exchange:symbol:timeframe``; value JSON with OHLCV as text, ``currency`` "" when missing, ``tickCount`` a
    number, ``isFinal`` a boolean. The replay offset orders the revisions of each candle (open time, then
    revision number) the way they were published.
    """
    cur = F.coalesce(F.col("currency"), F.lit("")) if "currency" in revisions.columns else F.lit("")
    msg = F.struct(
        F.col("event"),
        F.col("exchange"),
        F.col("symbol"),
        cur.alias("currency"),
        F.col("timeframe"),
        iso_instant(F.col("open_us")).alias("openTime"),
        iso_instant(F.col("close_us")).alias("closeTime"),
        _text(F.col("open")).alias("open"),
        _text(F.col("high")).alias("high"),
        _text(F.col("low")).alias("low"),
        _text(F.col("close")).alias("close"),
        _text(F.col("volume")).alias("volume"),
        F.col("tick_count").alias("tickCount"),
        F.col("is_final").alias("isFinal"),
        iso_instant(F.col("published_us")).alias("publishedAt"),
    )
    return revisions.select(
        F.concat_ws(":", "exchange", "symbol", "timeframe").alias("key"),
        F.to_json(msg).alias("value"),
        (topic if isinstance(topic, Column) else F.lit(topic)).alias("topic"),
        (partition if partition is not None else F.lit(0)).cast("int").alias("partition"),
        (F.expr("open_us div 1000") * F.lit(1_000_000) + F.col("rev")).alias("offset"),
        F.timestamp_micros(F.col("published_us")).alias("timestamp"),
    )


def final_only(parsed: DataFrame, enabled: bool = True) -> DataFrame:
    """keep final candles only (the storage default)."""
    return parsed.where(F.col("isFinal")) if enabled else parsed


def store_rows(parsed_candles: DataFrame, stored_at: Column | None = None) -> DataFrame:
    """K3: parsed candle messages (good rows of ``parse_candles``) -> stored-candle rows plus the path columns."""
    stored = stored_at if stored_at is not None else iso_instant(F.unix_micros(F.current_timestamp()))
    td = trading_date(F.col("open_us"))
    return parsed_candles.select(
        F.col("event"),
        F.col("exchange"),
        F.col("symbol"),
        F.col("currency"),
        F.col("timeframe"),
        iso_instant(F.col("open_us")).alias("openTime"),
        iso_instant(F.col("close_us")).alias("closeTime"),
        td.alias("tradingDate"),
        "open", "high", "low", "close", "volume", "tickCount", "isFinal", "publishedAt",
        stored.alias("storedAt"),
        F.col("key").alias("kafkaKey"),
        F.col("topic").alias("kafkaTopic"),
        F.col("partition").alias("kafkaPartition"),
        F.col("offset").alias("kafkaOffset"),
        safe_path_segment(F.col("exchange")).alias("_p_exchange"),
        safe_path_segment(F.col("symbol")).alias("_p_symbol"),
        safe_path_segment(F.col("timeframe")).alias("_p_timeframe"),
        td.alias("date"),
    )


RAW = {"exchange": "rawExchange", "symbol": "rawSymbol", "timeframe": "rawTimeframe"}


def _to_layout(rows: DataFrame) -> DataFrame:
    """Body columns (raw names included) + cleaned path columns under the directory names."""
    body = [f.name for f in STORED_CANDLE.fields if f.name not in RAW]
    return rows.select(
        *body,
        *[F.col(c).alias(raw) for c, raw in RAW.items()],
        F.col("_p_exchange").alias("exchange"),
        F.col("_p_symbol").alias("symbol"),
        F.col("_p_timeframe").alias("timeframe"),
        "date",
    )


def by_directory(out: DataFrame, files_per_partition: int) -> DataFrame:
    """Rows clustered by directory, each directory over ``files_per_partition`` tasks by a hash of the open time."""
    salt = F.pmod(F.xxhash64("openTime"), F.lit(int(files_per_partition)))
    return out.repartition(*[F.col(c) for c in PARTITION_COLS], salt)


def write_store(rows: DataFrame, path: str, files_per_partition: int = 4, mode: str = "append") -> None:
    """K2: append stored rows to the partitioned store. Rows are clustered by directory so each directory gets
    few files; a hot directory (one symbol-day holding much of the data) is spread over ``files_per_partition``
    writers by a hash of the open time instead of landing in one task."""
    (
        by_directory(_to_layout(rows), files_per_partition)
        .write.mode(mode)
        .option("compression", "snappy")
        .partitionBy(*PARTITION_COLS)
        .parquet(path)
    )


def store_schema() -> T.StructType:
    body = [f for f in STORED_CANDLE.fields if f.name not in RAW]
    raw = [T.StructField(name, T.StringType()) for name in RAW.values()]
    parts = [T.StructField(c, T.StringType()) for c in PARTITION_COLS]
    return T.StructType(body + raw + parts)


SOURCE = "sourceFile"


def _scan(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a store or of a compacted root, with the store file each row came from."""
    from pyspark.errors import AnalysisException

    schema = store_schema()
    compacted = path.endswith("-closed")
    if compacted:
        schema = T.StructType([*schema.fields[: -len(PARTITION_COLS)], T.StructField(SOURCE, T.StringType()), *schema.fields[-len(PARTITION_COLS):]])
    try:
        rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return rows if compacted else rows.withColumn(SOURCE, F.col("_metadata.file_name"))


def closed_root(path: str) -> str:
    return f"{path.rstrip('/')}-closed"


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """S6-style scan of the candle store, explicit schema (partition values stay text): compacted rows, and the store's
    rows from files that no compaction has read. Raw names under ``exchange``, ``symbol``, ``timeframe``; the cleaned path
    segments under ``path_*``."""
    rows, closed = _scan(spark, path), _scan(spark, closed_root(path))
    if closed is not None:
        # one row a compacted file: a filter on the date reaches all three scans
        done = closed.select("date", SOURCE).distinct()
        rows = closed if rows is None else rows.join(done, ["date", SOURCE], "left_anti").select(*closed.columns).unionByName(closed)
    rows = spark.createDataFrame([], store_schema()) if rows is None else rows.drop(SOURCE)
    return rows.withColumnsRenamed({c: f"path_{c}" for c in RAW}).withColumnsRenamed({raw: c for c, raw in RAW.items()})


def compact_store(spark: SparkSession, path: str, day: str, files_per_partition: int = 1) -> int:
    """Write one trading day of the store as ``files_per_partition`` files per directory into the compacted root
    (streaming appends leave many small files). The day's directories appear there only when the write commits; writing
    a day again, with what has arrived since, replaces it. Returns the number of rows."""
    rows = _scan(spark, path)
    day_rows = None if rows is None else rows.where(F.col("date") == day)
    if day_rows is None or day_rows.isEmpty():
        return 0
    (
        by_directory(day_rows, files_per_partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*PARTITION_COLS)
        .parquet(closed_root(path))
    )
    return _scan(spark, closed_root(path)).where(F.col("date") == day).count()


def latest_state(parsed_candles: DataFrame) -> DataFrame:
    """The last revision of every candle (exchange, symbol, timeframe, open time) by arrival, which is what a
    reader of the at-least-once candle topic should keep. Partitions of a candle key follow one another by first
    record time. A partial aggregate: one row per candle per task."""
    keys = ["exchange", "symbol", "timeframe", "open_us"]
    cols = [c for c in parsed_candles.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in cols])
    latest = last_by_arrival(parsed_candles, keys, keys[:3], row, F.unix_micros("timestamp"))
    return latest.select(*keys, *[F.col(f"_l.{c}").alias(c) for c in cols])


def closing_messages(candle_envelopes: DataFrame) -> DataFrame:
    """A ``candle.closed`` message for every candle whose last published revision is not final, to publish when a
    service is shut down. Published already, a candle has none, so flushing twice adds nothing."""
    parsed = parse_candles(candle_envelopes)
    last = latest_state(parsed.where(F.col("bad_reason").isNull()).drop("bad_reason")).where(~F.col("isFinal"))
    return candle_messages(last.select(
        F.lit("candle.closed").alias("event"), "exchange", "symbol", "currency", "timeframe", "open_us", "close_us",
        "open", "high", "low", "close", "volume", F.col("tickCount").alias("tick_count"), F.lit(True).alias("is_final"),
        F.unix_micros(F.coalesce(F.col("publishedAt").try_cast("timestamp"), F.col("timestamp"))).alias("published_us"),
        # right after the last revision
        (F.col("offset") - F.expr("open_us div 1000") * F.lit(1_000_000) + 1).alias("rev")))


def live_rows(latest: DataFrame, more: list | tuple = ()) -> DataFrame:
    """K4 rows of the live table (snake_case, is_final 0/1) from :func:`latest_state`, and ``more`` columns."""
    return latest.select(
        trading_date(F.col("open_us")).alias("trading_date"),
        "event", "exchange", "symbol", "currency", "timeframe",
        iso_instant(F.col("open_us")).alias("open_time"),
        iso_instant(F.col("close_us")).alias("close_time"),
        "open", "high", "low", "close", "volume",
        F.col("tickCount").alias("tick_count"),
        F.col("isFinal").cast("int").alias("is_final"),
        F.col("publishedAt").alias("published_at"),
        *more,
    )


def live_schema() -> T.StructType:
    from ..schema import LIVE_CANDLE

    return T.StructType(list(LIVE_CANDLE.fields))


def history(live: DataFrame, symbol: str, timeframe: str | None = "1m", date: str | None = None) -> DataFrame:
    """H1: candles of one symbol (case-sensitive), timeframe (default 1m) and trading date (default today UTC,
    also for a malformed date), ordered by open time; P24 decoding (empty currency missing, is_final boolean)."""
    day = resolve_date(F.lit(date).cast("string")).cast("string")
    tf = timeframe or "1m"
    return (
        live.where((F.col("trading_date") == day) & (F.col("symbol") == F.lit(symbol)) & (F.col("timeframe") == F.lit(tf)))
        .orderBy("open_time")
        .select(
            "event", "exchange", "symbol",
            F.nullif(F.col("currency"), F.lit("")).alias("currency"),
            "timeframe",
            F.col("open_time").alias("openTime"),
            F.col("close_time").alias("closeTime"),
            "open", "high", "low", "close", "volume",
            F.col("tick_count").alias("tickCount"),
            (F.col("is_final") == 1).alias("isFinal"),
            F.col("published_at").alias("publishedAt"),
        )
    )


def store_history(store: DataFrame, symbol: str, timeframe: str | None = "1m", date: str | None = None) -> DataFrame:
    """H1 over the Parquet store: the predicates hit the partition columns, so only one directory is read."""
    day = resolve_date(F.lit(date).cast("string")).cast("string")
    tf = timeframe or "1m"
    return (
        store.where((F.col("date") == day) & (F.col("path_symbol") == safe_path_segment(F.lit(symbol)))
                    & (F.col("path_timeframe") == safe_path_segment(F.lit(tf))))
        .where((F.col("symbol") == F.lit(symbol)) & (F.col("timeframe") == F.lit(tf)))
        .orderBy("openTime")
    )
