"""K1, K2, K4, K6 as streaming sinks.

* K1 / K6: envelopes to Kafka (``kafka.acks=all``), or to envelope files anywhere Kafka is not available.
* K2: the storage service: candle messages -> final-only stored rows -> the partitioned Parquet store, with the
  file sink's checkpoint giving exactly-once output (the reference auto-commits offsets before its writers close).
* K4: the live table: every micro-batch appends its revisions, reduced to the last of each candle, under the query's
  id and the batch's number, and readers take the last revision of every candle (A6). A batch that is run again
  replaces its own folder, and a query with a new checkpoint appends the same revisions again, which readers see once.
  Closed days are compacted into a folder of their own.
* A8: the counts behind the feed metrics: every micro-batch writes the totals that changed, and readers take the last ones.
* F2: candle records that do not parse go to a dead-letter sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import feed as FD
from ..operators import store as S
from ..operators.chunks import last_by_arrival
from ..operators.parse import bad_records, parse_candles
from ..session import materialize


def kafka_sink(envelopes: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """K1 / K6: publish ``key``/``value`` envelopes. Batch DataFrames are written at once; streams get a query."""
    out = envelopes.select("key", "value")
    if envelopes.isStreaming:
        return (
            out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("kafka.acks", "all").option("checkpointLocation", checkpoint).start()
        )
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option(
        "kafka.acks", "all").save()
    return None


def envelope_file_sink(envelopes: DataFrame, path: str, checkpoint: str | None = None):
    """K1 / K6 without a broker: envelopes appended as Parquet files (readable by the replay source)."""
    if envelopes.isStreaming:
        return envelopes.writeStream.format("parquet").option("checkpointLocation", checkpoint).start(path)
    envelopes.write.mode("append").parquet(path)
    return None


def console_sink(records: DataFrame, checkpoint: str | None = None, truncate: bool = False):
    """K5: print received records (the learning consumer); streams get a console query."""
    if records.isStreaming:
        w = records.writeStream.format("console").option("truncate", str(truncate).lower())
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    records.show(truncate=truncate)
    return None


def stored_candles(candle_envelopes: DataFrame, final_only: bool = True) -> DataFrame:
    """K3 rows from candle envelopes (stream or batch); records that do not parse are in :func:`bad_candles` (F2)."""
    parsed = parse_candles(candle_envelopes)
    good = parsed.where(F.col("bad_reason").isNull()).drop("bad_reason")
    return S.store_rows(S.final_only(good, final_only))


def bad_candles(candle_envelopes: DataFrame) -> DataFrame:
    """the candle records that the store and the live table skip, with their coordinates and reason."""
    return bad_records(parse_candles(candle_envelopes))


def store_stream(candle_envelopes: DataFrame, path: str, checkpoint: str, final_only: bool = True,
                 trigger: dict | None = None, files_per_partition: int = 4):
    """K2: the storage service as a streaming query into ``exchange=/symbol=/timeframe=/date=`` directories, each
    batch clustered by directory."""
    rows = S.by_directory(S._to_layout(stored_candles(candle_envelopes, final_only)), files_per_partition)
    w = (
        rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("compression", "snappy")
        .partitionBy(*S.PARTITION_COLS).outputMode("append")
    )
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start(path)


class LiveTable:
    """K4: the last revision of every candle, per trading day.

    Layout: ``<root>/revisions/query=<q>/batch=<b>/trading_date=<d>/`` (appended) and ``<root>/closed/trading_date=<d>/``
    (compacted). The trading date leads the key that revisions are reduced by and the order of an instrument's
    partitions, so a reader's filter on the date (F5) selects folders before anything is read or shuffled."""

    KEY = ["trading_date", "exchange", "symbol", "timeframe", "open_time"]
    SEEN = "record_us long, partition int, offset long"

    def __init__(self, spark: SparkSession, root: str, files_per_day: int = 8):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files_per_day = int(files_per_day)

    def _scan(self, folder: str) -> DataFrame | None:
        from pyspark.errors import AnalysisException

        schema = T.StructType(S.live_schema().fields + T.StructType.fromDDL(self.SEEN).fields)
        try:
            return self.spark.read.schema(schema).option("basePath", f"{self.root}/{folder}").parquet(f"{self.root}/{folder}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None  # nothing written yet

    def _rows(self) -> DataFrame:
        found = [x for x in (self._scan("closed"), self._scan("revisions")) if x is not None]
        columns = [*S.live_schema().fieldNames(), *T.StructType.fromDDL(self.SEEN).fieldNames()]
        if not found:
            return self.spark.createDataFrame([], T.StructType(S.live_schema().fields + T.StructType.fromDDL(self.SEEN).fields))
        out = found[0].select(*columns)
        return out.unionByName(found[1].select(*columns)) if len(found) > 1 else out

    def _last(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.KEY]
        last = last_by_arrival(rows, self.KEY, self.KEY[:4], F.struct(*rest), F.col("record_us"))
        return last.select(*self.KEY, "_l.*")

    def read(self) -> DataFrame:
        """The live table (S6): one row a candle."""
        return self._last(self._rows()).select(*S.live_schema().fieldNames())

    def append(self, parsed: DataFrame, query: str, batch: int) -> None:
        """The revisions of a batch (good rows of ``parse_candles``); the same query and batch again replace them."""
        latest = S.latest_state(parsed)
        seen = [F.unix_micros("timestamp").alias("record_us"), "partition", "offset"]
        # a day is written by several tasks (hashed by instrument), not by one
        salt = F.pmod(F.xxhash64("exchange", "symbol"), F.lit(self.files_per_day))
        S.live_rows(latest, seen).repartition(F.col("trading_date"), salt).write.mode("overwrite").partitionBy(
            "trading_date").parquet(f"{self.root}/revisions/query={query}/batch={int(batch)}")

    def compact(self, day: str) -> list[str]:
        """The last revisions of a closed day as few files; readers still merge later arrivals for it. Returns the
        revision folders that the compacted rows cover, for :meth:`retire`."""
        revisions = self._scan("revisions")
        covered = [] if revisions is None else [
            f"{self.root}/revisions/query={r['query']}/batch={r['batch']}/trading_date={day}"
            for r in revisions.where(F.col("trading_date") == day).select("query", "batch").distinct().toLocalIterator()]
        rows = self._rows().where(F.col("trading_date") == day)
        # an instrument's partitions keep their order: the first record time goes with the row that stays
        seen = Window.partitionBy(*self.KEY[:4], "partition")
        last = self._last(rows.withColumn("record_us", F.min("record_us").over(seen)))
        last = materialize(last)  # the day may be compacted again, over the files that are read here
        last.repartition(self.files_per_day, *self.KEY[1:3]).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("trading_date").parquet(f"{self.root}/closed")
        return covered

    def retire(self, folders: list[str]) -> int:
        """Deletes revision folders that a finished :meth:`compact` covers. To be called once no reader that started
        before the compaction is left, for example at the next one. Readers see the same rows before and after; a batch
        that is run again brings its folder back, which changes nothing either. Returns how many folders went."""
        sc, n = self.spark.sparkContext, 0
        for folder in folders:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            n += bool(path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True))
        return n


def live_stream(candle_envelopes: DataFrame, table: LiveTable, checkpoint: str, trigger: dict | None = None):
    """K4 as a streaming query: every micro-batch's last revisions are appended to the live table."""
    def append(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        parsed = parse_candles(batch)
        table.append(parsed.where(F.col("bad_reason").isNull()).drop("bad_reason"), query, batch_id)

    w = candle_envelopes.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def metrics_stream(candle_envelopes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """A8 as a streaming query: Spark's state holds the counts of every symbol, timeframe and partition, and each
    micro-batch writes those that changed under its number (a batch that is run again replaces its own folder). ``path``
    belongs to one checkpoint."""
    counts = FD.metric_counts(candle_envelopes)
    empty = candle_envelopes.sparkSession.createDataFrame([], counts.schema)
    empty.write.mode("overwrite").parquet(f"{path}/batch=-1")  # readers find the schema before the first batch

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    w = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def read_metric_counts(spark: SparkSession, path: str) -> DataFrame:
    """The latest totals that :func:`metrics_stream` wrote, for :func:`tickengine.operators.feed.metrics_of`."""
    keys = ["route_symbol", "route_timeframe", "partition"]
    totals = F.struct("_n", "_l", "_at", "_seen")
    return spark.read.parquet(path).groupBy(*keys).agg(F.max_by(totals, F.col("batch").cast("long")).alias("_t")).select(*keys, "_t.*")
