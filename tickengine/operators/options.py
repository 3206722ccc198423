"""Option open-interest snapshots, chain selection and the daily put/call ratio.

Snapshots arrive per contract (underlying, expiry, strike, right) and trading day, possibly more than once a day;
the latest arrival wins: a contract's partitions follow one another by first record time (a topic that grows moves keys
to partitions whose offsets start again), and offsets order a partition. Selection ranks the *distinct* expiries and strikes of each underlying-day (small tables),
then joins the choice back, so no window ever holds a whole chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import last_by_arrival
from .parse import bad_records

CONTRACT = ["underlying", "expiry", "strike", "right"]
DAY = ["underlying", "snapshot_date"]


def read_option_messages(envelopes: DataFrame) -> DataFrame:
    """Option OI messages -> snapshot columns with the envelope's and a ``bad_reason`` (null for a snapshot).
    Contract fields come from the JSON, else from the key ``underlying:expiry:strike:right``; the open interest is
    ``callOpenInterest`` for calls and ``putOpenInterest`` for puts. Strikes and prices are decimals (52.5)."""
    from ..functions import json_fields as J
    from ..functions.text import key_part
    from ..schema import PRICE

    x = J.extract(J.parse(envelopes), ("underlying", "expiry", "strike", "right", "snapshotDate",
                                        "callOpenInterest", "putOpenInterest", "underlyingPrice"))
    key = F.col("key")
    right = F.upper(F.coalesce(J.string_field("right"), key_part(key, 3)))
    x = x.select(
        *envelopes.columns,
        F.col(J.VARIANT).isNotNull().alias("_json"),
        "_is_object",
        F.col("offset").alias("arrival"),
        F.coalesce(J.string_field("underlying"), key_part(key, 0)).alias("underlying"),
        F.coalesce(J.string_field("expiry"), key_part(key, 1)).try_cast("date").alias("expiry"),
        F.coalesce(J.decimal_field("strike"), key_part(key, 2).try_cast(PRICE)).alias("strike"),
        right.alias("right"),
        J.string_field("snapshotDate").try_cast("date").alias("snapshot_date"),
        F.when(right == "C", J.long_field("callOpenInterest")).when(right == "P", J.long_field("putOpenInterest"))
        .alias("open_interest"),
        J.decimal_field("underlyingPrice").alias("underlying_price"),
    )
    contract = F.lit(True)
    for c in ("underlying", "expiry", "strike", "snapshot_date"):
        contract = contract & F.col(c).isNotNull()
    reason = (
        F.when(~F.col("_json"), "not_json")
        .when(~F.col("_is_object"), "not_object")
        .when(~contract | F.col("right").isNull() | ~F.col("right").isin("C", "P"), "no_contract")
        .when(F.col("open_interest").isNull(), "no_open_interest")
    )
    return J.settle(x.withColumn("bad_reason", reason).drop("_json", "_is_object"))


def parse_option_snapshots(envelopes: DataFrame) -> DataFrame:
    """The snapshots of option OI messages; the other records are in :func:`bad_option_records`."""
    good = read_option_messages(envelopes).where(F.col("bad_reason").isNull())
    return good.select("arrival", "partition", F.unix_micros("timestamp").alias("record_us"), *CONTRACT, "snapshot_date",
                       "open_interest", "underlying_price")


def bad_option_records(envelopes: DataFrame) -> DataFrame:
    """the option records that are no snapshots, with their coordinates, for a dead-letter table."""
    return bad_records(read_option_messages(envelopes))


def latest_snapshots(snaps: DataFrame, order: str = "arrival") -> DataFrame:
    """The last snapshot per contract and day (a partial aggregate). Snapshots of a topic carry ``partition`` and
    ``record_us``; those without are ordered by ``order`` alone."""
    cols = [c for c in snaps.columns if c not in CONTRACT + ["snapshot_date"]]
    if "partition" in snaps.columns:
        last = last_by_arrival(snaps.withColumn("offset", F.col(order)), [*CONTRACT, "snapshot_date"], CONTRACT, F.struct(*cols), F.col("record_us"))
        return last.select(*CONTRACT, "snapshot_date", "_l.*")
    return snaps.groupBy(*CONTRACT, "snapshot_date").agg(
        F.max_by(F.struct(*cols), F.col(order)).alias("_l")
    ).select(*CONTRACT, "snapshot_date", "_l.*")


def select_chain(snaps: DataFrame, max_expiries: int = 2, strikes_per_expiry: int = 10) -> DataFrame:
    """O2: per underlying-day, the ``max_expiries`` nearest expiries on or after the day, and per expiry the
    ``strikes_per_expiry`` strikes nearest the underlying price (ties: the lower strike); 0 means all."""
    s = latest_snapshots(snaps).where(F.col("expiry") >= F.col("snapshot_date"))
    if max_expiries:
        exp = s.select(*DAY, "expiry").distinct()
        exp = exp.withColumn("_er", F.dense_rank().over(Window.partitionBy(*DAY).orderBy("expiry")))
        s = s.join(exp.where(F.col("_er") <= max_expiries).drop("_er"), [*DAY, "expiry"], "left_semi")
    if strikes_per_expiry:
        stk = s.groupBy(*DAY, "expiry", "strike").agg(F.max("underlying_price").alias("_px"))
        dist = F.abs(F.col("strike") - F.col("_px"))
        stk = stk.withColumn(
            "_sr", F.row_number().over(Window.partitionBy(*DAY, "expiry").orderBy(dist, F.col("strike")))
        )
        s = s.join(stk.where(F.col("_sr") <= strikes_per_expiry).select(*DAY, "expiry", "strike"),
                   [*DAY, "expiry", "strike"], "left_semi")
    return s


def put_call_ratio(snaps: DataFrame) -> DataFrame:
    """Per underlying-day, summed call and put open interest and put / call (null without calls)."""
    s = latest_snapshots(snaps)
    oi = F.col("open_interest")
    return s.groupBy(*DAY).agg(
        F.sum(F.when(F.col("right") == "C", oi).otherwise(0)).alias("call_oi"),
        F.sum(F.when(F.col("right") == "P", oi).otherwise(0)).alias("put_oi"),
    ).withColumn("put_call_ratio", F.col("put_oi") / F.nullif(F.col("call_oi"), F.lit(0)))


def write_options(snaps: DataFrame, path: str, run: str = "once", batch: int = 0) -> None:
    """K7: raw snapshots appended under their run and batch (a batch that is written again replaces itself), then the
    ratio of every day they touch, from all stored snapshots of the day."""
    spark = snaps.sparkSession
    snaps.repartition("snapshot_date", F.pmod(F.xxhash64(*CONTRACT), F.lit(8))).write.mode("overwrite").partitionBy(
        "snapshot_date").parquet(f"{path}/snapshots/run={run}/batch={int(batch)}")
    own = spark.read.schema(snaps.schema).option("basePath", f"{path}/snapshots").parquet(f"{path}/snapshots/run={run}/batch={int(batch)}")
    days = own.select("snapshot_date").distinct()
    stored = read_snapshots(spark, path).join(days, "snapshot_date", "left_semi")
    put_call_ratio(stored).repartition("snapshot_date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(f"{path}/put_call_ratio")


def read_snapshots(spark, path: str) -> DataFrame:
    """Every stored snapshot."""
    schema = ("arrival long, partition int, record_us long, underlying string, expiry date, strike decimal(28,10), right string, open_interest long, "
              "underlying_price decimal(28,10), snapshot_date date")
    return spark.read.schema(schema).option("basePath", f"{path}/snapshots").parquet(f"{path}/snapshots")


def read_ratio(spark, path: str) -> DataFrame:
    """The stored daily ratios."""
    schema = "underlying string, call_oi long, put_oi long, put_call_ratio double, snapshot_date date"
    return spark.read.schema(schema).option("basePath", f"{path}/put_call_ratio").parquet(f"{path}/put_call_ratio")


def options_stream(envelopes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """S7 / K7 as a streaming query."""
    def write(messages: DataFrame, batch_id: int) -> None:
        run = messages.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_options(parse_option_snapshots(messages), path, run, batch_id)

    w = envelopes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
