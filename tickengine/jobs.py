"""Command-line jobs, one per service of the original deployment, each a Spark job over Kafka or envelope files.

    python -m tickengine candles  --source kafka://host:9092/market.trades.raw --sink files:///data/candle-msgs
    python -m tickengine store    --source files:///data/candle-msgs --store /data/candles
    python -m tickengine live     --source files:///data/candle-msgs --live /data/live
    python -m tickengine history  --live /data/live --symbol ASML [--timeframe 1m] [--date 2024-01-15]
    python -m tickengine feed     --source files:///data/candle-msgs --subscriptions /data/subs --sink files:///data/deliveries
    python -m tickengine options  --source kafka://host:9092/market.options.oi.snapshot --tables /data/options
    python -m tickengine produce-events --count 10 --sink files:///data/learning
    python -m tickengine consume-events --source files:///data/learning

Sources and sinks are ``kafka://<bootstrap servers>/<topic>`` or ``files://<path>`` (envelope Parquet files with
the Kafka record schema). A micro-batch reads ``--max-offsets`` records or ``--max-files`` files at most. Streaming jobs checkpoint under ``--checkpoint`` (default: the session's checkpoint
directory) and run until stopped, or until the input is drained with ``--once``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import feed as FD
from .operators import options as O
from .operators import store as S
from .operators.parse import bad_records, parse_ticks
from .session import checkpoint_dir, drop_intermediates, prepare
from .sources.envelope import (CANDLES_TOPIC, LEARNING_TOPIC, generated_events, kafka_batch, kafka_stream,
                               received_records, replay_batch, replay_stream)
from .streaming import candle_state as CS
from .streaming import sinks as K


def _source(spark: SparkSession, args) -> DataFrame:
    """The job's input as a stream: from the start of the topic or folder, or from its end with ``--starting latest``
    (Kafka); a checkpoint continues where it was."""
    uri = args.source
    if uri.startswith("kafka://"):
        servers, topic = uri[len("kafka://"):].split("/", 1)
        return kafka_stream(spark, servers, topic, getattr(args, "starting", "earliest"), args.max_offsets)
    if uri.startswith("files://"):
        return replay_stream(spark, uri[len("files://"):], args.max_files)
    raise SystemExit(f"unknown source {uri!r}: use kafka://servers/topic or files://path")


def _flushed(uri: str) -> str:
    """Where flushed closes go: to the same topic, or beside the folder (whose streaming log names its own files)."""
    return uri if uri.startswith("kafka://") else uri.rstrip("/") + "-flushed"


def _published(spark: SparkSession, uri: str) -> DataFrame:
    if uri.startswith("kafka://"):
        servers, topic = uri[len("kafka://"):].split("/", 1)
        return kafka_batch(spark, servers, topic)
    out = replay_batch(spark, uri[len("files://"):])
    try:
        return out.unionByName(replay_batch(spark, _flushed(uri)[len("files://"):]))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return out  # nothing was flushed yet


def _publish(df: DataFrame, uri: str) -> None:
    if uri.startswith("kafka://"):
        servers, topic = uri[len("kafka://"):].split("/", 1)
        K.kafka_sink(df, servers, topic)
    else:
        df.write.mode("append").parquet(uri[len("files://"):])


def _sink(df: DataFrame, uri: str, checkpoint: str, once: bool):
    trigger = {"availableNow": True} if once else {"processingTime": "500 milliseconds"}
    if uri.startswith("kafka://"):
        servers, topic = uri[len("kafka://"):].split("/", 1)
        value = F.col("value") if "reason" not in df.columns else F.to_json(F.struct(*df.columns))  # dead letters keep all
        w = (df.select("key", value.alias("value")).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
             .option("topic", topic).option("kafka.acks", "all"))
        return w.option("checkpointLocation", checkpoint).trigger(**trigger).start()
    if uri.startswith("files://"):
        w = df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        return w.trigger(**trigger).start(uri[len("files://"):])
    raise SystemExit(f"unknown sink {uri!r}: use kafka://servers/topic or files://path")


def _ckpt(spark: SparkSession, args, name: str) -> str:
    """One checkpoint folder per streaming query (a job may run two: output and dead letters)."""
    root = args.checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/tickengine-job"
    return f"{root.rstrip('/')}/{name}"


def _trigger(args) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": "1 second"}


def _dead_letters(spark: SparkSession, args, bad) -> None:
    """a second query for the records that the job skips."""
    if args.dead_letter:
        query = _sink(bad(_source(spark, args)), args.dead_letter, _ckpt(spark, args, f"{args.job}-dead-letter"), args.once)
        if args.once:
            query.awaitTermination()


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tickengine")
    sub = ap.add_subparsers(dest="job", required=True)
    c = sub.add_parser("candles", help="ticks -> 1-minute (or other) candle messages")
    c.add_argument("--source", required=True)
    c.add_argument("--sink", required=True)
    c.add_argument("--timeframe", default="1m", help="one, or several from one fold: 1m,5m,1h (messages name their topic; Kafka takes one)")
    c.add_argument("--timer", choices=["event", "processing"], default=None,
                   help="default: processing, and event with --once (a drained input needs no timers)")
    c.add_argument("--grace-seconds", type=int, default=2)
    c.add_argument("--dead-letter", default=None, help="sink for records that do not parse (F2)")
    c.add_argument("--late", default=None, help="files:// sink for late ticks (F3)")
    c.add_argument("--flush", action="store_true", help="with --once: publish the candles left open as closed (W4); files go to <sink>-flushed")
    s = sub.add_parser("store", help="candle messages -> partitioned Parquet store")
    s.add_argument("--source", required=True)
    s.add_argument("--store", required=True)
    s.add_argument("--all-revisions", action="store_true", help="store non-final revisions too")
    lv = sub.add_parser("live", help="candle messages -> live table")
    lv.add_argument("--source", required=True)
    lv.add_argument("--live", required=True)
    fd = sub.add_parser("feed", help="candle messages -> a delivery per subscriber (H2)")
    fd.add_argument("--source", required=True)
    fd.add_argument("--subscriptions", required=True, help="Parquet folder: client_id, symbol, timeframe")
    fd.add_argument("--sink", required=True)
    fd.add_argument("--starting", choices=["latest", "earliest"], default="latest",
                    help="where a feed without a checkpoint starts on Kafka (S3: live messages only)")
    op = sub.add_parser("options", help="option snapshots -> raw table and daily put/call ratio (K7)")
    op.add_argument("--source", required=True)
    op.add_argument("--tables", required=True)
    h = sub.add_parser("history", help="print one symbol's candles as JSON")
    h.add_argument("--live", required=True)
    h.add_argument("--symbol", required=True)
    h.add_argument("--timeframe", default=None)
    h.add_argument("--date", default=None)
    p = sub.add_parser("produce-events", help="learning events")
    p.add_argument("--count", type=int, default=10)
    p.add_argument("--sink", required=True)
    q = sub.add_parser("consume-events", help="print learning events")
    q.add_argument("--source", required=True)
    for x in (s, lv, op):
        x.add_argument("--dead-letter", default=None, help="sink for records that do not parse (F2)")
    for x in (c, s, lv, fd, op, p, q):
        x.add_argument("--checkpoint", default=None)
        x.add_argument("--once", action="store_true", help="drain the available input, then stop")
        x.add_argument("--max-offsets", type=int, default=1_000_000, help="records of a micro-batch (Kafka)")
        x.add_argument("--max-files", type=int, default=64, help="files of a micro-batch")
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"tickengine-{args.job}").getOrCreate()
    prepare(spark, stream=args.job not in ("history", "produce-events"))
    try:
        return _run(spark, args)
    finally:
        drop_intermediates(spark)


def _run(spark: SparkSession, args) -> int:
    if args.job == "candles":
        names = args.timeframe.split(",")
        if len(names) > 1 and args.sink.startswith("kafka://"):
            raise SystemExit("a Kafka sink names one topic: run a job per timeframe, or write envelope files")
        revs = CS.candle_stream(_source(spark, args), names if len(names) > 1 else args.timeframe,
                                grace_seconds=args.grace_seconds, per_tick=True, timer=args.timer or ("event" if args.once else "processing"))
        topic = F.concat(F.lit(CANDLES_TOPIC.rsplit(".", 1)[0] + "."), F.col("timeframe"))

        def messages(out: DataFrame) -> DataFrame:
            return S.candle_messages(CS.candle_rows(out).withColumn(
                "event", F.when(F.col("is_final"), "candle.closed").otherwise("candle.updated")), topic=topic)

        if args.late:
            # one stream, two outputs; files are written under the batch's number, so a batch that is run again
            # replaces its own (to Kafka, as everywhere, delivery is at least once)
            late_path = args.late[len("files://"):]
            sink_uri = args.sink

            def both(batch: DataFrame, batch_id: int) -> None:
                batch.persist()
                try:
                    out = messages(batch)
                    if sink_uri.startswith("kafka://"):
                        _publish(out, sink_uri)
                    else:
                        out.write.mode("overwrite").parquet(f"{sink_uri[len('files://'):]}/batch-{batch_id:09d}")
                    CS.late_rows(batch).write.mode("overwrite").parquet(f"{late_path}/batch-{batch_id:09d}")
                finally:
                    batch.unpersist()

            trigger = {"availableNow": True} if args.once else {"processingTime": "500 milliseconds"}
            query = revs.writeStream.foreachBatch(both).option(
                "checkpointLocation", _ckpt(spark, args, "candles")).trigger(**trigger).start()
        else:
            query = _sink(messages(revs), args.sink, _ckpt(spark, args, "candles"), args.once)
        _dead_letters(spark, args, lambda env: bad_records(parse_ticks(env)))
        if args.once and args.flush:
            query.awaitTermination()
            _publish(S.closing_messages(_published(spark, args.sink)), _flushed(args.sink))
            return 0
    elif args.job == "store":
        query = K.store_stream(_source(spark, args), args.store, _ckpt(spark, args, "store"),
                               final_only=not args.all_revisions, trigger=_trigger(args))
        _dead_letters(spark, args, K.bad_candles)
    elif args.job == "live":
        query = K.live_stream(_source(spark, args), K.LiveTable(spark, args.live), _ckpt(spark, args, "live"), _trigger(args))
        _dead_letters(spark, args, K.bad_candles)
    elif args.job == "feed":
        sent = FD.route(_source(spark, args), spark.read.parquet(args.subscriptions))
        query = _sink(sent.withColumn("key", F.col("client_id")), args.sink, _ckpt(spark, args, "feed"), args.once)
    elif args.job == "options":
        query = O.options_stream(_source(spark, args), args.tables, _ckpt(spark, args, "options"), _trigger(args))
        _dead_letters(spark, args, O.bad_option_records)
    elif args.job == "history":
        rows = S.history(K.LiveTable(spark, args.live).read(), args.symbol, args.timeframe, args.date)
        for r in rows.toLocalIterator():  # one symbol-day, streamed to stdout
            d = r.asDict()
            d["currency"] = d["currency"] or ""
            print(json.dumps(d, separators=(",", ":")))
        return 0
    elif args.job == "produce-events":
        ev = generated_events(spark, args.count, LEARNING_TOPIC)
        if args.sink.startswith("kafka://"):
            servers, topic = args.sink[len("kafka://"):].split("/", 1)
            K.kafka_sink(ev, servers, topic)
        else:
            K.envelope_file_sink(ev, args.sink[len("files://"):])
        return 0
    else:  # consume-events
        rec = received_records(_source(spark, args))
        query = K.console_sink(rec, _ckpt(spark, args, "consume"))
    query.awaitTermination()
    return 0


def main() -> None:
    sys.exit(run())
