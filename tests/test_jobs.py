import pytest

import json
import tempfile

from tickengine import jobs
from tickengine.sources.envelope import tick_envelopes
from tickengine.sources.proxy import tick_proxy

from conftest import SF_SMALL


def test_candles_store_live_history_jobs(spark, capsys):
    base = tempfile.mkdtemp(prefix="tickengine-jobs-")
    tick_envelopes(tick_proxy(spark, SF_SMALL)).coalesce(1).write.parquet(f"{base}/ticks")
    ck = lambda n: ["--checkpoint", f"{base}/ck-{n}", "--once"]
    assert jobs.run(["candles", "--source", f"files://{base}/ticks", "--sink", f"files://{base}/msgs",
                     "--timer", "event", "--dead-letter", f"files://{base}/bad", *ck("c")], spark) == 0
    assert spark.read.parquet(f"{base}/bad").where("reason = 'no_price'").count() > 0
    assert jobs.run(["store", "--source", f"files://{base}/msgs", "--store", f"{base}/store", *ck("s")], spark) == 0
    assert jobs.run(["live", "--source", f"files://{base}/msgs", "--live", f"{base}/live", *ck("l")], spark) == 0
    capsys.readouterr()
    assert jobs.run(["history", "--live", f"{base}/live", "--symbol", "click", "--date", "2024-01-15"], spark) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert lines and all(x["symbol"] == "click" and x["timeframe"] == "1m" for x in lines)
    assert [x["openTime"] for x in lines] == sorted(x["openTime"] for x in lines)
    assert spark.read.parquet(f"{base}/store").count() > 0


def test_candles_job_with_late_sink(spark):
    base = tempfile.mkdtemp(prefix="tickengine-jobs-late-")
    tick_envelopes(tick_proxy(spark, SF_SMALL)).coalesce(1).write.parquet(f"{base}/ticks")
    assert jobs.run(["candles", "--source", f"files://{base}/ticks", "--sink", f"files://{base}/msgs",
                     "--late", f"files://{base}/late", "--timer", "event", "--checkpoint", f"{base}/ck", "--once"],
                    spark) == 0
    read = spark.read.option("recursiveFileLookup", "true")
    assert read.parquet(f"{base}/late").count() > 0
    assert read.parquet(f"{base}/msgs").where("value like '%candle.closed%'").count() > 0


def test_flush_closes_what_is_open_once(spark):
    from tickengine.operators import store as S

    base = tempfile.mkdtemp(prefix="tickengine-jobs-flush-")
    tick_envelopes(tick_proxy(spark, SF_SMALL)).repartition(2).write.parquet(f"{base}/ticks")
    argv = ["candles", "--source", f"files://{base}/ticks", "--sink", f"files://{base}/msgs", "--checkpoint", f"{base}/ck", "--once", "--flush"]
    assert jobs.run(argv, spark) == 0
    flushed = spark.read.parquet(f"{base}/msgs-flushed").count()
    instruments = spark.read.parquet(f"{base}/msgs").select("key").distinct().count()
    assert flushed == instruments
    assert jobs.run(argv, spark) == 0
    assert spark.read.parquet(f"{base}/msgs-flushed").count() == flushed
    assert S.closing_messages(jobs._published(spark, f"files://{base}/msgs")).count() == 0


def test_feed_and_options_jobs(spark):
    from tickengine.operators import options as O
    from tickengine.plans import queries as Q
    from tickengine.sources.proxy import option_envelopes, option_proxy

    base = tempfile.mkdtemp(prefix="tickengine-jobs-feed-")
    Q._candle_envelopes(spark, SF_SMALL).repartition(2).write.parquet(f"{base}/msgs")
    Q.subscriptions(spark, SF_SMALL).write.parquet(f"{base}/subs")
    assert jobs.run(["feed", "--source", f"files://{base}/msgs", "--subscriptions", f"{base}/subs", "--sink", f"files://{base}/out",
                     "--checkpoint", f"{base}/ck", "--once"], spark) == 0
    got = spark.read.parquet(f"{base}/out").select("client_id", "offset")
    want = Q.q_route(spark, SF_SMALL).select("client_id", "offset")
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    env = option_envelopes(option_proxy(spark, SF_SMALL))
    env.repartition(3).write.parquet(f"{base}/oi")
    assert jobs.run(["options", "--source", f"files://{base}/oi", "--tables", f"{base}/opt", "--max-files", "1", "--checkpoint", f"{base}/ck",
                     "--dead-letter", f"files://{base}/oi-bad", "--once"], spark) == 0
    ratio = spark.read.parquet(f"{base}/opt/put_call_ratio").select("underlying", "snapshot_date", "call_oi", "put_oi")
    want = O.put_call_ratio(O.parse_option_snapshots(env)).select(*ratio.columns)
    assert ratio.count() == want.count() and ratio.exceptAll(want).count() == 0
    assert spark.read.parquet(f"{base}/oi-bad").count() == 0


def test_streams_run_from_another_folder():
    """Workers get the package from Spark, whatever folder the driver was started in."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {repo!r})
import __spark_entry__ as e
from tickengine.session import build_session
spark = build_session(cpus=2)
assert e.queries()["candles_1m_stream"](spark, {SF_SMALL!r}).count() > 0
print("RAN")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(), env=env, capture_output=True, text=True, timeout=300)
    assert "RAN" in out.stdout, out.stderr[-2000:]


def test_intermediates_go_when_asked(spark):
    import glob

    from tickengine.session import checkpoint_dir, drop_intermediates, materialize

    drop_intermediates(spark)
    rows = materialize(spark.range(5))
    folder = checkpoint_dir(spark).removeprefix("file:")
    assert rows.count() == 5 and glob.glob(f"{folder}/tickengine-mat-*")
    assert drop_intermediates(spark) == 1 and not glob.glob(f"{folder}/tickengine-mat-*/part*")


def test_feed_starts_live_on_kafka(spark, monkeypatch, tmp_path):
    """S3: without a checkpoint a feed reads messages from the end of the topic on; other jobs read all."""
    from tickengine import jobs

    asked = []

    def stream(spark, servers, topic, starting="earliest", most=None):
        asked.append((topic, starting))
        raise LookupError

    monkeypatch.setattr(jobs, "kafka_stream", stream)
    spark.createDataFrame([("a", None, None)], "client_id string, symbol string, timeframe string").write.parquet(f"{tmp_path}/subs")
    feed = ["feed", "--source", "kafka://h:1/candles", "--subscriptions", f"{tmp_path}/subs", "--sink", f"files://{tmp_path}/out"]
    for argv in (feed, [*feed, "--starting", "earliest"], ["live", "--source", "kafka://h:1/candles", "--live", f"{tmp_path}/live"]):
        with pytest.raises(LookupError):
            jobs.run(argv, spark)
    assert asked == [("candles", "latest"), ("candles", "earliest"), ("candles", "earliest")]
