import random

from pyspark.sql import functions as F

from tickengine.operators import quotes as Q
from tickengine.sources.proxy import tick_proxy

from conftest import SF_SMALL

KEYS = ["k"]


def fold(rows, interval_us):
    """The producer's rule, one quote at a time."""
    out, last_sig, last_t = [], None, None
    for k, t, s, sig in rows:
        if last_sig is not None and sig == last_sig:
            continue
        if last_t is not None and t - last_t < interval_us:
            continue
        out.append((k, t, s))
        last_sig, last_t = sig, t
    return out


def brute(rows, interval_us):
    res = []
    for key in sorted({r[0] for r in rows}):
        res += fold(sorted(r for r in rows if r[0] == key), interval_us)
    return sorted(res)


def test_throttle_matches_fold_on_random_traces(spark):
    rnd = random.Random(7)
    rows = []
    for key in ("A", "B"):
        t = 0
        for s in range(300):
            t += rnd.choice([0, 50_000, 100_000, 200_000, 260_000, 1_000_000])
            rows.append((key, t, s, rnd.choice([1, 1, 2, 3])))
    df = spark.createDataFrame(rows, "k string, t long, s long, sig int")
    for interval_ms in (0, 250, 1000):
        want = brute(rows, interval_ms * 1000)
        for segment_rows, block, chunk in ((1 << 18, 1, 3_600_000_000), (1 << 18, 1, 300_000), (3, 2_000_000, 1_000_000), (0, 30_000_000, 7_000_000)):
            got = Q.quote_throttle(df, KEYS, "t", "s", ("sig",), interval_ms, bucket_us=1_000_000, segment_rows=segment_rows,
                                   block_us=block, chunk_us=chunk)
            assert sorted(tuple(r) for r in got.select("k", "t", "s").collect()) == want, (interval_ms, segment_rows, chunk)


def test_missing_values_in_a_signature_differ_by_place(spark):
    rows = [("A", i * 1_000_000, i, x, y) for i, (x, y) in enumerate([(None, 1), (1, None), (1, None), (None, None), (None, 1)])]
    df = spark.createDataFrame(rows, "k string, t long, s long, x int, y int")
    got = Q.quote_throttle(df, KEYS, "t", "s", ("x", "y"), 250)
    assert sorted(r.s for r in got.collect()) == [0, 1, 3, 4]


def test_changes_is_throttle_without_interval(spark):
    rows = [("A", i * 10, i, v) for i, v in enumerate([1, 1, 2, 2, 2, 1, None, None, 3])]
    df = spark.createDataFrame(rows, "k string, t long, s long, sig int")
    got = Q.quote_changes(df, KEYS, "t", "s", ("sig",), chunk_us=25)
    assert sorted(r.s for r in got.collect()) == [0, 2, 5, 6, 8]


def test_throttle_on_proxy_against_fold(spark):
    t = tick_proxy(spark, SF_SMALL)
    rows = [(f"{r.exchange}:{r.symbol}", r.ts_us, r.event_id, (r.bid_c, r.size)) for r in t.collect()]
    got = Q.quote_throttle(t.withColumn("k", F.concat_ws(":", "exchange", "symbol")), KEYS, "ts_us", "event_id",
                           ("bid_c", "size"), 15_000)
    assert sorted((r.k, r.ts_us, r.event_id) for r in got.collect()) == brute(rows, 15_000_000)


def test_session_boundaries(spark):
    # 2024-01-15 is winter time: Amsterdam = UTC+1
    base = 1705276800000000  # 2024-01-15T00:00:00Z
    pts = {
        "07:59:59": base + (7 * 3600 + 59 * 60 + 59) * 1_000_000,
        "08:00:00": base + 8 * 3600 * 1_000_000,
        "16:30:00.000000": base + (16 * 3600 + 30 * 60) * 1_000_000,
        "16:30:00.000001": base + (16 * 3600 + 30 * 60) * 1_000_000 + 1,
    }
    df = spark.createDataFrame([(k, v) for k, v in pts.items()] + [("none", None)], "name string, t_us long")
    got = {r.name: (r.session, r.isPremarket) for r in Q.label_sessions(df).collect()}
    assert got == {"07:59:59": ("premarket", True), "08:00:00": ("regular", False),
                   "16:30:00.000000": ("regular", False), "16:30:00.000001": ("afterhours", False),
                   "none": ("unknown", False)}


def test_throttle_golden_trace(spark):
    # (ms, signature): B at 100 ms is too soon; B at 300 ms is published; A at 400 ms too soon; B at 700 ms equals
    # the last published quote; A at 800 ms is published; A again at 1200 ms equals it
    trace = [(0, "A"), (100, "B"), (300, "B"), (400, "A"), (700, "B"), (800, "A"), (1200, "A")]
    df = spark.createDataFrame([("k", ms * 1000, i, sig) for i, (ms, sig) in enumerate(trace)],
                               "k string, t long, s long, sig string")
    for segment_rows in (1 << 18, 0):
        got = Q.quote_throttle(df, KEYS, "t", "s", ("sig",), 250, segment_rows=segment_rows)
        assert sorted(r.t // 1000 for r in got.collect()) == [0, 300, 800]


def test_lookups_hold_no_frame_that_is_read_anew_for_every_row(spark):
    """A frame up to its partition's end costs the square of the partition's rows: 7,411 s of one task were projected."""
    rows = spark.range(40).selectExpr("'A' k", "'s' _seg", "id * 100 _t", "id _s", "cast(id div 3 as int) _sig")
    found = Q._next_pointers(rows, ["k", "_seg"], 250, 500)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan
    # the first quote 250 later has another signature, or the next run starts
    want = {}
    for j in range(40):
        later = [k for k in range(j + 1, 40) if k * 100 >= j * 100 + 250 and k // 3 != j // 3]
        want[j] = later[0] if later else None
    assert {r["_s"]: r["_ns"] for r in found.collect()} == want
