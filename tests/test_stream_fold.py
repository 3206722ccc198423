"""The segmented scans of the streaming candle builder against its tick-by-tick loop."""

import decimal
import random

import numpy as np
import pandas as pd
import pytest

from tickengine.streaming import candle_state as CS

D = decimal.Decimal


class State:
    hasTimedOut = False
    get = None

    @property
    def exists(self):
        return self.get is not None

    def update(self, value):
        self.get = value


def ticks(rnd, n, offset, start):
    places = lambda x: str(D(x).quantize(D("1e-10")))
    rows = []
    for i in range(n):
        at = start + i * rnd.choice([3, 9, 25]) * 1_000_000 - rnd.choice([0, 0, 0, 90]) * 1_000_000
        rows.append({"event_us": at, "price": places(D(rnd.randint(0, 500)) / 100), "cumulative_volume": None if rnd.random() < 0.3 else places(rnd.randint(0, 300)),
                     "size": None if rnd.random() < 0.2 else places(rnd.randint(-2, 5)), "currency": rnd.choice([None, "EUR", "USD"]),
                     "partition": 0, "offset": offset + i, "record_us": at, "exact": True})
    frame = pd.DataFrame(rows)
    for c, name in (("price", "price_u"), ("size", "size_u"), ("cumulative_volume", "cum_u")):
        frame[name] = np.array([0 if x is None else int(D(x).scaleb(10)) for x in frame[c]], dtype=np.int64)
    return frame


def plain(frames):
    out = []
    for row in pd.concat(frames).to_dict("records") if frames else ():
        one = {k: None if pd.isna(v) else D(v).normalize() if k in CS._NUM else int(v) if isinstance(v, (int, float, np.integer)) else v for k, v in row.items()}
        out.append(tuple(sorted((k, str(v)) for k, v in one.items())))
    return sorted(out)


@pytest.mark.parametrize("per_tick", [False, True])
def test_scans_equal_the_loop(monkeypatch, per_tick):
    rnd, scan = random.Random(per_tick), CS._scan
    for _ in range(60):
        batches, offset, start = [], 0, 1_705_298_400_000_000
        for _ in range(rnd.randint(1, 4)):
            batches.append(ticks(rnd, rnd.randint(1, 40), offset, start))
            offset, start = offset + 40, start + rnd.choice([0, 30, 400]) * 1_000_000
        got = []
        for fold in (scan, lambda *_: None):
            monkeypatch.setattr(CS, "_scan", fold)
            state, run = State(), CS._state_fn(60_000_000, 0, per_tick)
            out = [frame for batch in batches for frame in run(("x", "y"), iter([batch]), state)]
            got.append((plain(out), [D(x).normalize() if f in CS._NUM and x is not None else x for f, x in zip(CS._FIELDS, state.get, strict=True)]))
        assert got[0] == got[1]


def test_numbers_without_a_64_bit_form_take_the_loop():
    frame = ticks(random.Random(1), 5, 0, 1_705_298_400_000_000)
    fresh = dict.fromkeys(CS._FIELDS) | {"rev": 0, "dirty": False}
    assert CS._scan(frame.assign(exact=False), dict(fresh), 60_000_000, False, "x", "y") is None
    assert CS._scan(frame.assign(cum_u=1 << 61), dict(fresh), 60_000_000, False, "x", "y") is None
    big = fresh | {"open_us": 1_705_298_400_000_000, "open": D(10) ** 17, "high": D(1), "low": D(1), "close": D(1), "volume": D(1), "tick_count": 1}
    assert CS._scan(frame, big, 60_000_000, False, "x", "y") is None


def test_cumulative_volumes_stay_exact(spark):
    """Volumes beyond the whole numbers of a double, with nulls among them."""
    from helpers import envelopes, rows, tick
    from tickengine.streaming.candle_state import candle_stream, scratch_dir, write_replay_files
    from tickengine.sources.envelope import replay_stream

    big = 400_000_001
    values = [tick(0, 1, last=1.0, volume=big), tick(0, 2, last=1.0), tick(0, 3, last=1.0, volume=big + 7), tick(1, 0, last=2.0)]
    base = scratch_dir(spark, "exact")
    files = write_replay_files(envelopes(spark, values), f"{base}/source", steps=1)
    out = candle_stream(replay_stream(spark, f"{base}/source", files)).writeStream.format("parquet")
    out.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/sink").awaitTermination()
    got = spark.read.parquet(f"{base}/sink").where("is_final").selectExpr("cast(volume as decimal(28,10)) as v")
    assert rows(got, "v") == [(D(7),)]


@pytest.mark.parametrize("per_tick", [False, True])
def test_slices_of_a_batch_fold_like_the_whole(monkeypatch, per_tick):
    """An instrument's ticks are not held as output rows all at once; no snapshot is published between slices."""
    rnd = random.Random(5 + per_tick)
    for _ in range(30):
        start = 1_705_298_400_000_000
        batches = [ticks(rnd, rnd.randint(1, 40), 40 * i, start + i * rnd.choice([0, 30, 400]) * 1_000_000) for i in range(3)]
        got = []
        for size in (1 << 16, 3):
            monkeypatch.setattr(CS, "FOLD_ROWS", size)
            state, run = State(), CS._state_fn(60_000_000, 0, per_tick)
            out = [frame for batch in batches for frame in run(("x", "y"), iter([batch.iloc[:7], batch.iloc[7:]]), state)]
            got.append((plain(out), state.get))
            assert size == 1 << 16 or max(map(len, out)) <= 2 * size
        assert got[0] == got[1]


def test_exact_ticks_bring_no_texts(monkeypatch):
    """The loop reads a number from its units where its text is empty."""
    frame = ticks(random.Random(3), 30, 0, 1_705_298_400_000_000)
    bare = frame.assign(**{c: [None if x is None else "" for x in frame[c]] for c in ("price", "size", "cumulative_volume")})
    got = []
    for scan in (CS._scan, lambda *_: None):
        monkeypatch.setattr(CS, "_scan", scan)
        for rows in (frame, bare):
            got.append(plain(list(CS._state_fn(60_000_000, 0)(("x", "y"), iter([rows]), State()))))
    assert all(g == got[0] for g in got)


def test_units_as_text():
    units = [0, 1, -1, 9_999, 10_000, -(10**10), 10**10, 123_456_789_012, 2**62, -(2**62)]
    assert list(CS._texts(np.array(units))) == [str(D(u).scaleb(-10)) for u in units]


def test_replay_files_follow_the_messages(spark, monkeypatch):
    import os

    from helpers import envelopes, tick

    env = envelopes(spark, [tick(0, i % 60, last=1.0, volume=i) for i in range(100)])
    monkeypatch.setattr(CS, "REPLAY_FILE_ROWS", 5)
    path = CS.scratch_dir(spark, "files")
    assert CS.write_replay_files(env, path, steps=2) == 10
    assert sum(n.endswith(".parquet") for n in os.listdir(path.removeprefix("file:"))) == 20


def test_ticks_without_a_record_time_are_folded():
    frame = ticks(random.Random(2), 12, 0, 1_705_298_400_000_000)
    whole = plain(list(CS._state_fn(60_000_000, 0)(("x", "y"), iter([frame]), State())))
    for times in (frame["record_us"].where(frame.index % 3 > 0), np.nan):
        state = State()
        assert plain(list(CS._state_fn(60_000_000, 0)(("x", "y"), iter([frame.assign(record_us=times)]), state))) == whole
        assert state.get[CS._FIELDS.index("record_us")] == (0 if np.isscalar(times) else int(times.max()))
