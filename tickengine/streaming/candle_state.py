"""The candle builder as a Structured Streaming query.

Keyed state per instrument holds the open candle (and the last closed minute), exactly as the reference keeps
one candle per key: a tick older than the open candle is late (W5, per key, not a global watermark); a tick of a
later minute closes the open candle (W2); a closed minute is never reopened (Q7: one final per candle, later ticks of
it are late and leave the stream as ``kind = "late"`` rows). Each micro-batch emits the candles it closed plus a
snapshot of the open candle, so the latest revision per candle (A6) is the result at any point; draining a finished
replay (W4) marks the open ones final.

There is no watermark: Spark drops rows behind one before the state function sees them, and an instrument may run
hours behind the others. Every row reaches its instrument's state, so accepted, late and bad rows add up to the input.

Timers (W3): with ``timer="processing"`` a candle is closed by the wall clock ``grace`` after its minute, but only
while its instrument is live, that is while its newest record was stamped less than a minute (and the grace) ago. On a
backlog the instrument's own ticks close its candles, as with ``timer="event"``, which sets no timers.

One stream can build several timeframes (A4): an instrument's ticks are parsed and shuffled once, its state holds one open
candle per timeframe, and every timeframe folds the same rows.

A micro-batch must fit its tasks instrument by instrument: sources cap it (``maxOffsetsPerTrigger`` and
``maxFilesPerTrigger``).

An instrument's ticks of a micro-batch are folded with segmented numpy scans: a running maximum of the buckets tells late
ticks, the accepted ones form one segment a candle, the last known cumulative volume is a running index, and candles are
reductions over segments. Numbers cross as integers in units of the tenth decimal, which is exact; a batch with a number
that has no such 64-bit form is folded tick by tick in Decimals, with the same result. The instrument's ticks are held
once, as columns of numbers, for all timeframes, and are folded slice by slice, so what a fold builds is bounded.
"""

from __future__ import annotations

import decimal
import time
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.parse import good_ticks, parse_ticks
from ..schema import timeframe_micros
from ..session import checkpoint_dir, materialize, ship
from ..sources.envelope import replay_stream

OUTPUT_SCHEMA = (
    "exchange string, symbol string, open_us long, close_us long, currency string, open string, high string, "
    "low string, close string, volume string, tick_count long, is_final boolean, published_us long, rev long, "
    "kind string"
)
STATE_SCHEMA = (
    "open_us long, currency string, open string, high string, low string, close string, volume string, "
    "tick_count long, last_cum string, published_us long, closed_us long, rev long, dirty boolean, record_us long"
)
OUTPUT_ROWS = 10_000  # rows of one output frame of an instrument
FOLD_ROWS = 1 << 16  # ticks of an instrument that are folded at once
_FIELDS = [f.split()[0] for f in STATE_SCHEMA.split(", ")]


def _dec(x) -> decimal.Decimal | None:
    if x is None or (isinstance(x, float) and pd.isna(x)):
        return None
    return x if isinstance(x, decimal.Decimal) else decimal.Decimal(str(x))


_ZERO = decimal.Decimal(0)
_NUM = ("open", "high", "low", "close", "volume", "last_cum")


UNIT = 10**10  # numbers are decimals with ten places
_LIMIT = 1 << 62
_CANDLE = ["exchange", "symbol", "open_us", "close_us", "currency", "open", "high", "low", "close", "volume", "tick_count",
           "is_final", "published_us", "rev", "kind"]
_TYPES = {"open_us": "int64", "close_us": "int64", "tick_count": "int64", "is_final": "bool", "published_us": "int64", "rev": "Int64"}


def _texts(units) -> np.ndarray:
    """Whole numbers of units as decimal texts, such as ``str`` gives a Decimal of ten places."""
    low = np.ascontiguousarray(units, dtype=np.int64)
    wide = np.stack([low, low >> 63], axis=1)  # as 128-bit numbers
    return pa.Array.from_buffers(pa.decimal128(38, 10), len(low), [None, pa.py_buffer(wide)]).cast(pa.string()).to_numpy(zero_copy_only=False)


def _missing(texts: np.ndarray) -> np.ndarray:
    """Texts with None for every missing one."""
    return np.where(pd.isna(texts), None, texts)


_NUMBERS = ["event_us", "price_u", "size_u", "cum_u", "partition", "offset", "record_us", "exact"]
_TEXTS = ["price", "size", "cumulative_volume", "currency"]


class _Arrived:
    """One instrument's ticks of a micro-batch, in arrival order: slices of them as frames."""

    def __init__(self, pdfs: Iterator[pd.DataFrame]):
        # the key's texts are not kept with every row
        frames = [p[[*_NUMBERS, *_TEXTS]] for p in pdfs if len(p)]
        self.rows = pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()
        self.record_us = None
        if not len(self.rows):
            return
        del frames
        newest = self.rows["record_us"].max()
        self.record_us = None if pd.isna(newest) else int(newest)
        # a key that moved to another partition continues there: partitions by their first record time (missing: last)
        seen = self.rows.groupby("partition")["record_us"].transform("min").to_numpy()
        self.order = np.lexsort((self.rows["offset"].to_numpy(), self.rows["partition"].to_numpy(), seen))

    def __len__(self) -> int:
        return len(self.rows)

    def slices(self) -> Iterator[tuple[pd.DataFrame, bool]]:
        """Frames of up to ``FOLD_ROWS`` ticks, and whether more follow."""
        for lo in range(0, len(self.rows), FOLD_ROWS):
            yield self.rows.iloc[self.order[lo : lo + FOLD_ROWS]], lo + FOLD_ROWS < len(self.rows)


def _amount(text: str | None, units: int) -> decimal.Decimal | None:
    """A number of a tick: its text, empty where the units say it exactly."""
    return decimal.Decimal(int(units)).scaleb(-10) if text == "" else _dec(text)


def _frame(columns: dict) -> pd.DataFrame:
    return pd.DataFrame({c: columns[c] for c in _CANDLE}).astype({"currency": "object"} | _TYPES)


def _units(st: dict) -> dict | None:
    """The open candle's numbers in units; None if one has no 64-bit form."""
    out = {}
    for f in _NUM:
        x = st.get(f)
        out[f] = None if x is None else int(x.scaleb(10))
        if x is not None and (out[f] != x.scaleb(10) or abs(out[f]) >= _LIMIT):
            return None
    return out


def _scan(rows: pd.DataFrame, st: dict, length_us: int, per_tick: bool, exchange: str, symbol: str, more: bool = False) -> list[pd.DataFrame] | None:
    """Folds one instrument's ticks (in arrival order) into ``st``, which must hold all state columns, and gives the
    output rows. None, with ``st`` unchanged, if a number has no 64-bit form. With ``more`` ticks to follow in the
    micro-batch, the snapshot of the open candle is left to them (``dirty``)."""
    kept = _units(st) if st["open_us"] is not None else dict.fromkeys(_NUM)
    if kept is None or not rows["exact"].all():
        return None
    t, price = rows["event_us"].to_numpy(np.int64), rows["price_u"].to_numpy(np.int64)
    size, cum = rows["size_u"].to_numpy(np.int64), rows["cum_u"].to_numpy(np.int64)
    known = rows["cumulative_volume"].notna().to_numpy()
    # cumulative volumes and sizes bound every sum of increments
    if float(np.abs(cum).sum(dtype=np.float64)) + float(np.abs(size).sum(dtype=np.float64)) + abs(kept["volume"] or 0) >= _LIMIT:
        return None
    currency = rows["currency"].to_numpy(object)
    bucket = t - t % length_us
    floor = st["open_us"] if st["open_us"] is not None else (st["closed_us"] + 1 if st["closed_us"] is not None else np.iinfo(np.int64).min)
    top = np.maximum.accumulate(np.concatenate([[floor], bucket]))[:-1]
    late = bucket < top
    out = []
    if late.any():
        texts = _texts(price[late])
        n = len(texts)
        out.append(_frame({
            "exchange": exchange, "symbol": symbol, "open_us": bucket[late], "close_us": bucket[late] + length_us - 1000,
            "currency": _missing(currency[late]), "open": texts, "high": texts, "low": texts, "close": texts, "volume": "0", "tick_count": np.zeros(n, np.int64),
            "is_final": False, "published_us": t[late], "rev": pd.array([None] * n, "Int64"), "kind": "late"}))
    at = np.flatnonzero(~late)
    if not len(at):
        return out
    t, price, size, cum, known, bucket, currency = (x[at] for x in (t, price, size, cum, known, bucket, currency))
    n = len(at)
    head = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    segment = np.repeat(np.arange(len(head)), np.diff(np.append(head, n)))
    going = bool(st["open_us"] is not None and bucket[0] == st["open_us"])
    # the last known cumulative volume before each tick, in its candle
    seen = np.maximum.accumulate(np.where(known, np.arange(n), -1))
    before = np.concatenate([[-1], seen[:-1]])
    inside = before >= head[segment]
    previous, has = cum[np.maximum(before, 0)], inside.copy()
    if going and kept["last_cum"] is not None:
        carried = (segment == 0) & ~inside
        previous, has = np.where(carried, kept["last_cum"], previous), has | carried
    inc = np.where(known & has, np.maximum(cum - previous, 0), np.where(size > 0, size, 0))
    opening = head[1:] if going else head
    inc[opening] = 0
    stop = np.append(head[1:], n)
    candle = {
        "open": price[head], "high": np.maximum.reduceat(price, head), "low": np.minimum.reduceat(price, head), "close": price[stop - 1],
        "volume": np.add.reduceat(inc, head), "tick_count": stop - head, "published_us": t[stop - 1], "open_us": bucket[head]}
    first = _missing(currency[head])
    last_cum = int(cum[seen[-1]]) if seen[-1] >= head[-1] else None  # of the candle that stays open
    if going:
        candle["open"][0] = kept["open"]
        candle["high"][0], candle["low"][0] = max(candle["high"][0], kept["high"]), min(candle["low"][0], kept["low"])
        candle["volume"][0] += kept["volume"]
        candle["tick_count"][0] += st["tick_count"]
        first[0] = st["currency"]
        if last_cum is None and len(head) == 1:
            last_cum = kept["last_cum"]
    ended = None  # an open candle that the first tick closes as it was
    if st["open_us"] is not None and not going:
        ended = {f: [kept[f]] for f in ("open", "high", "low", "close", "volume")} | {
            "open_us": [st["open_us"]], "tick_count": [st["tick_count"]], "published_us": [st["published_us"]], "currency": [st["currency"]]}
    rev = st["rev"]

    def emitted(columns: dict, final: bool, revs) -> pd.DataFrame:
        opened = np.asarray(columns["open_us"], dtype=np.int64)
        texts = {f: _texts(columns[f]) for f in ("open", "high", "low", "close", "volume")}
        return _frame(columns | texts | {"exchange": exchange, "symbol": symbol, "open_us": opened, "close_us": opened + length_us - 1000,
                                         "is_final": final, "rev": pd.array(revs, "Int64"), "kind": "candle"})

    if ended:
        rev += 1
        out.append(emitted(ended, True, [rev]))
    closing = np.arange(len(head) - 1)
    if per_tick:  # every tick's candle so far: running values of each segment
        running = {"open": candle["open"][segment], "close": price, "published_us": t, "open_us": bucket, "currency": first[segment]}
        high, low, volume = price.copy(), price.copy(), inc.copy()
        if going:
            high[0], low[0], volume[0] = max(high[0], kept["high"]), min(low[0], kept["low"]), volume[0] + kept["volume"]
        for a, b in zip(head.tolist(), stop.tolist(), strict=True):
            high[a:b], low[a:b], volume[a:b] = np.maximum.accumulate(high[a:b]), np.minimum.accumulate(low[a:b]), np.cumsum(volume[a:b])
        count = np.arange(n) - head[segment] + 1 + np.where(segment == 0, st["tick_count"] if going else 0, 0)
        out.append(emitted(running | {"high": high, "low": low, "volume": volume, "tick_count": count}, False, rev + np.arange(n) + 1 + segment))
        closes = rev + stop[:-1] + closing + 1
        rev += n + len(closing)
    else:
        closes = rev + closing + 1
        rev += len(closing) + (not more)  # and the snapshot of the open candle
    if len(closing):
        out.append(emitted({f: v[:-1] for f, v in candle.items()} | {"currency": first[:-1]}, True, closes))
        st["closed_us"] = int(candle["open_us"][-2])
    elif ended:
        st["closed_us"] = st["open_us"]
    if not per_tick and not more:
        out.append(emitted({f: v[-1:] for f, v in candle.items()} | {"currency": first[-1:]}, False, [rev]))
    amount = lambda x: None if x is None else decimal.Decimal(int(x)).scaleb(-10)
    st.update({f: amount(candle[f][-1]) for f in ("open", "high", "low", "close", "volume")}, last_cum=amount(last_cum), currency=first[-1],
              tick_count=int(candle["tick_count"][-1]), published_us=int(t[-1]), open_us=int(bucket[-1]), rev=int(rev), dirty=more and not per_tick)
    return out


def _state_fn(length_us: int, grace_us: int, per_tick: bool = False, timer: str = "event"):
    """The candle loop for one instrument and micro-batch."""
    fold = _fold_fn(length_us, grace_us, per_tick, timer)

    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        yield from fold(key, _Arrived(iter(()) if state.hasTimedOut else pdfs), state)

    return fn


def _fold_fn(length_us: int, grace_us: int, per_tick: bool, timer: str):
    """The loop over an instrument's arrived ticks. The open candle is kept as Decimals while the batch's
    ticks are folded and converted to text only when a revision is emitted or the state is saved."""

    def fn(key: tuple, arrived: _Arrived, state: GroupState) -> Iterator[pd.DataFrame]:
        exchange, symbol = key
        if state.exists:
            st = dict(zip(_FIELDS, state.get))
            for f in _NUM:
                st[f] = _dec(st[f])
        else:
            st = dict.fromkeys(_FIELDS) | {"rev": 0, "dirty": False}
        out = []

        def emit(final: bool):
            st["rev"] += 1
            out.append({
                "exchange": exchange, "symbol": symbol, "open_us": st["open_us"],
                "close_us": st["open_us"] + length_us - 1000, "currency": st["currency"],
                "open": str(st["open"]), "high": str(st["high"]), "low": str(st["low"]), "close": str(st["close"]),
                "volume": str(st["volume"]), "tick_count": st["tick_count"], "is_final": final,
                "published_us": st["published_us"], "rev": st["rev"], "kind": "candle",
            })

        def close_open_candle():
            emit(True)
            st["closed_us"] = st["open_us"]
            st.update(open_us=None, dirty=False)

        if state.hasTimedOut:
            if st["open_us"] is not None:
                close_open_candle()
        else:
            if len(arrived):
                st["record_us"] = max(arrived.record_us or 0, st.get("record_us") or 0)
            for rows, more in arrived.slices():
                scanned = _scan(rows, st, length_us, per_tick, exchange, symbol, more)
                if scanned is not None:
                    yield from scanned
                    continue
                cols = ("event_us", "price", "price_u", "cumulative_volume", "cum_u", "size", "size_u", "currency")
                for t, price, price_u, cum, cum_u, size, size_u, currency in zip(*(rows[c] for c in cols), strict=True):
                    t = int(t)
                    bucket = t - (t % length_us)
                    price, cum, size = _amount(price, price_u), _amount(cum, cum_u), _amount(size, size_u) or _ZERO
                    current = st["open_us"] if st["open_us"] is not None else st["closed_us"]
                    if current is not None and (bucket < current or (st["open_us"] is None and bucket == current)):
                        # late for this instrument (or a minute already closed): to the late table, not dropped
                        out.append({
                            "exchange": exchange, "symbol": symbol, "open_us": bucket, "close_us": bucket + length_us - 1000,
                            "currency": None if pd.isna(currency) else currency, "open": str(price), "high": str(price),
                            "low": str(price), "close": str(price), "volume": "0", "tick_count": 0, "is_final": False,
                            "published_us": t, "rev": None, "kind": "late",
                        })
                        continue
                    if st["open_us"] is not None and bucket > st["open_us"]:
                        close_open_candle()
                    if st["open_us"] is None:
                        st.update(open_us=bucket, currency=None if pd.isna(currency) else currency, open=price,
                                  high=price, low=price, close=price, volume=_ZERO, tick_count=1, last_cum=cum,
                                  published_us=t, dirty=True)
                    else:
                        prev = st["last_cum"]
                        if cum is not None and prev is not None:
                            inc = max(cum - prev, _ZERO)
                        elif size > 0:
                            inc = size
                        else:
                            inc = _ZERO
                        st["high"] = max(st["high"], price)
                        st["low"] = min(st["low"], price)
                        st["close"] = price
                        st["volume"] += inc
                        st["tick_count"] += 1
                        if cum is not None:
                            st["last_cum"] = cum
                        st["published_us"] = t
                        st["dirty"] = True
                    if per_tick:
                        emit(False)
                        st["dirty"] = False
                    if len(out) >= OUTPUT_ROWS:
                        yield pd.DataFrame(out)
                        out.clear()
            if st["open_us"] is not None and st["dirty"]:
                emit(False)
                st["dirty"] = False
        saved = {f: (None if st.get(f) is None else str(st[f])) if f in _NUM else st.get(f) for f in _FIELDS}
        state.update(tuple(saved[f] for f in _FIELDS))
        if timer == "processing" and st["open_us"] is not None:
            # By the wall clock (the process clock of the executor), while the instrument is live
            now_ms = state.getCurrentProcessingTimeMs()
            if (st.get("record_us") or 0) // 1000 >= now_ms - (length_us + grace_us) // 1000:
                due_ms = (st["open_us"] + length_us + grace_us) // 1000
                state.setTimeoutDuration(max(due_ms - now_ms, 1))
        if out:
            yield pd.DataFrame(out)

    return fn


class _Share:
    """One timeframe's share of an instrument's state, as its fold sees it."""

    def __init__(self, values: tuple | None, timed_out: bool, now_ms: int | None):
        self.get, self.exists, self.hasTimedOut = values, values is not None, timed_out
        self.now_ms, self.wait_ms = now_ms, None

    def update(self, values: tuple) -> None:
        self.get = values

    def getCurrentProcessingTimeMs(self) -> int:
        return self.now_ms

    def setTimeoutDuration(self, wait_ms: int) -> None:
        self.wait_ms = wait_ms


def _timeframes_fn(timeframes: Sequence[str], grace_us: int, per_tick: bool, timer: str):
    """The folds of several timeframes over one instrument's micro-batch. A timeout closes the candles that are due, and
    the next one is set for the first of the others."""
    folds = [(t, timeframe_micros(t) + grace_us, _fold_fn(timeframe_micros(t), grace_us, per_tick, timer)) for t in timeframes]
    opened = _FIELDS.index("open_us")

    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        arrived = _Arrived(iter(()) if state.hasTimedOut else pdfs)
        now_ms = state.getCurrentProcessingTimeMs() if timer == "processing" else None
        kept = tuple(state.get) if state.exists else None
        shares = []
        for i, (timeframe, span_us, fold) in enumerate(folds):
            own = None if kept is None else kept[i * len(_FIELDS) : (i + 1) * len(_FIELDS)]
            due = state.hasTimedOut and own[opened] is not None and (own[opened] + span_us) // 1000 <= now_ms
            share = _Share(own, due, now_ms)
            for out in fold(key, arrived, share):
                yield out.assign(timeframe=timeframe)
            shares.append(share)
        state.update(tuple(x for share in shares for x in share.get))
        waits = [share.wait_ms for share in shares if share.wait_ms is not None]
        if waits:
            state.setTimeoutDuration(min(waits))

    return fn


def candle_stream(envelopes: DataFrame, timeframe: str | Sequence[str] = "1m", grace_seconds: int = 2, per_tick: bool = False,
                  timer: str = "event") -> DataFrame:
    """Streaming candles from a streaming envelope DataFrame (Kafka or replay files), of one timeframe or of several
    from one fold. With ``per_tick`` every accepted tick emits a ``candle.updated`` revision (the reference's publication
    pattern, A3); otherwise each micro-batch emits one snapshot per changed open candle. ``timer="processing"`` also closes the candles of live
    instruments by the wall clock (minute end + grace, as the reference does)."""
    if timer not in ("event", "processing"):
        raise ValueError("timer must be 'event' or 'processing'")
    ship(envelopes.sparkSession)
    # numbers in units, never null (a null would make pandas read the column as floats), and whether all have that form
    named = {"price": "price_u", "size": "size_u", "cumulative_volume": "cum_u"}
    whole = {c: F.expr(f"try_cast({c} * {UNIT} as long)") for c in named}
    units = [F.coalesce(whole[c], F.lit(0)).alias(name) for c, name in named.items()]
    exact = F.lit(True)
    for c in named:
        exact = exact & (F.col(c).isNull() | whole[c].isNotNull())
    # a tick whose units are not all exact brings its decimals as text (Arrow decimal -> pandas object conversion is far
    # slower); any other brings empty texts, which Python holds once
    texts = [F.when(F.col(c).isNotNull(), F.when(exact, F.lit("")).otherwise(F.col(c).cast("string"))).alias(c) for c in named]
    ticks = good_ticks(parse_ticks(envelopes)).select(
        "exchange", "symbol", "currency", *texts, "event_us", "partition", "offset", F.unix_micros("timestamp").alias("record_us"),
        *units, exact.alias("exact"),
    )
    kind = GroupStateTimeout.NoTimeout if timer == "event" else GroupStateTimeout.ProcessingTimeTimeout
    grace_us = grace_seconds * 1_000_000
    keyed = ticks.groupBy("exchange", "symbol")
    if not isinstance(timeframe, str):
        state = ", ".join(f"t{i}_{f}" for i in range(len(timeframe)) for f in STATE_SCHEMA.split(", "))
        return keyed.applyInPandasWithState(
            _timeframes_fn(timeframe, grace_us, per_tick, timer), f"{OUTPUT_SCHEMA}, timeframe string", state, "append", kind)
    return keyed.applyInPandasWithState(
        _state_fn(timeframe_micros(timeframe), grace_us, per_tick, timer), OUTPUT_SCHEMA, STATE_SCHEMA, "append", kind,
    ).withColumn("timeframe", F.lit(timeframe))


def candle_rows(out: DataFrame) -> DataFrame:
    """The candle revisions of the stream's output (without the late ticks)."""
    return out.where(F.col("kind") == "candle").drop("kind") if "kind" in out.columns else out


def late_rows(out: DataFrame) -> DataFrame:
    """F3 / W5 in the stream: the ticks the candle builder skipped, with their bucket (``open_us``), price and time (a row
    per timeframe that skipped the tick, if the stream builds several)."""
    return out.where(F.col("kind") == "late").select(
        "exchange", "symbol", "open_us", F.col("close").alias("price"), F.col("published_us").alias("event_us"))


def latest_candles(revisions: DataFrame, drain: bool = True) -> DataFrame:
    """A6 over the stream's output: the last revision of every candle; ``drain`` (W4) marks open ones final."""
    revisions = candle_rows(revisions)
    keys = ["exchange", "symbol", "timeframe", "open_us"]
    cols = [c for c in revisions.columns if c not in keys]
    latest = revisions.groupBy(*keys).agg(
        F.max_by(F.struct(*cols), F.struct("is_final", "rev")).alias("_l")
    ).select(*keys, "_l.*")
    return latest.withColumn("is_final", F.lit(True)) if drain else latest


def run_replay(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
               timeframe: str | Sequence[str] = "1m", files_per_trigger: int | None = None, timeout_s: float | None = None, per_tick: bool = False,
               timer: str = "event", settle_s: float = 5.0) -> None:
    """Run the candle stream over envelope files until all are processed. With a ``timeout_s``, a run that is not
    done by then raises :class:`TimeoutError`: its output is never taken for the result.

    Without timers: an ``availableNow`` trigger, which ends once the files are processed. Processing-time timers make
    Spark schedule a batch after every batch (to fire timeouts), so ``availableNow`` would never end: the query then
    runs on a 1-second trigger and is stopped ``settle_s`` seconds after all files are processed."""
    env = replay_stream(spark, source_dir, max_files_per_trigger=files_per_trigger)
    w = (
        candle_stream(env, timeframe, per_tick=per_tick, timer=timer)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    end = None if timeout_s is None else time.monotonic() + timeout_s
    done = False
    if timer == "processing":
        q = w.trigger(processingTime="1 second").start(sink_dir)
        try:
            # processAllAvailable() never returns here either (a batch is always pending): poll the progress
            while q.isActive and not done and (end is None or time.monotonic() < end):
                prog = q.recentProgress
                seen = any(p["numInputRows"] > 0 for p in prog)
                done = seen and prog[-1]["numInputRows"] == 0 and not q.status["isDataAvailable"]
                time.sleep(0.5)
            if done:
                time.sleep(settle_s)
        finally:
            q.stop()
    else:
        q = w.trigger(availableNow=True).start(sink_dir)
        try:
            done = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination() is None
        finally:
            if q.isActive:
                q.stop()
    if q.exception() is not None:
        raise RuntimeError(f"candle stream failed: {q.exception()}")
    if not done:
        raise TimeoutError(f"the replay of {source_dir} was not done after {timeout_s} s")


REPLAY_FILES = 4  # files of one replay step, at least
REPLAY_FILE_ROWS = 250_000  # a file is read by one task


def write_replay_files(envelopes: DataFrame, path: str, steps: int = 3) -> int:
    """Write envelopes as ``steps`` arrival-ordered steps of files (the file source takes files by modification time)
    and return how many files a step has: a trigger of that many files replays one step. Every step is written in
    parallel, as more files the more messages there are, so that more tasks read it; steps are cut by offset."""
    envelopes = materialize(envelopes)
    files = max(REPLAY_FILES, -(-envelopes.count() // (steps * REPLAY_FILE_ROWS)))
    cuts = envelopes.approxQuantile("offset", [i / steps for i in range(1, steps)], 0.001) if steps > 1 else []
    bounds = [None, *[int(c) for c in cuts], None]
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        part = envelopes
        if lo is not None:
            part = part.where(F.col("offset") > lo)
        if hi is not None:
            part = part.where(F.col("offset") <= hi)
        part.repartition(files).write.mode("append").parquet(path)
    return files


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tickengine-{name}-{uuid.uuid4().hex[:12]}"
