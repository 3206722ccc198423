"""A1-A5: OHLCV candles, their revision stream, other timeframes and roll-ups.

Semantics (reference candle builder):
- ticks are taken in arrival order; a tick whose bucket is older than the instrument's open candle is dropped;
- open / close are the first / last accepted tick *by arrival*, high / low the extremes, currency that of the
  first tick, tick_count the accepted ticks;
- volume: the opening tick adds 0; every later tick adds ``max(cum - prev_cum, 0)`` when its cumulative volume and
  the last known cumulative volume of the candle are both present, else its size when positive, else 0.

Plan: the ticks are parsed and shuffled once, by cell (instrument and arrival chunk, see :mod:`.chunks`). Accepted
ticks have buckets that never fall along an instrument's arrivals, so only the first bucket of a cell can continue a
candle of earlier cells: one carry row a cell, joined on the cell, is all that the windows need from outside. A cell's
ticks fold into one row per candle (ordered as the window left them), and those rows into candles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import TickSpec, timeframe_micros
from .chunks import RANK, arrival, cell_cols, prior_cells
from .late import mark_late, with_bucket


def _inside(spec: TickSpec) -> Window:
    return Window.partitionBy(*cell_cols(spec), "bucket").orderBy(*spec.order)


def _carried(accepted: DataFrame, spec: TickSpec, summary: list[Column], prefix: list[Column]) -> DataFrame:
    """Joins to each accepted tick what earlier cells hold of its candle: ``summary`` aggregates per cell and bucket,
    ``prefix`` columns over the earlier cells of the candle (null where the candle starts in this cell)."""
    cell = cell_cols(spec)
    before = prior_cells([*spec.keys, "bucket"])
    cells = accepted.groupBy(*cell, "bucket").agg(F.first(RANK).alias(RANK), F.count(F.lit(1)).alias("_n"), *summary)
    carry = cells.select(*cell, F.col("bucket").alias("_carry_bucket"), F.sum("_n").over(before).alias("_carry_n"),
                         *[c.over(before).alias(f"_carry_{name}") for name, c in prefix])
    # at most one bucket of a cell continues a candle, so this stays one row a cell
    carry = carry.where(F.col("_carry_n").isNotNull())
    joined = accepted.join(carry.hint("merge"), cell, "left")
    same = F.col("bucket") == F.col("_carry_bucket")
    names = ["n", *[name for name, _ in prefix]]
    return joined.withColumns({f"_carry_{n}": F.when(same, F.col(f"_carry_{n}")) for n in names}).drop("_carry_bucket")


def with_increments(accepted: DataFrame, spec: TickSpec) -> DataFrame:
    """A2: adds ``inc`` (volume added by the tick) and ``is_open_tick`` to accepted ticks carrying ``bucket`` and the
    cell columns."""
    cum = F.col(spec.cum)
    size = F.col(spec.size)
    w = _inside(spec)
    t = _carried(accepted, spec, [F.max_by(cum, F.when(cum.isNotNull(), arrival(spec))).alias("_last_cum")],
                 [("cum", F.last("_last_cum", ignorenulls=True))])
    t = t.withColumn("_rn", F.row_number().over(w)).withColumn(
        "_prev_cum", F.last(cum, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    opening = (F.col("_rn") == 1) & F.col("_carry_n").isNull()
    prev_cum = F.coalesce(F.col("_prev_cum"), F.col("_carry_cum"))
    inc = (
        F.when(opening, F.lit(0))
        .when(cum.isNotNull() & prev_cum.isNotNull(), F.greatest(cum - prev_cum, F.lit(0)))
        .when(size > 0, size)
        .otherwise(F.lit(0))
    )
    return t.withColumn("inc", inc).withColumn("is_open_tick", opening).drop("_rn", "_prev_cum", "_carry_n", "_carry_cum")


def accepted_ticks(ticks: DataFrame, spec: TickSpec, timeframe: str = "1m") -> DataFrame:
    """F3 + A2: accepted ticks with ``bucket``, the cell columns, ``inc``, ``is_open_tick``; one shuffle of ticks."""
    marked = mark_late(ticks, spec, timeframe)
    return with_increments(marked.where(~F.col("is_late")).drop("is_late"), spec)


def _time_cols(timeframe: str) -> list[Column]:
    length = timeframe_micros(timeframe)
    return [
        F.lit(timeframe).alias("timeframe"),
        F.col("bucket").alias("open_us"),
        # close = open + length - 1 ms
        (F.col("bucket") + F.lit(length - 1000)).alias("close_us"),
    ]


def candles(ticks: DataFrame, spec: TickSpec, timeframe: str = "1m") -> DataFrame:
    """A1 / A4: one final candle per (instrument, bucket).

    Columns: keys, timeframe, open_us, close_us, [currency], open, high, low, close, volume, tick_count.
    """
    return candles_from_accepted(accepted_ticks(ticks, spec, timeframe), spec, timeframe)


def candles_from_accepted(acc: DataFrame, spec: TickSpec, timeframe: str, published: bool = False) -> DataFrame:
    price = F.col(spec.price)
    pos = arrival(spec)
    # one row per cell and candle: no exchange, the accepted ticks are partitioned by cell
    per_cell = [
        F.min_by(price, pos).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, pos).alias("close"),
        F.sum("inc").alias("volume"), F.count(F.lit(1)).alias("tick_count"), F.min(pos).alias("_from"), F.max(pos).alias("_to"),
    ]
    whole = [
        F.min_by("open", "_from").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "_to").alias("close"), F.sum("volume").alias("volume"), F.sum("tick_count").alias("tick_count"),
    ]
    if spec.currency:
        # the candle's currency is its opening tick's, even a missing one
        per_cell.append(F.min_by(F.col(spec.currency), pos).alias("currency"))
        whole.append(F.min_by("currency", "_from").alias("currency"))
    if published:
        per_cell.append(F.max_by(F.col(spec.time_us), pos).alias("published_us"))
        whole.append(F.max_by("published_us", "_to").alias("published_us"))
    out = acc.groupBy(*cell_cols(spec), "bucket").agg(*per_cell).groupBy(*spec.keys, "bucket").agg(*whole)
    cur = ["currency"] if spec.currency else []
    pub = ["published_us"] if published else []
    return out.select(
        *spec.keys, *_time_cols(timeframe), *cur, "open", "high", "low", "close", "volume", "tick_count", *pub
    )


def candle_revisions(ticks: DataFrame, spec: TickSpec, timeframe: str = "1m") -> DataFrame:
    """A3: the message stream of the candle builder as a table.

    One ``candle.updated`` row per accepted tick (state after the tick) and one ``candle.closed`` row per
    candle (final state). ``rev`` numbers the revisions of a candle: 1..tick_count for updates, tick_count + 1
    for the close, so (keys, open_us, rev) is unique and ordered like the reference's publications.
    """
    keys = list(spec.keys)
    price = F.col(spec.price)
    acc = accepted_ticks(ticks, spec, timeframe)
    pos = arrival(spec)
    summary = [F.sum("inc").alias("_vol"), F.max(price).alias("_hi"), F.min(price).alias("_lo"), F.min_by(price, pos).alias("_open")]
    prefix = [("vol", F.sum("_vol")), ("hi", F.max("_hi")), ("lo", F.min("_lo")), ("open", F.first("_open", ignorenulls=True))]
    if spec.currency:
        summary.append(F.min_by(F.struct(F.col(spec.currency).alias("c")), pos).alias("_cur"))
        prefix.append(("cur", F.first("_cur", ignorenulls=True)))
    t = _carried(acc, spec, summary, prefix)

    running = _inside(spec).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cur = []
    if spec.currency:
        own = F.first(F.struct(F.col(spec.currency).alias("c"))).over(running)
        cur = [F.coalesce(F.col("_carry_cur"), own)["c"].alias("currency")]
    upd = t.select(
        *keys,
        *_time_cols(timeframe),
        *cur,
        F.coalesce(F.col("_carry_open"), F.first(price).over(running)).alias("open"),
        F.greatest(F.col("_carry_hi"), F.max(price).over(running)).alias("high"),
        F.least(F.col("_carry_lo"), F.min(price).over(running)).alias("low"),
        price.alias("close"),
        F.col(spec.time_us).alias("published_us"),
        (F.coalesce(F.col("_carry_vol"), F.lit(0)) + F.sum("inc").over(running)).alias("volume"),
        (F.coalesce(F.col("_carry_n"), F.lit(0)) + F.count(F.lit(1)).over(running)).alias("tick_count"),
    )
    upd = upd.withColumns({"event": F.lit("candle.updated"), "is_final": F.lit(False), "rev": F.col("tick_count")})
    # a closed candle is published when its minute is superseded; in a bounded batch it carries the time of its
    # last accepted tick
    closed = (
        candles_from_accepted(acc, spec, timeframe, published=True)
        .withColumn("event", F.lit("candle.closed"))
        .withColumn("is_final", F.lit(True))
        .withColumn("rev", F.col("tick_count") + 1)
    )
    return upd.unionByName(closed)


def rollup(candles_df: DataFrame, timeframe: str, keys: tuple[str, ...] = ("exchange", "symbol")) -> DataFrame:
    """A5: roll finer candles up to ``timeframe`` (UTC-aligned): open of the earliest, close of the latest,
    extremes, summed volume and tick count. Partial aggregation; the input is already one row per candle."""
    length = timeframe_micros(timeframe)
    has_cur = "currency" in candles_df.columns
    o = F.col("open_us")
    aggs = [
        F.min_by("open", o).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", o).alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("tick_count").alias("tick_count"),
    ]
    if has_cur:
        aggs.append(F.min_by("currency", o).alias("currency"))
    out = candles_df.withColumn("bucket", o - F.pmod(o, F.lit(length))).groupBy(*keys, "bucket").agg(*aggs)
    cur = ["currency"] if has_cur else []
    return out.select(
        *keys, *_time_cols(timeframe), *cur, "open", "high", "low", "close", "volume", "tick_count"
    )


__all__ = [
    "accepted_ticks",
    "candle_revisions",
    "candles",
    "rollup",
    "with_bucket",
    "with_increments",
]
