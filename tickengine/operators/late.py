"""late-tick drop.

A tick is late when its candle bucket is older than the instrument's current candle, i.e. than the largest bucket
among all ticks that arrived before it (late ticks never raise that maximum, so the running max over all earlier
ticks is the current open candle). Computed in two levels over arrival cells (see :mod:`.chunks`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import TickSpec, timeframe_micros
from .chunks import CHUNK, RANK, cell_cols, deal, first_seen, prior_cells, with_rank


def with_bucket(ticks: DataFrame, spec: TickSpec, timeframe: str = "1m") -> DataFrame:
    """P10: UTC-aligned bucket start in epoch micros (``bucket``)."""
    length = timeframe_micros(timeframe)
    t = F.col(spec.time_us)
    return ticks.withColumn("bucket", t - F.pmod(t, F.lit(length)))


def mark_late(ticks: DataFrame, spec: TickSpec, timeframe: str = "1m") -> DataFrame:
    """Adds ``bucket``, the cell columns and ``is_late`` to every tick; the result is partitioned by cell. Ticks without
    an instrument (a null key; parsed ticks have none) take no part."""
    cell = cell_cols(spec)
    t = with_bucket(deal(ticks, spec), spec, timeframe)

    # level 2: largest bucket of all earlier cells of the instrument (one summary row a cell, then a small prefix)
    cells = with_rank(t.groupBy(*cell).agg(F.max("bucket").alias("_cell_max"), first_seen(spec)), spec)
    carry = cells.select(*cell, RANK, F.max("_cell_max").over(prior_cells(list(spec.keys))).alias("_carry_max"))

    # level 1: largest bucket of earlier ticks in the same cell
    inside = Window.partitionBy(*cell).orderBy(*spec.order).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("_cell_prior", F.max("bucket").over(inside)).join(carry.hint("merge"), cell)
    current_open = F.greatest(F.col("_cell_prior"), F.col("_carry_max"))
    return t.withColumn("is_late", F.coalesce(F.col("bucket") < current_open, F.lit(False))).drop("_cell_prior", "_carry_max")


def late_ticks(ticks: DataFrame, spec: TickSpec, timeframe: str = "1m") -> DataFrame:
    """The ticks the candle builder skips (the reference logs them; here they are a table)."""
    return mark_late(ticks, spec, timeframe).where(F.col("is_late")).drop(CHUNK, RANK, "is_late")
