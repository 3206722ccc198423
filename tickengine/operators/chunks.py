"""Arrival chunks: the building block that keeps per-instrument running state parallel.

Running state in the reference (current candle, last cumulative volume, last published quote) is sequential per
instrument. A window over a whole instrument would put one instrument's history into one task, and one
instrument may hold a third of all ticks. Instead every running value is computed in two levels:

1. inside a cell -- one instrument's ticks of one arrival chunk (``seq div chunk_size``, per ``seq_prefix``) -- by an
   ordinary window;
2. across cells, from a summary row per cell whose exclusive prefix over the instrument's cells is joined back.

The ticks are shuffled once, by cell (:func:`deal`); the summaries, the windows and the joins all work on that
partitioning, and the summaries read the same exchange. Both levels are associative folds (max, last non-null, sum,
count), so the result equals the single-window one.

Cells are taken in arrival order: an instrument's partitions by their first record timestamp (a topic that grows moves
a key to another partition), then by chunk; inside a cell by the spec's order columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import TickSpec

CHUNK = "_chunk"
RANK = "_prank"


def chunk_cols(spec: TickSpec) -> list[str]:
    return [*spec.seq_prefix, CHUNK]


def cell_cols(spec: TickSpec) -> list[str]:
    return [*spec.keys, *chunk_cols(spec)]


def deal(ticks: DataFrame, spec: TickSpec) -> DataFrame:
    """Adds the chunk and shuffles the ticks by cell: the only shuffle of ticks that candles need.

    The other columns cross the exchange as one struct. Readers that need few of them would otherwise get an exchange
    of their own, with fewer columns, and the messages would be parsed once for each."""
    cell = cell_cols(spec)
    t = ticks.withColumn(CHUNK, F.expr(f"`{spec.seq}` div {int(spec.chunk_size)}"))
    for c in cell:  # the joins on cells ask for this; said here, it is the same for every reader of the exchange
        t = t.where(F.col(c).isNotNull())
    row = F.struct(*[F.col(c) for c in t.columns if c not in cell]).alias("_row")
    return t.select(*cell, row).repartition(*cell).select(*cell, F.inline(F.array("_row")))


def arrival(spec: TickSpec) -> Column:
    """The arrival order inside one instrument as one comparable value (for min_by / max_by): the partition's rank over
    the spec's order key, or a struct."""
    if spec.order_key:
        return F.shiftleft(F.coalesce(F.col(RANK), F.lit(0)).cast("long"), 48) + F.expr(spec.order_key)
    return F.struct(F.col(RANK), *[F.col(c) for c in spec.order])


def first_seen(spec: TickSpec) -> Column:
    """What a cell's summary needs for the order of an instrument's partitions."""
    return (F.min(F.unix_micros(spec.record_time)) if spec.record_time else F.lit(0)).alias("_seen")


def with_rank(cells: DataFrame, spec: TickSpec) -> DataFrame:
    """Adds the rank of the cell's partition among the instrument's, by first record timestamp."""
    if not spec.seq_prefix:
        return cells.withColumn(RANK, F.lit(0)).drop("_seen")
    prefix = [*spec.keys, *spec.seq_prefix]
    seen = cells.withColumn("_seen", F.min("_seen").over(Window.partitionBy(*prefix)))
    order = Window.partitionBy(*spec.keys).orderBy("_seen", *spec.seq_prefix)
    return seen.withColumn(RANK, F.dense_rank().over(order) - 1).drop("_seen")


def prior_cells(partition: list[str]) -> Window:
    """Exclusive prefix over the summaries of one group, in arrival order."""
    return Window.partitionBy(*partition).orderBy(RANK, CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def last_by_arrival(rows: DataFrame, keys: list[str], instrument: list[str], value: Column, record_us: Column,
                    within: tuple[str, ...] = (), ties: tuple[str, ...] = ()) -> DataFrame:
    """keys and ``_l``: the ``value`` of the last arrival of each key -- by ``within`` first, then by the instrument's
    partitions in order of their first record, then by offset (and ``ties``). Rows are read once and reduced to one per
    key and partition before anything is compared across partitions."""
    at = F.struct("offset", *ties) if ties else F.col("offset")
    per = rows.groupBy(*keys, *within, "partition").agg(F.max_by(value, at).alias("_l"), F.min(record_us).alias("_seen"))
    per = per.withColumn("_seen", F.min("_seen").over(Window.partitionBy(*instrument, "partition")))
    return per.groupBy(*keys).agg(F.max_by("_l", F.struct(*within, "_seen", "partition")).alias("_l"))
