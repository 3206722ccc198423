"""Forward as-of lookup: for each probe, the first row of the same key at or after a position.

Rows and probes are unioned, partitioned by (key, time bucket) and sorted from the latest position down, so each lookup
inside a bucket is the ``last(..., ignorenulls)`` of the rows so far: a running value, where a frame that reaches to the
partition's end would be read anew for every row. Probes that find nothing in their bucket take the first row of
the next non-empty bucket, from a per-bucket summary (one row per bucket). Linear work, no pairs, and no task
holds more than one bucket of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_at_or_after(
    rows: DataFrame,
    probes: DataFrame,
    keys: list[str],
    row_pos: tuple[Column, Column],
    probe_pos: tuple[Column, Column],
    payload: list[str],
    bucket: int,
    hit: str = "hit",
) -> DataFrame:
    """For every probe row, a struct column ``hit`` with the ``payload`` columns of the first row (same keys)
    whose position ``(t, s)`` is >= the probe's ``(pt, ps)``; null when there is none. Positions are pairs of
    longs ordered lexicographically; ``bucket`` is the time-bucket width on the first component."""
    probe_cols = [c for c in probes.columns if c not in keys]
    r = rows.select(
        *keys,
        row_pos[0].alias("_t"),
        row_pos[1].alias("_s"),
        F.lit(1).alias("_kind"),
        F.struct(*[F.col(c) for c in payload]).alias("_row"),
        *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in probe_cols],
    )
    p = probes.select(
        *keys,
        probe_pos[0].alias("_t"),
        probe_pos[1].alias("_s"),
        F.lit(0).alias("_kind"),
        F.lit(None).cast(r.schema["_row"].dataType).alias("_row"),
        *probe_cols,
    )
    u = r.unionByName(p).withColumn("_b", F.expr(f"_t div {int(bucket)}"))

    # inside the bucket: probes sort before rows at the same position, so the lookup is inclusive
    w = Window.partitionBy(*keys, "_b").orderBy(F.desc("_t"), F.desc("_s"), F.desc("_kind"))
    following = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = u.withColumn("_in", F.last("_row", ignorenulls=True).over(following)).where(F.col("_kind") == 0)

    # later buckets: first row of the next non-empty bucket. Probe buckets join the per-bucket summary with an
    # empty entry, so a probe in a bucket without rows also finds its successor (no pairs of buckets).
    row_buckets = (
        r.withColumn("_b", F.expr(f"_t div {int(bucket)}"))
        .groupBy(*keys, "_b")
        .agg(F.min_by("_row", F.struct("_t", "_s")).alias("_first"))
    )
    probe_buckets = p.select(*keys, F.expr(f"_t div {int(bucket)}").alias("_b")).distinct().select(
        *keys, "_b", F.lit(None).cast(r.schema["_row"].dataType).alias("_first")
    )
    buckets = row_buckets.unionByName(probe_buckets).groupBy(*keys, "_b").agg(
        F.first("_first", ignorenulls=True).alias("_first")
    )
    later = Window.partitionBy(*keys).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    nxt = buckets.select(*keys, "_b", F.last("_first", ignorenulls=True).over(later).alias("_next_first"))
    res = inside.join(nxt, [*keys, "_b"], "left")
    return res.select(*keys, *probe_cols, F.coalesce("_in", "_next_first").alias(hit))
