"""The quote producer's rules, as operators over a quote table.

A quote row has keys (the instrument), a position ``(t_us, seq)`` in publication order and signature columns
(bid, bidSize, ask, askSize, last, lastSize, close, volume by default). The producer publishes a quote unless its
signature equals the last *published* one (F6) or less than ``interval`` passed since the last publication (F7);
a suppressed quote changes neither.

F6 alone compares with the previous row (a suppressed row has the previous published signature anyway), so it is
a lag, done in two levels over time chunks. With F7 the decision depends on the last published row, which is a fold.
It is computed exactly without a per-instrument task:

* Where two quiet gaps of the interval follow one another, around a quote j, the quote after j finds the same state
  whatever came before: the signature of j, and time to publish. Instruments are split there into segments, by windows
  over (instrument, time chunk) cells and carries between them, on one shuffle of the quotes.
* If quote j is published, the next one is ``next(j)`` = the first row at least ``interval`` later whose signature
  differs from j's. A task holds whole segments; numpy finds ``next`` for all rows at once and follows the chains of all
  its segments side by side.
* A segment of more than ``SEGMENT_ROWS`` quotes (an instrument that is never quiet) is not held whole: its chain is
  followed per (instrument, time block) with a walk over block entry candidates in between.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import session_label
from ..session import materialize, ship
from .asof import first_at_or_after

# The producer's signature fields and default minimum interval
SIGNATURE = ("bid", "bidSize", "ask", "askSize", "last", "lastSize", "close", "volume")
MIN_INTERVAL_MS = 250


def clean_number(c: Column) -> Column:
    """NaN is missing."""
    return F.when(~F.isnan(c), c)


def clean_size(c: Column) -> Column:
    """Sizes are integers, truncated."""
    return clean_number(c).cast("long")


def label_sessions(quotes: DataFrame, t_us: str = "t_us", **kw) -> DataFrame:
    """P20: adds ``session`` and ``isPremarket``."""
    s = session_label(F.col(t_us), **kw)
    return quotes.withColumn("session", s).withColumn("isPremarket", s == "premarket")


def snapshot_events(raw: DataFrame, exchange: str = "ibkr", **session_kw) -> DataFrame:
    """Vendor snapshots -> the producer's tick messages (as columns) with key ``exchange:symbol``.

    NaN prices are missing, sizes are truncated to integers, ``source`` is
    ``exchange:symbol:currency:(primary exchange or exchange)``; the session is labelled from the quote time, or
    from the publish time when the quote has none (the message keeps a null ``sourceTimestamp``)."""
    from ..functions.text import iso_instant

    t = F.coalesce(F.col("time_us"), F.col("published_us"))
    s = session_label(t, **session_kw)
    return raw.select(
        F.concat_ws(":", F.lit(exchange), "symbol").alias("key"),
        F.lit(exchange + ".market_tick").alias("event"),
        F.concat_ws(":", F.lit(exchange), "symbol", "currency",
                    F.coalesce(F.nullif("primary_exchange", F.lit("")), F.col("ib_exchange"))).alias("source"),
        F.lit(exchange).alias("exchange"), "symbol", "currency", F.col("ib_exchange").alias("ibExchange"),
        F.col("primary_exchange").alias("primaryExchange"), F.col("con_id").alias("conId"),
        clean_number(F.col("bid")).alias("bid"), clean_size(F.col("bid_size")).alias("bidSize"),
        clean_number(F.col("ask")).alias("ask"), clean_size(F.col("ask_size")).alias("askSize"),
        clean_number(F.col("last")).alias("last"), clean_size(F.col("last_size")).alias("lastSize"),
        clean_number(F.col("close")).alias("close"), clean_size(F.col("volume")).alias("volume"),
        iso_instant(F.col("time_us")).alias("sourceTimestamp"),
        iso_instant(F.col("published_us")).alias("publishedAt"),
        s.alias("session"), (s == "premarket").alias("isPremarket"),
    )


def _sig(cols: tuple[str, ...]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def quote_changes(quotes: DataFrame, keys: list[str], t_us: str, seq: str,
                  signature: tuple[str, ...] = SIGNATURE, chunk_us: int = 3_600_000_000) -> DataFrame:
    """F6 without a throttle: rows whose signature differs (null-safe) from the previous row of the instrument."""
    q = quotes.withColumn("_sig", _sig(signature)).withColumn("_chunk", F.expr(f"`{t_us}` div {int(chunk_us)}"))
    pos = F.struct(F.col(t_us), F.col(seq))
    last_sig = q.groupBy(*keys, "_chunk").agg(F.max_by("_sig", pos).alias("_last"))
    carry = last_sig.select(
        *keys, "_chunk", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_carry")
    )
    w = Window.partitionBy(*keys, "_chunk").orderBy(t_us, seq)
    q = q.withColumn("_prev", F.lag("_sig").over(w)).join(carry, [*keys, "_chunk"], "left")
    prev = F.when(F.col("_prev").isNotNull(), F.col("_prev")).otherwise(F.col("_carry"))
    # the very first quote of an instrument has no predecessor: published
    first = F.col("_prev").isNull() & F.col("_carry").isNull()
    keep = first | ~F.col("_sig").eqNullSafe(prev)
    return q.where(keep).drop("_sig", "_chunk", "_prev", "_carry")


SEGMENT_ROWS = 1 << 18


def quote_throttle(quotes: DataFrame, keys: list[str], t_us: str, seq: str,
                   signature: tuple[str, ...] = SIGNATURE, interval_ms: int = MIN_INTERVAL_MS,
                   chunk_us: int = 3_600_000_000, segment_rows: int = SEGMENT_ROWS, block_us: int = 600_000_000,
                   bucket_us: int | None = None) -> DataFrame:
    """F6 + F7: the quotes the producer publishes. ``seq`` must make (keys, t_us, seq) unique."""
    ship(quotes.sparkSession)
    keys = list(keys)
    interval_us = int(interval_ms) * 1000
    q = _segments(quotes, keys, t_us, seq, signature, interval_us, int(chunk_us))
    sizes = q.groupBy(*keys, "_seg").agg(F.count("*").alias("_n"))
    q = materialize(q.join(sizes.hint("merge"), [*keys, "_seg"]))
    parts = int(quotes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    short = q.where(F.col("_n") <= segment_rows).withColumn("_bin", F.pmod(F.xxhash64(*keys, "_seg"), F.lit(4 * parts)))
    ids = [f"_k{i}" for i in range(len(keys))]
    # the hash skips missing values, so it is told which are
    digest = lambda c: F.xxhash64(c, *[F.col(f"{c}.`{x}`").isNull() for x in signature])
    small = short.select(F.col("_bin"), F.xxhash64(*keys).alias("_h"), "_seg", digest("_sig").alias("_sig"),
                         F.when(F.col("_first"), F.lit(None)).otherwise(digest("_init")).alias("_init"),
                         *[F.col(k).alias(i) for k, i in zip(keys, ids, strict=True)], F.col("_t"), F.col("_s"))
    key_types = ", ".join(f"{i} {quotes.schema[k].dataType.simpleString()}" for k, i in zip(keys, ids, strict=True))
    found = small.groupBy("_bin").applyInArrow(_follow(ids, interval_us), f"{key_types}, _t long, _s long")
    found = found.select(*[F.col(i).alias(k) for k, i in zip(keys, ids, strict=True)], "_t", "_s")

    # what a long segment opens with is its first quote that differs from the state it starts in: published for sure
    long = q.where(F.col("_n") > segment_rows)
    if not long.isEmpty():
        differs = F.col("_first") | ~F.col("_sig").eqNullSafe(F.col("_init"))
        # a row for each segment of more than segment_rows quotes
        opening = long.where(differs).groupBy(*keys, "_seg").agg(F.min(F.struct("_t", "_s")).alias("_open"))
        opened = long.join(F.broadcast(opening), [*keys, "_seg"]).where(F.struct("_t", "_s") >= F.col("_open"))
        bucket = int(bucket_us or max(interval_us, 60_000_000))
        pointers = materialize(_next_pointers(opened.select(*keys, "_seg", "_t", "_s", "_sig"), [*keys, "_seg"], interval_us, bucket))
        found = found.unionByName(_chain_by_blocks(pointers, [*keys, "_seg"], int(block_us)).drop("_seg"))
    return quotes.join(found.select(*keys, F.col("_t").alias(t_us), F.col("_s").alias(seq)), [*keys, t_us, seq], "left_semi")


def _segments(quotes: DataFrame, keys: list[str], t_us: str, seq: str, signature, interval_us: int, chunk_us: int) -> DataFrame:
    """keys, ``_t``, ``_s``, ``_sig``, and of the quote's segment: ``_seg`` (the time and sequence it starts at, as
    text), ``_init`` (the signature it starts with) and ``_first`` (whether it is the instrument's first)."""
    cell = [*keys, "_c"]
    base = quotes.select(*keys, F.expr(f"`{t_us}` div {chunk_us}").alias("_c"), F.struct(
        F.col(t_us).cast("long").alias("_t"), F.col(seq).cast("long").alias("_s"), _sig(signature).alias("_sig")).alias("_row"))
    for k in cell:
        base = base.where(F.col(k).isNotNull())
    q = base.repartition(*cell).select(*cell, F.inline(F.array("_row")))
    pos = F.struct("_t", "_s")
    w = Window.partitionBy(*cell).orderBy("_t", "_s")

    def gaps(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_quiet", F.col("_t") - F.lag("_t").over(w) >= interval_us)

    # what a cell's first quote needs of the cell before it: its last time and signature, and whether a gap led to it
    ends = gaps(q).groupBy(*cell).agg(F.max_by(F.struct("_t", "_sig", "_quiet"), pos).alias("_end"))
    order = Window.partitionBy(*keys).orderBy("_c")
    carry = ends.select(*cell, F.lag("_end").over(order).alias("_before"))
    q = gaps(q).withColumn("_lag", F.lag(F.struct("_t", "_sig", "_quiet")).over(w)).join(carry.hint("merge"), cell)
    q = q.withColumn("_lag", F.coalesce("_lag", "_before"))
    first = F.col("_lag").isNull()
    after_gap = F.col("_t") - F.col("_lag._t") >= interval_us
    # a gap of unknown length before a cell's first quote counts as none: segments are then longer, never wrong
    starts = first | (after_gap & F.coalesce(F.col("_lag._quiet"), F.lit(False)))
    q = q.withColumn("_start", F.when(starts, F.struct(F.col("_t"), F.col("_s"), F.col("_lag._sig").alias("_init"), first.alias("_first"))))
    q = q.select(*cell, "_t", "_s", "_sig", "_start")
    opened = q.groupBy(*cell).agg(F.max_by("_start", F.when(F.col("_start").isNotNull(), pos)).alias("_open"))
    earlier = opened.select(*cell, F.last("_open", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"))
    q = q.withColumn("_own", F.last("_start", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    q = q.join(earlier.hint("merge"), cell).withColumn("_own", F.coalesce("_own", "_earlier"))
    return q.select(*keys, "_t", "_s", "_sig", F.concat_ws(":", "_own._t", "_own._s").alias("_seg"), F.col("_own._init").alias("_init"),
                    F.col("_own._first").alias("_first"))


def _follow(ids: list[str], interval_us: int):
    """Published quotes of whole segments: the chains of all segments of a bin, one step of each at a time."""
    def follow(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("_h", "_seg", "_t", "_s")])
        h, t = table["_h"].to_numpy(), table["_t"].to_numpy()
        _, seg_name = np.unique(table["_seg"].to_pandas().to_numpy(), return_inverse=True)
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (seg_name[1:] != seg_name[:-1])])
        seg = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(t))[seg]
        sig = table["_sig"].to_numpy()
        n = np.arange(len(t))
        # the next quote of a segment with another signature, and the first one an interval later
        run = np.concatenate([[True], (sig[1:] != sig[:-1]) | new[1:]])
        heads = np.append(np.flatnonzero(run), len(t))
        other = heads[np.searchsorted(heads, n, "right")]
        later = t - t[starts][seg]
        span = int(later.max()) + interval_us + 1
        if span * (int(seg[-1]) + 2) < 1 << 62:
            place = seg * span + later
            after = np.searchsorted(place, place + interval_us, "left")
        else:  # times too far apart for one number: segment by segment
            after = np.concatenate([a + np.searchsorted(t[a:b], t[a:b] + interval_us, "left") for a, b in zip(starts, np.append(starts[1:], len(t)), strict=True)])
        after = np.maximum(after, n + 1)
        inside = after < ends
        same = np.zeros(len(t), dtype=bool)
        same[inside] = sig[after[inside]] == sig[inside]
        nxt = np.where(same, other[np.minimum(after, len(t) - 1)], after)
        # a segment opens with its first quote that differs from the state it starts in
        init = table["_init"]
        known = init.is_valid().to_numpy()[starts]
        equal = known & (init.fill_null(0).to_numpy()[starts] == sig[starts])
        at = np.where(equal, other[starts], starts)
        stop = ends[starts]
        published = np.zeros(len(t), dtype=bool)
        while len(at):
            live = at < stop
            at, stop = at[live], stop[live]
            published[at] = True
            at = nxt[at]
        return table.filter(pa.array(published)).select([*ids, "_t", "_s"])

    return follow


def _next_pointers(base: DataFrame, keys: list[str], interval_us: int, bucket: int) -> DataFrame:
    """For every quote j (columns keys, _t, _s, _sig): ``(_nt, _ns)`` = the quote published next if j is
    published, i.e. the first quote k with t_k >= t_j + interval (strictly after j) whose signature differs
    from j's; null when there is none.

    k0 = the first quote at or after t_j + interval. If its signature differs, next = k0; otherwise next is the
    first run start after k0 (a run = consecutive quotes with one signature). Every quote first gets its own
    "next run start" (one window pass per (instrument, time bucket), with carries from neighbouring buckets), and
    the as-of lookup for k0 returns that value with k0, so no join back is needed."""
    pos = F.struct("_t", "_s")
    b = base.withColumn("_b", F.expr(f"_t div {bucket}"))
    w = Window.partitionBy(*keys, "_b").orderBy("_t", "_s")
    by_bucket = Window.partitionBy(*keys).orderBy("_b")
    # the rows after one are those before it in the opposite order: a running value, linear in the rows
    w_back = Window.partitionBy(*keys, "_b").orderBy(F.desc("_t"), F.desc("_s")).rowsBetween(Window.unboundedPreceding, -1)
    back_by_bucket = Window.partitionBy(*keys).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)

    # run starts: the signature differs from the previous quote's (the previous bucket's last one at a border)
    last_sig = b.groupBy(*keys, "_b").agg(F.max_by("_sig", pos).alias("_last"))
    carry_sig = last_sig.select(*keys, "_b", F.lag("_last").over(by_bucket).alias("_carry"))
    b = b.withColumn("_prev", F.lag("_sig").over(w)).join(carry_sig, [*keys, "_b"], "left")
    prev = F.when(F.col("_prev").isNotNull(), F.col("_prev")).otherwise(F.col("_carry"))
    start = prev.isNull() | ~F.col("_sig").eqNullSafe(prev)
    b = materialize(b.select(*keys, "_b", "_t", "_s", "_sig", F.when(start, pos).alias("_rs")))

    # next run start strictly after each quote: inside the bucket, else the first one of a later bucket
    first_rs = b.groupBy(*keys, "_b").agg(F.min("_rs").alias("_frs"))
    later = first_rs.select(*keys, "_b", F.min("_frs").over(back_by_bucket).alias("_later_rs"))
    b = b.withColumn("_rn_in", F.min("_rs").over(w_back)).join(later, [*keys, "_b"], "left")
    rows = b.select(*keys, "_t", "_s", "_sig", F.coalesce("_rn_in", "_later_rs").alias("_rn"))

    # k0 with its signature and next run start
    probes = rows.select(*keys, F.col("_t").alias("_jt"), F.col("_s").alias("_js"), F.col("_sig").alias("_jsig"))
    strict = F.when(F.lit(interval_us) > 0, F.lit(-(2**63))).otherwise(F.col("_js") + 1)
    k0 = first_at_or_after(rows, probes, keys, (F.col("_t"), F.col("_s")),
                           (F.col("_jt") + F.lit(interval_us), strict), ["_t", "_s", "_sig", "_rn"], bucket, hit="_k0")
    differs = ~F.col("_k0._sig").eqNullSafe(F.col("_jsig"))
    nxt = F.when(F.col("_k0").isNull(), F.lit(None)).when(differs, F.struct(F.col("_k0._t").alias("_t"), F.col("_k0._s").alias("_s"))) \
        .otherwise(F.col("_k0._rn"))
    return k0.select(*keys, F.col("_jt").alias("_t"), F.col("_js").alias("_s"), nxt.alias("_n")).select(
        *keys, "_t", "_s", F.col("_n._t").alias("_nt"), F.col("_n._s").alias("_ns"))


def _exit_fn(keys: list[str]):
    """Per (instrument, block): where the chain goes after leaving the block, from every quote of the block."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_t", "_s"], ascending=False)
        exit_of: dict[tuple, tuple] = {}
        ets, ess = [], []
        for t, s_, nt, ns, nb, b in zip(pdf["_t"], pdf["_s"], pdf["_nt"], pdf["_ns"], pdf["_nblk"], pdf["_blk"]):
            if pd.isna(nt):
                e = (None, None)
            elif nb != b:
                e = (int(nt), int(ns))
            else:
                e = exit_of[(int(nt), int(ns))]
            exit_of[(int(t), int(s_))] = e
            ets.append(e[0])
            ess.append(e[1])
        out = pdf[[*keys, "_t", "_s"]].copy()
        out["_et"] = pd.array(ets, dtype="Int64")
        out["_es"] = pd.array(ess, dtype="Int64")
        return out
    return fn


def _walk_entries_fn(keys: list[str]):
    """Per instrument, over block entry candidates only: the chain's entry quote of every block it visits."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        nxt = {(int(t), int(s_)): (None if pd.isna(et) else (int(et), int(es)))
               for t, s_, et, es in zip(pdf["_t"], pdf["_s"], pdf["_et"], pdf["_es"])}
        node = min(nxt)
        out = []
        while node is not None:
            out.append(node)
            node = nxt[node]
        res = pd.DataFrame(out, columns=["_t", "_s"])
        for k in keys:
            res.insert(0, k, pdf[k].iloc[0])
        return res[[*keys, "_t", "_s"]]
    return fn


def _walk_block_fn(keys: list[str]):
    """Per (instrument, block) with its entry marked: the published quotes inside the block."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        entry = pdf[pdf["_entry"]]
        if entry.empty:
            return pdf.iloc[0:0][[*keys, "_t", "_s"]]
        nxt = {(int(t), int(s_)): (None if pd.isna(nt) or nb != b else (int(nt), int(ns)))
               for t, s_, nt, ns, nb, b in zip(pdf["_t"], pdf["_s"], pdf["_nt"], pdf["_ns"], pdf["_nblk"], pdf["_blk"])}
        node = (int(entry["_t"].iloc[0]), int(entry["_s"].iloc[0]))
        out = []
        while node is not None:
            out.append(node)
            node = nxt[node]
        res = pd.DataFrame(out, columns=["_t", "_s"])
        for k in keys:
            res.insert(0, k, pdf[k].iloc[0])
        return res[[*keys, "_t", "_s"]]
    return fn


def _chain_by_blocks(pointers: DataFrame, keys: list[str], block_us: int) -> DataFrame:
    """Published quotes = the chain first -> next -> ... of each instrument, without a sequential pass over an
    instrument: groups are (instrument, time block), plus one small group per instrument holding only the block
    entry candidates (targets of pointers that cross into a later block, and the first quote)."""
    key_schema = ", ".join(f"`{k}` {pointers.schema[k].dataType.simpleString()}" for k in keys)
    p = pointers.withColumn("_blk", F.expr(f"_t div {block_us}")).withColumn("_nblk", F.expr(f"_nt div {block_us}"))
    exits = p.groupBy(*keys, "_blk").applyInPandas(
        _exit_fn(keys), f"{key_schema}, _t long, _s long, _et long, _es long")
    crossing = p.where(F.col("_nblk") > F.col("_blk")).select(*keys, F.col("_nt").alias("_t"), F.col("_ns").alias("_s"))
    firsts = p.groupBy(*keys).agg(F.min(F.struct("_t", "_s")).alias("_r")).select(
        *keys, F.col("_r._t").alias("_t"), F.col("_r._s").alias("_s"))
    candidates = crossing.unionByName(firsts).distinct()
    entries = exits.join(candidates, [*keys, "_t", "_s"], "left_semi").groupBy(*keys).applyInPandas(
        _walk_entries_fn(keys), f"{key_schema}, _t long, _s long").withColumn("_entry", F.lit(True))
    marked = p.join(entries, [*keys, "_t", "_s"], "left").withColumn("_entry", F.coalesce("_entry", F.lit(False)))
    return marked.groupBy(*keys, "_blk").applyInPandas(_walk_block_fn(keys), f"{key_schema}, _t long, _s long")
