"""Periodic runs of words, found with string synchronising sets.

A run is a longest stretch of consecutive words with smallest period q. At every dyadic scale t the windows of t words
have exact names (a name of 2t words is a pair of names of t words, so equal names mean equal words). The synchronising
set of the scale holds the places i where, among the windows that start at i, ..., i + t and are not highly periodic
(period at most t / 3), the least hashed name stands first or last. Membership depends on the 2t words from i on alone,
so a run of period q repeats its members with distance q. Two members with equal contexts (2t words) at a distance of
2t to 4t propose that distance as a period; a proposal is followed word by word to both sides, so nothing rests on a
hash. Every run of at least three periods has such a pair at the one scale with 2t <= q < 4t: its places that are not
highly periodic hold a member in every t. The highly periodic windows which the sets leave out are those inside runs of
period up to t / 3, which smaller scales have found; runs of period 1 are read off directly.

Before each scale, only stretches in which every window occurs again in the same document are kept (all windows of a
run do), so prose costs little beyond the smallest scales.

Words are `[^\\x20\\x09-\\x0D]+`. The work is narrow (no shuffle); arrays cover slices of about a megabyte, one document
at least.

Defined cases: a null or empty text has no words and no runs (its collapsed text is empty); repeated rows are repeated
in the result; a null doc_id is kept (the query leaves its words as they are); other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickengine.llm import textkit as tk
from tickengine.llm.common import documents
from tickengine.session import ship

EXPONENT = 4
LEAST_LENGTH = 6
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_NEIGHBOURS = 12  # equal contexts of members are more than t / 3 apart, so at most twelve stand within 4t
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest stretches of set flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _agreement(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two arrays of one length share from their start on."""
    at, size = 0, 32
    while at < len(x):
        differs = x[at : at + size] != y[at : at + size]
        k = int(differs.argmax())
        if differs[k]:
            return at + k
        at, size = at + size, size * 2
    return len(x)


def _followed(codes: np.ndarray, low: int, high: int, place: int, period: int) -> tuple[int, int]:
    """The longest stretch of ``codes[low:high]`` with the period that holds ``place`` and ``place + period``."""
    ahead = _agreement(codes[place : high - period], codes[place + period : high])
    back = _agreement(codes[low:place][::-1], codes[low + period : place + period][::-1])
    return place - back, place + period + ahead


def cubic_runs(codes: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], int]:
    """(start, end) -> smallest period of every longest stretch that holds three of its periods. ``codes`` are the words
    of some documents end to end, equal numbers for equal words of a document; ``bounds`` the documents' bounds."""
    found: dict[tuple[int, int], int] = {}
    lengths = np.diff(bounds)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    if not len(codes):
        return found
    start, end = _stretches((codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1]))
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        if b - a >= 2:
            found[a, b + 1] = 1

    # the words that occur again in their document, in stretches
    _, name, counts = np.unique(doc * (int(codes.max()) + 1) + codes, return_inverse=True, return_counts=True)
    again = counts[name] > 1
    keep, stop = _kept(again, np.repeat(bounds[1:], lengths), 1, 6)
    place, name = keep, name[keep]
    t = 1
    while len(place):
        # names of windows of 2t words, at the places where one fits
        at = np.flatnonzero(np.arange(len(place)) + 2 * t <= stop)
        if not len(at):
            break
        _, pair, counts = np.unique(name[at] * (int(name.max()) + 1) + name[at + t], return_inverse=True, return_counts=True)
        twice = np.zeros(len(place), dtype=np.int64)
        twice[at] = pair
        again = np.zeros(len(place), dtype=bool)
        again[at] = counts[pair] > 1
        keep, kept_stop = _kept(again, stop, 2 * t, 4 * t + 1)
        if not len(keep):
            break
        place, name, twice, again, stop = place[keep], name[keep], twice[keep], again[keep], kept_stop
        members = _synchronising(place, name, again, stop, t, found, len(codes))
        last, reach = 0, 0
        for s, period in _proposed(members, place, twice, t):
            if period == last and s < reach:
                continue  # in the stretch that was followed last
            d = doc[s]
            a, b = _followed(codes, int(bounds[d]), int(bounds[d + 1]), s, period)
            last, reach = period, b - period
            if b - a >= 3 * period:
                found.setdefault((a, b), period)  # a multiple of the period comes later and finds the same stretch
        name, t = twice, 2 * t
    return found


def _kept(again: np.ndarray, stop: np.ndarray, width: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of all words in stretches of ``least`` windows (of ``width`` words) that occur again, and the end of each
    place's stretch in the new numbering. Stretches end with their segment; those whose words overlap become one."""
    edge = np.ones(len(again) + 1, dtype=bool)
    edge[1:-1] = (stop[1:] != stop[:-1]) | (again[1:] != again[:-1])
    start, end = np.flatnonzero(again & edge[:-1]), np.flatnonzero(again & edge[1:]) + 1
    long = end - start >= least
    start, end = start[long], end[long] + width - 1
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = np.flatnonzero(np.concatenate([[True], start[1:] >= end[:-1]]))
    start, end = start[head], np.maximum.reduceat(end, head)
    sizes = end - start
    return tk.ranges(start, sizes), np.repeat(np.cumsum(sizes), sizes)


def _synchronising(place, name, again, stop, t: int, found: dict, total: int) -> np.ndarray:
    """The members of scale t whose contexts occur again."""
    n = len(place)
    here = np.arange(n)
    hashed = tk.mix(name.astype(np.uint64) + np.uint64(1))
    hashed[here + t > stop] = _NONE
    small = [(a, b - t + 1) for (a, b), p in found.items() if 3 * p <= t <= b - a]
    if small:  # windows inside a run of a small period
        edge = np.zeros(total + 1, dtype=np.int32)
        np.add.at(edge, [a for a, _ in small], 1)
        np.add.at(edge, [b for _, b in small], -1)
        hashed[(np.cumsum(edge) > 0)[place]] = _NONE
    least = tk.sliding(hashed, t + 1, np.minimum)
    inside = np.flatnonzero(again & (here + 2 * t <= stop))
    low = least[inside]
    return inside[(low != _NONE) & ((low == hashed[inside]) | (low == hashed[inside + t]))]


def _proposed(members: np.ndarray, place: np.ndarray, context: np.ndarray, t: int) -> list[tuple[int, int]]:
    """(place, period) of members with equal contexts, by period and place."""
    order = np.argsort(context[members], kind="stable")
    at, of = place[members[order]], context[members[order]]
    starts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(1, min(_NEIGHBOURS + 1, len(at))):
        apart = at[k:] - at[:-k]
        near = (of[k:] == of[:-k]) & (apart < 4 * t)
        if not near.any():
            break
        wide = near & (apart >= 2 * t)
        starts.append(at[:-k][wide])
        periods.append(apart[wide])
    s, q = np.concatenate(starts), np.concatenate(periods)
    order = np.lexsort((s, q))
    s, q = s[order], q[order]
    # the words of a pair agree over [s, s + 2t): a next pair of the period that starts in there is of the same stretch
    head = np.ones(len(s), dtype=bool)
    head[1:] = (q[1:] != q[:-1]) | (s[1:] > s[:-1] + 2 * t)
    return list(zip(s[head].tolist(), q[head].tolist(), strict=True))


def runs_of(codes: np.ndarray, bounds: np.ndarray, exponent: int = EXPONENT, least: int = LEAST_LENGTH) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each document's runs, by start and period."""
    if exponent < 3:
        raise ValueError("the sets find runs of three periods and more")
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(bounds) - 1)]
    for (a, b), period in cubic_runs(codes, bounds).items():
        if b - a >= max(least, exponent * period):
            d = int(np.searchsorted(bounds, a, "right")) - 1
            out[d].append((a - int(bounds[d]), b - a, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if runs:
        drop = bytearray(len(words))
        for start, length, period in runs:
            drop[start + period : start + length] = b"\x01" * (length - period)
        words = [w for w, gone in zip(words, drop, strict=True) if not gone]
    return b" ".join(words)


Change = Callable[[int | None, list[bytes]], list[bytes]]


def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, least: int = LEAST_LENGTH, change: Change | None = None) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period; by start, then period) and the collapsed text of every
    document. Runs hold at least ``exponent`` periods (three or more) and ``least`` words. ``change`` may replace a
    document's words first."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tk.as_texts(batch["text"])
            for lo, hi in tk.slices(texts):
                ids = batch["doc_id"].slice(lo, hi - lo)
                numbers: dict[bytes, int] = {}
                each, codes, bounds = [], [], [0]
                for d, doc_id in enumerate(ids.to_pylist(), lo):
                    words = texts.data[texts.offsets[d] : texts.offsets[d + 1]].tobytes().split()
                    if change:
                        words = change(doc_id, words)
                    each.append(words)
                    codes.extend([numbers.setdefault(w, len(numbers)) for w in words])
                    bounds.append(len(codes))
                runs = runs_of(np.array(codes, dtype=np.int64), np.array(bounds, dtype=np.int64), exponent, least)
                rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in of] for of in runs]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.diff(bounds)), pa.array(rows, _RUNS), pa.array(map(collapsed, each, runs), pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scan, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def repeats_by_id(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's change: one document in ten, by the checksum of its id, repeats some of its words to its end."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = periodic_runs(documents(spark, sf_dir), change=repeats_by_id)
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("_best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.s").alias("start"), (-F.col("_best.l")).alias("length"),
        F.col("_best.p").alias("period"), F.expr("1000 * -_best.l div _best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
