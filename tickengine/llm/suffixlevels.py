"""Suffix-array dedup over bytes: a logarithmic family of indexes.

In every shard (see :mod:`recurring`) the batches arrive one after the other. A batch gets a suffix array of its
windows (their first ``WIDTH`` bytes in order), which is merge-scanned against the level of its size: equal neighbours
in the merged order are matches of ``WIDTH`` bytes, which are counted for the smallest doc_id that holds them, and the
two merge into one array for the next level, and so on while a level of that size exists. The levels left at the end
are merged too, so every batch has met every other. A window is sorted once, in its batch, and merged a logarithmic
number of times; windows are compared by their bytes only.

Defined cases: a null or empty text has no bytes; rows that share a doc_id never remove from one another; a null
doc_id neither loses bytes nor makes others lose any; texts shorter than a window stay whole; a match never crosses
documents; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickengine.llm import textkit as tk
from tickengine.llm.common import documents
from tickengine.llm.passages import _windows
from tickengine.llm.recurring import Batch, Units, find
from tickengine.session import ship

WIDTH = 50
SEED = 16
BATCH_WINDOWS = 1 << 17


@dataclass
class Level:
    """Distinct windows in byte order: where each starts in the shard's text, the least doc_id, and the batches whose
    windows point into it."""

    starts: np.ndarray
    ids: np.ndarray
    members: list[int]
    rank: int


def _bytes_at(eight: np.ndarray, starts: np.ndarray, skip: int, count: int) -> np.ndarray:
    """``count`` (1 to 8) bytes from ``skip`` of each window as one number in byte order."""
    return eight[starts + skip] >> np.uint64(8 * (8 - count))


def _byte_order(eight: np.ndarray, starts: np.ndarray, width: int, cut: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Order of windows by their bytes, and which of them, in that order, differ from their left neighbour.

    With ``cut``, the windows before it and those from it on are each in byte order already, and are merged: numpy's
    stable sort of 64-bit numbers finds ascending runs and merges them, so two of them take linear time. Windows still
    tied are told apart by their next bytes behind the number of their group, again as two ascending runs."""
    kind = "stable" if cut else None
    skip = min(8, width)
    key = _bytes_at(eight, starts, 0, skip)
    order = np.argsort(key, kind=kind)
    key = key[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    while skip < width:
        tied = np.flatnonzero(~new | np.append(~new[1:], False))
        if not len(tied):
            break
        windows = order[tied]
        group = np.cumsum(new[tied]) - 1
        step = min(7, (64 - int(group[-1]).bit_length()) // 8, width - skip)
        late = windows >= cut
        runs = np.concatenate([np.flatnonzero(~late), np.flatnonzero(late)])
        key = group[runs].astype(np.uint64) << np.uint64(8 * step) | _bytes_at(eight, starts[windows[runs]], skip, step)
        by = np.argsort(key, kind=kind)
        key = key[by]
        order[tied] = windows[runs[by]]
        new[tied[1:]] = key[1:] != key[:-1]
        skip += step
    return order, new


def _scan(eight, width, starts, ids, cut: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One scan of the windows in byte order: equal neighbours are one window of the least id. Distinct windows in byte
    order (starts, least ids), and the place of each given one among them."""
    order, new = _byte_order(eight, starts, width, cut)
    heads = np.flatnonzero(new)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return starts[order[heads]], np.minimum.reduceat(ids[order], heads), place


def _levels(width: int, batch_windows: int):
    def match(batches: list[Batch]) -> np.ndarray:
        data = np.frombuffer(b"".join(b.data for b in batches), dtype=np.uint8)
        eight = np.zeros(len(data), dtype=np.uint64)
        ahead = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
        for k in range(8):
            eight |= ahead[k : k + len(data)].astype(np.uint64) << np.uint64(56 - 8 * k)
        lengths = np.concatenate([b.lengths for b in batches])
        ids = np.concatenate([b.ids for b in batches])
        starts, piece = _windows(lengths, width)
        of_batch = np.searchsorted(piece, np.cumsum([0, *(len(b.lengths) for b in batches)]))
        cuts = [0]  # small batches go in together
        for b in of_batch[1:].tolist():
            if b - cuts[-1] >= batch_windows or b == len(starts):
                if b > cuts[-1]:
                    cuts.append(b)
        places: list[np.ndarray] = []
        levels: dict[int, Level] = {}

        def merged(a: Level, b: Level) -> Level:
            s, i, place = _scan(eight, width, np.concatenate([a.starts, b.starts]), np.concatenate([a.ids, b.ids]), len(a.starts))
            for members, shift in ((a.members, 0), (b.members, len(a.starts))):
                for m in members:
                    places[m] = place[places[m] + shift]
            return Level(s, i, a.members + b.members, max(a.rank, b.rank) + 1)

        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            s, i, place = _scan(eight, width, starts[lo:hi], ids[piece[lo:hi]])
            places.append(place)
            level = Level(s, i, [len(places) - 1], 0)
            while level.rank in levels:
                level = merged(levels.pop(level.rank), level)
            levels[level.rank] = level
        last = None
        for rank in sorted(levels):
            last = levels[rank] if last is None else merged(levels[rank], last)
        return last.ids[np.concatenate(places)]

    return match


def _kept_bytes(with_text: bool):
    def kept(texts: tk.Texts, first: np.ndarray, removed: np.ndarray) -> list[pa.Array]:
        before = np.concatenate([[0], np.cumsum(removed)])
        opens = removed.copy()
        opens[1:] &= ~removed[:-1]
        bounds = first[first < len(removed)]
        opens[bounds] = removed[bounds]
        spans = np.concatenate([[0], np.cumsum(opens)])
        raw = texts.data[~removed].tobytes()
        cuts = (first - before[first]).tolist()
        out = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        columns = [pa.array(np.diff(first).astype(np.int64)), pa.array(np.diff(before[first]).astype(np.int64)),
                   pa.array(np.diff(spans[first]).astype(np.int64)), pa.array([hashlib.sha256(t).hexdigest() for t in out], pa.string())]
        return [*columns, pa.array(out, pa.binary())] if with_text else columns

    return kept


def remove_repeated_bytes(docs: DataFrame, width: int = WIDTH, seed: int = SEED, with_text: bool = False,
                          batch_windows: int = BATCH_WINDOWS, **sizes) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, on request, ``kept_bytes`` (removal may
    cut a character, so they are binary)."""
    columns = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    ddl = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        columns, ddl = [*columns, ("kept_bytes", pa.binary())], ddl + ", kept_bytes binary"
    return find(docs, Units("bytes", width, seed), _levels(width, batch_windows), _kept_bytes(with_text), columns, ddl, **sizes)


def op4_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return remove_repeated_bytes(documents(spark, sf_dir))


# bytes are worked on as hex digits: window p covers digits 2p - 1 to 2p + 98
OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT r, doc_id, p, substr(h, 2 * p - 1, 100) AS g
  FROM (SELECT r, doc_id, h, unnest(generate_series(1, CAST(length(h) // 2 - 49 AS BIGINT))) AS p FROM d WHERE length(h) >= 100)),
firsts AS (SELECT g, min(doc_id) AS f FROM win GROUP BY g HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM win JOIN firsts USING (g) WHERE f < doc_id),
runs AS (SELECT r, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS k FROM hits),
spans AS (SELECT r, k, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY r, k),
pieces AS (SELECT r, k, lag(b, 1, 1) OVER (PARTITION BY r ORDER BY k) AS x, a AS y FROM spans
  UNION ALL SELECT r, max(k) + 1, max(b), NULL FROM spans GROUP BY r),
kept AS (SELECT r, string_agg(CASE WHEN y IS NULL THEN substr(h, 2 * x - 1) ELSE substr(h, 2 * x - 1, 2 * (y - x)) END, '' ORDER BY k) AS t
  FROM pieces JOIN d USING (r) GROUP BY r),
sums AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed FROM spans GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(t, h))) AS kept_sha256
FROM d LEFT JOIN sums USING (r) LEFT JOIN kept USING (r)
"""
