"""Substring dedup by repeated-phrase automata, over words.

Recurring passages are confirmed shard by shard (see :mod:`recurring`): a passage is a window of ``WIDTH`` words that
occurs in two documents at least. The passages of a shard are compiled into one Aho-Corasick automaton over interned
words, and every text sent to the shard streams through it, which locates all occurrences exactly, overlapping ones too.
An occurrence is removed from every document but the one with the smallest doc_id.

Defined cases: a null or empty text has no words; rows that share a doc_id never remove from one another; a null
doc_id neither loses words nor makes others lose any; documents of fewer words than a window stay whole; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickengine.llm import textkit as tk
from tickengine.llm.common import documents
from tickengine.llm.recurring import Batch, Units, find, word_bytes
from tickengine.session import ship

WIDTH = 13
SEED = 4


def _windows(lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of each window over pieces end to end, and its piece."""
    counts = lengths - width + 1
    starts = np.cumsum(lengths) - lengths
    return tk.ranges(starts, counts), np.repeat(np.arange(len(lengths)), counts)


def _locate(width: int):
    def locate(batches: list[Batch]) -> np.ndarray:
        import ahocorasick

        interned: dict[bytes, int] = {}
        sizes, tokens = [], []
        for batch in batches:
            at = 0
            for n in batch.lengths.tolist():
                piece = [interned.setdefault(w, len(interned)) for w in batch.data[at : at + n - 1].split(b" ")]
                at += n
                sizes.append(len(piece))
                tokens.extend(piece)
        lengths, ids = np.array(sizes, dtype=np.int64), np.concatenate([b.ids for b in batches])
        words = np.array(tokens, dtype=np.uint64)
        starts, piece = _windows(lengths, width)
        # confirm: passages that pieces of different first documents hold, and the first document of each
        hashes = tk.windows_hash(tk.rolling(tk.mix(words + np.uint64(1))), width)[starts]
        order = np.argsort(hashes, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
        by_window = ids[piece][order]
        least, most = np.minimum.reduceat(by_window, heads), np.maximum.reduceat(by_window, heads)
        recurs = np.flatnonzero(least < most)
        first = ids[piece]  # a passage of one piece only starts where the piece does
        if not len(recurs):
            return first
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for k, at in zip(recurs.tolist(), starts[order[heads[recurs]]].tolist(), strict=True):
            automaton.add_word(tuple(tokens[at : at + width]), k)
        automaton.make_automaton()
        found = np.full(int(lengths.sum()), -1, dtype=np.int64)
        touched = np.zeros(len(lengths), dtype=bool)
        shared = np.zeros(len(heads), dtype=bool)
        shared[recurs] = True
        touched[piece[order[np.repeat(shared, np.diff(np.append(heads, len(order))))]]] = True
        ends = np.cumsum(lengths)
        for a, b in zip((ends - lengths)[touched].tolist(), ends[touched].tolist(), strict=True):
            for end, k in automaton.iter(tuple(tokens[a:b])):
                found[a + end - width + 1] = k
        found = found[starts]
        return np.where(found >= 0, least[found], first)

    return locate


def _kept_words(with_text: bool):
    def kept(w: tk.Words, first: np.ndarray, removed: np.ndarray) -> list[pa.Array]:
        index = np.flatnonzero(~removed)
        text, bounds = word_bytes(w, index)
        raw = text.tobytes()
        cuts = np.searchsorted(index, first, "left")
        texts = [raw[bounds[a] : max(bounds[b] - 1, bounds[a])] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        n = np.diff(first)
        columns = [pa.array(n.astype(np.int64)), pa.array((n - np.diff(cuts)).astype(np.int64)),
                   pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
        return [*columns, pa.array(texts, pa.binary()).cast(pa.string())] if with_text else columns

    return kept


def remove_repeated_passages(docs: DataFrame, width: int = WIDTH, seed: int = SEED, with_text: bool = False, **sizes) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed, kept_sha256 and, on request, ``kept_text``."""
    columns = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    ddl = "n_words long, n_removed long, kept_sha256 string"
    if with_text:
        columns, ddl = [*columns, ("kept_text", pa.string())], ddl + ", kept_text string"
    return find(docs, Units("words", width, seed), _locate(width), _kept_words(with_text), columns, ddl, **sizes)


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return remove_repeated_passages(documents(spark, sf_dir))


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents),
win AS (SELECT r, doc_id, p, array_to_string(w[p : p + 12], ' ') AS g
  FROM (SELECT r, doc_id, w, unnest(generate_series(1, len(w) - 12)) AS p FROM d WHERE len(w) >= 13)),
firsts AS (SELECT g, min(doc_id) AS f FROM win GROUP BY g),
gone AS (SELECT DISTINCT r, p + k AS q FROM win JOIN firsts USING (g), generate_series(0, 12) t(k) WHERE f < doc_id),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS t FROM words ANTI JOIN gone USING (r, q) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
