"""Benchmark decontamination: a generalised suffix automaton of the normalised test items, over words.

Every training text streams through the automaton once; the state tracks the longest suffix of the words read so far
that occurs in any item. A match of ``width`` words is a window of an item; an item of fewer words is one window.
Words of a document that no item has reset the state, so only runs of known words are streamed (a 64-bit hash finds
the runs, the exact words are looked up in them).

Items are a stated set that may be large: they are dealt into shards of at most ``SHARD_BYTES`` of text by a hash of
their id (an item of more is a shard of its own), one automaton per shard, and each is broadcast on its own. Every
batch of documents is held against every shard, so nothing grows beyond one shard in any process and no document is
shuffled.

Defined cases: a null or empty text has no words and no hits; an item without words or with a null id takes no part;
repeated item ids count once; repeated documents give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickengine.llm import textkit as tk
from tickengine.llm.common import documents, keeping_columns
from tickengine.session import ship

WIDTH = 13
MIN_COVER = 20  # contaminated: hit words make up one in this many, at least
SHARD_BYTES = 1 << 20


def item_words(text: str | None) -> list[bytes]:
    w = tk.words(tk.as_texts(pa.array([text], pa.string())), tk.LETTERS_DIGITS, lower=True)
    raw = w.data.tobytes()
    return [raw[a:b] for a, b in zip(w.starts.tolist(), w.ends.tolist(), strict=True)]


class ItemAutomaton:
    """Suffix automaton of all items' word sequences, with the items of every window of ``width`` words."""

    def __init__(self, items: list[tuple[str, str]], width: int = WIDTH):
        self.width = width
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in item_words(text)]
            if ids:
                sequences.append((item_id, ids))
                last = 0
                for c in ids:
                    last = self._extend(last, c)
        self.shortest = min([width, *(len(ids) for _, ids in sequences)])
        self._label(sequences)
        words = sorted(self.vocabulary)
        joined = tk.as_texts(pa.array(words, pa.binary()).cast(pa.large_string()) if words else pa.array([], pa.string()))
        self.hashes = np.sort(tk.words(joined, tk.LETTERS_DIGITS).hashes()) if words else np.zeros(0, np.uint64)

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _label(self, sequences) -> None:
        order = sorted(range(len(self.next)), key=self.length.__getitem__)
        # the state on the way up that holds the suffix of exactly ``width`` words
        self.window_state = [-1] * len(order)
        for v in order[1:]:
            if self.length[v] >= self.width:
                up = self.link[v]
                self.window_state[v] = v if self.length[up] < self.width else self.window_state[up]
        self.window_items: dict[int, set[str]] = {}
        own: dict[int, dict[int, set[str]]] = {}
        for item_id, ids in sequences:
            v = 0
            for n, c in enumerate(ids, 1):
                v = self.next[v][c]
                if n >= self.width:
                    self.window_items.setdefault(self.window_state[v], set()).add(item_id)
            if len(ids) < self.width:
                while self.length[self.link[v]] >= len(ids):
                    v = self.link[v]
                own.setdefault(v, {}).setdefault(len(ids), set()).add(item_id)
        # short items that end where a state ends, the state's own first
        self.short: dict[int, list[tuple[int, set[str]]]] = {}
        for v in order[1:]:
            found = sorted(own.get(v, {}).items(), reverse=True) + self.short.get(self.link[v], [])
            if found:
                self.short[v] = found

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans (start, end) of window occurrences in order of their ends, and the items they belong to."""
        spans, items = [], set()
        nxt, link, length, width, short = self.next, self.link, self.length, self.width, self.short
        v = n = 0
        for i, word in enumerate(words, 1):
            c = self.vocabulary.get(word)
            if c is None:
                v = n = 0
                continue
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            if n >= width:
                # the match may be shorter than its state's longest word sequence, but holds the window's state
                spans.append((i - width, i))
                items |= self.window_items[self.window_state[v]]
            if v in short:
                for size, ids in short[v]:
                    if size <= n:
                        spans.append((i - size, i))
                        items |= ids
        return spans, items


_automata: dict[str, ItemAutomaton] = {}


def _automaton(key: str, shard) -> ItemAutomaton:
    """One automaton is held at a time; it is built where it is used, from the broadcast texts."""
    if key not in _automata:
        _automata.clear()
        _automata[key] = ItemAutomaton(*shard.value)
    return _automata[key]


def item_shards(spark: SparkSession, items: DataFrame, width: int, shard_bytes: int) -> list:
    """Broadcasts of at most ``shard_bytes`` of item texts (or of one item), collected one after the other."""
    sized = items.filter("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-2 * total // shard_bytes)) if total > shard_bytes else 1
    shards = []
    for part in range(parts):
        rows: list[tuple[str, str]] = []
        held = 0
        for row in sized.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).toLocalIterator():
            size = len((row.text or "").encode())
            if rows and held + size > shard_bytes:
                shards.append(spark.sparkContext.broadcast((rows, width)))
                rows, held = [], 0
            rows.append((row.item_id, row.text))
            held += size
        if rows:
            shards.append(spark.sparkContext.broadcast((rows, width)))
    return shards


def _runs(known: np.ndarray, docs: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Word ranges of consecutive known words of one document, ``least`` words or longer."""
    if not len(known):
        return
    edges = np.flatnonzero((known[1:] != known[:-1]) | (docs[1:] != docs[:-1])) + 1
    starts = np.concatenate([[0], edges])
    ends = np.concatenate([edges, [len(known)]])
    keep = known[starts] & (ends - starts >= least)
    yield from zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)


def benchmark_hits(docs: DataFrame, items: DataFrame, width: int = WIDTH, shard_bytes: int = SHARD_BYTES,
                   keep_columns: bool = False) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, ``spans`` (maximal hit word ranges, end exclusive) and ``items`` (ids of
    items with an occurring window, sorted as strings). ``keep_columns`` keeps the documents' own columns."""
    spark = docs.sparkSession
    shards = item_shards(spark, items, width, shard_bytes)
    name = uuid.uuid4().hex
    out = "_n_words long, _n_hit long, _spans array<struct<start:long,end:long>>, _items array<string>"
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def found(texts: tk.Texts):
        w = tk.words(texts, tk.LETTERS_DIGITS, lower=True)
        hashes, of = w.hashes(), w.docs()
        n = np.diff(w.first)
        hit = np.zeros(len(hashes), dtype=bool)
        items_of: dict[int, set[str]] = {}
        for k, shard in enumerate(shards):
            automaton = _automaton(f"{name}-{k}", shard)
            at = np.searchsorted(automaton.hashes, hashes)
            known = np.zeros(len(hashes), dtype=bool)
            inside = at < len(automaton.hashes)
            known[inside] = automaton.hashes[at[inside]] == hashes[inside]
            for a, b in _runs(known, of, automaton.shortest):
                run = [w.data[s:e].tobytes() for s, e in zip(w.starts[a:b].tolist(), w.ends[a:b].tolist(), strict=True)]
                spans, got = automaton.stream(run)
                if spans:
                    for s, e in spans:
                        hit[a + s : a + e] = True
                    items_of.setdefault(int(of[a]), set()).update(got)
        spans_of: list[list] = [[] for _ in range(len(n))]
        for a, b in _runs(hit, of, 1):
            d = int(of[a])
            spans_of[d].append({"start": a - int(w.first[d]), "end": b - int(w.first[d])})
        hits = np.bincount(of[hit], minlength=len(n)) if len(n) else n
        return n, hits, spans_of, [sorted(items_of.get(d, ())) for d in range(len(n))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tk.as_texts(batch["text"])
            for lo, hi in tk.slices(texts):
                n, hits, spans, ids = found(tk.cut(texts, lo, hi))
                part = batch.slice(lo, hi - lo)
                columns = [part.column(i) for i in range(part.num_columns - (0 if keep_columns else 1))]
                names = part.schema.names[: len(columns)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(n.astype(np.int64)), pa.array(hits.astype(np.int64)), pa.array(spans, spans_type),
                     pa.array(ids, pa.list_(pa.string()))],
                    names=[*names, "_n_words", "_n_hit", "_spans", "_items"])

    source = docs if keep_columns else docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kept = [f for f in source.schema.fields if keep_columns or f.name != "text"]
    return source.mapInArrow(scan, T.StructType(kept + T.StructType.fromDDL(out).fields))


def contaminated(min_cover: int = MIN_COVER):
    return (F.col("_n_hit") > 0) & (F.col("_n_hit") * min_cover >= F.col("_n_words"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    hits = benchmark_hits(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return hits.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"),
                       F.size("_items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated documents go, the others stay as they are."""
    ship(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return keeping_columns(docs, lambda plain: benchmark_hits(plain, items, keep_columns=True).filter(~contaminated()))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[p : p + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT r, p, dw.n, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + n - 1)) AS q FROM m) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""
