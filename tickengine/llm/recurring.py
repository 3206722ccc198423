"""Windows of ``width`` units (words or bytes) that recur in documents of different ids, at any scale.

Copies of a whole text lose everything to the first of them and take no further part. Documents are dealt into slices
of about ``SLICE_TEXT`` bytes by a hash of doc_id. Everything that leaves a slice is packed: one row per slice and
receiving part, its entries combined inside the slice, so that a passage which a third of all documents hold arrives
once a slice. Nothing is gathered by passage.

1. :func:`find` -- each window has a minimiser, the least hash of its runs of ``seed`` units; equal windows have equal
   minimisers. The minimisers of a slice go to parts by value; a part answers which of them occur in two documents.
2. Windows with such a minimiser are candidates. Consecutive ones with one minimiser make a piece; the distinct pieces
   of a slice, with the least doc_id that holds each, go to shards by minimiser, so all copies of a window meet.
3. In a shard, equal pieces are one; ``match`` (the operator's own method) finds, exactly, the smallest doc_id in which
   each window of the distinct pieces starts. A slice gets back whether that is smaller than its own least one; the
   slice's other documents with the piece have such a document in any case.
4. ``finish`` gets each document's hit windows, back in the slices, and makes the result.

The pieces of a slice are derived twice (steps 2 and 4) from rows in one fixed order, so answers need no ids. All of it
is one lazy plan: documents are shuffled once and that exchange is reused; a lost executor costs recomputed tasks.
Rows that leave the slices never outnumber their entries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickengine.llm import textkit as tk
from tickengine.llm.common import ratio, shuffle_partitions

SLICE_TEXT = 8 << 20
SHARD_TEXT = 2 << 20

_PACK = "shard long, slice long, blob binary, lengths binary, ids binary, keys binary"
_NO_ID = np.iinfo(np.int64).max  # a null doc_id: no other document is later


@dataclass(frozen=True)
class Units:
    """What a window counts: ``words`` or ``bytes`` of a text, ``width`` in a window, ``seed`` in a minimiser."""

    kind: str
    width: int
    seed: int

    def read(self, texts: tk.Texts) -> tuple[tk.Words | tk.Texts, np.ndarray, np.ndarray]:
        """The units, their hash prefix and the bounds of documents among them."""
        if self.kind == "words":
            w = tk.words(texts, tk.NOT_SPACE)
            return w, tk.rolling(w.hashes()), w.first
        return texts, tk.rolling(tk.byte_values(texts)), texts.offsets

    def windows(self, batch: "Batch") -> np.ndarray:
        """Windows of each piece of a batch."""
        if self.kind == "bytes":
            return batch.lengths - self.width + 1
        spaces = np.concatenate([[0], np.cumsum(np.frombuffer(batch.data, dtype=np.uint8) == 0x20)])
        ends = np.cumsum(batch.lengths)
        return spaces[ends] - spaces[ends - batch.lengths] - self.width + 1

    def content(self, read, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the unit spans end to end, and their lengths. Words keep one space after each."""
        if self.kind == "bytes":
            return read.data[tk.ranges(starts, ends - starts)], ends - starts
        index = tk.ranges(starts, ends - starts)
        text, bounds = word_bytes(read, index)
        cuts = np.concatenate([[0], np.cumsum(ends - starts)])
        return text, np.diff(bounds[cuts])


def word_bytes(w: tk.Words, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of ``index`` end to end with a space after each, and the bounds of each."""
    lengths = w.ends[index] - w.starts[index]
    bounds = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(int(bounds[-1]), 0x20, dtype=np.uint8)
    inside = np.ones(len(out), dtype=bool)
    inside[bounds[1:] - 1] = False
    out[inside] = w.data[tk.ranges(w.starts[index], lengths)]
    return out, bounds


def _minimisers(units: Units, prefix: np.ndarray, first: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimiser of each window by its start, and whether a window of an active document starts there."""
    seeds = tk.windows_hash(prefix, units.seed)
    least = tk.sliding(seeds, units.width - units.seed + 1, np.minimum)
    ok = tk.inside_windows(first, units.width, active)
    return (least[: len(ok)] | np.uint64(1)) ^ np.uint64(1), ok  # the low bit is left for a flag


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("doc_id", "ascending"), ("text_hash", "ascending")])


def _doc_ids(table: pa.Table) -> np.ndarray:
    return table["doc_id"].fill_null(int(_NO_ID)).to_numpy()


def _first_copies(docs: pa.Table, right: pa.Table) -> np.ndarray:
    """Which rows (in order) stand for their text: the copy of the smallest doc_id."""
    firsts = set(zip(right["first_id"].to_pylist(), right["first_hash"].to_pylist(), strict=True))
    return np.array([x in firsts and x[0] is not None for x in zip(docs["doc_id"].to_pylist(), docs["text_hash"].to_pylist(), strict=True)], dtype=bool)


def _keys(right: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in right["keys"] if b.is_valid]


def _parts(values: np.ndarray, parts: int) -> np.ndarray:
    return ((values >> np.uint64(24)) % np.uint64(parts)).astype(np.int64)


def _split(part: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(part[rows[0]]), rows


def _seeds(units: Units, parts: int):
    def seeds(table: pa.Table, firsts: pa.Table) -> pa.Table:
        empty = pa.table({"part": pa.array([], pa.int64()), "slice": pa.array([], pa.int64()), "keys": pa.array([], pa.binary())})
        if not table.num_rows or not firsts.num_rows:
            return empty
        table = _ordered(table)
        texts, slice_id = tk.as_texts(table["text"]), table["slice"][0]
        ids, active = _doc_ids(table), _first_copies(table, firsts)
        values, docs = [], []
        for lo, hi in tk.slices(texts):
            _, prefix, first = units.read(tk.cut(texts, lo, hi))
            least, ok = _minimisers(units, prefix, first, active[lo:hi])
            new = ok.copy()
            new[1:] &= (least[1:] != least[:-1]) | ~ok[:-1]
            at = np.flatnonzero(new)
            values.append(least[at])
            docs.append(ids[lo + np.searchsorted(first, at, "right") - 1])
        values, docs = np.concatenate(values), np.concatenate(docs)
        order = np.argsort(values, kind="stable")
        values, docs = values[order], docs[order]
        starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else order
        if not len(starts):
            return empty
        many = np.minimum.reduceat(docs, starts) < np.maximum.reduceat(docs, starts)
        values = values[starts] | many.astype(np.uint64)
        part = _parts(values, parts)
        rows = [(p, values[r].tobytes()) for p, r in _split(part, np.argsort(part, kind="stable"))]
        return pa.table({"part": pa.array([p for p, _ in rows], pa.int64()), "slice": pa.array([slice_id.as_py()] * len(rows), pa.int64()),
                         "keys": pa.array([b for _, b in rows], pa.binary())})

    return seeds


def _recurring(table: pa.Table) -> pa.Table:
    """Of each slice's minimisers, those that two documents hold."""
    packed = [np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in table["keys"]]
    values = np.sort(np.concatenate(packed))
    keys = values >> np.uint64(1)
    twice = np.zeros(len(keys), dtype=bool)
    twice[1:] = keys[1:] == keys[:-1]
    wanted = np.unique(keys[twice | ((values & np.uint64(1)) == 1)])
    slices, out = [], []
    for slice_id, own in zip(table["slice"].to_pylist(), packed, strict=True):
        own = own >> np.uint64(1)
        at = np.minimum(np.searchsorted(wanted, own), max(len(wanted) - 1, 0))
        keep = own[wanted[at] == own] if len(wanted) else own[:0]
        if len(keep):
            slices.append(slice_id)
            out.append((keep << np.uint64(1)).tobytes())
    return pa.table({"slice": pa.array(slices, pa.int64()), "keys": pa.array(out, pa.binary())})


@dataclass
class Pieces:
    """Candidate windows of one slice: occurrences by row, and the distinct pieces by shard and first occurrence."""

    rows: np.ndarray  # occurrence -> row of the slice
    starts: np.ndarray  # occurrence -> first window, in units of its document
    counts: np.ndarray  # occurrence -> windows
    piece: np.ndarray  # occurrence -> distinct piece
    shard: np.ndarray  # distinct piece -> shard, ascending
    key: np.ndarray  # distinct piece -> minimiser
    least: np.ndarray  # distinct piece -> least doc_id
    windows: np.ndarray  # distinct piece -> windows
    blobs: list[list[bytes]]  # part of the slice -> shard group -> bytes of its pieces
    lengths: np.ndarray  # distinct piece -> bytes

    def groups(self) -> Iterator[tuple[int, int, int]]:
        """(shard, first piece, last piece + 1)"""
        cuts = [0, *(np.flatnonzero(np.diff(self.shard)) + 1).tolist(), len(self.shard)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield int(self.shard[a]), a, b


def _pieces(units: Units, texts: tk.Texts, ids: np.ndarray, active: np.ndarray, keys: list[np.ndarray], shards: int, with_content: bool) -> Pieces:
    wanted = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    rows, starts, counts, hashes, key, spans, parts = [], [], [], [], [], [], []
    for lo, hi in tk.slices(texts):
        read, prefix, first = units.read(tk.cut(texts, lo, hi))
        least, ok = _minimisers(units, prefix, first, active[lo:hi])
        at = np.minimum(np.searchsorted(wanted, least), max(len(wanted) - 1, 0))
        ok &= (wanted[at] == least) if len(wanted) else False
        edge = np.ones(len(ok) + 1, dtype=bool)
        edge[1:-1] = (ok[1:] != ok[:-1]) | (least[1:] != least[:-1])
        edge[first[first <= len(ok)]] = True
        bounds = np.flatnonzero(edge)
        a, b = bounds[:-1], bounds[1:]
        keep = ok[a] if len(ok) else np.zeros(0, dtype=bool)
        a, b = a[keep], b[keep]
        row = np.searchsorted(first, a, "right") - 1
        rows.append(lo + row)
        starts.append(a - first[row])
        counts.append(b - a)
        ends = b + units.width - 1
        hashes.append(tk.span_hash(prefix, a, ends))
        key.append(least[a])
        spans.append((a, ends))
        parts.append((lo, hi))
    rows, starts, counts, hashes, key = (np.concatenate(x) for x in (rows, starts, counts, hashes, key))
    _, one, piece = np.unique(hashes, return_index=True, return_inverse=True)
    shard = _parts(key[one], shards)
    order = np.lexsort((one, shard))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    one, shard, piece = one[order], shard[order], place[piece]
    least_id = np.full(len(one), _NO_ID)
    np.minimum.at(least_id, piece, ids[rows])
    found = Pieces(rows, starts, counts, piece, shard, key[one], least_id, counts[one], [], np.zeros(len(one), dtype=np.int64))
    if with_content:
        base = np.cumsum([0, *(len(a) for a, _ in spans)])
        part_of = np.searchsorted(base, one, "right") - 1
        group_of = np.cumsum(np.concatenate([[0], np.diff(shard) != 0])) if len(shard) else shard
        n_groups = int(group_of[-1]) + 1 if len(shard) else 0
        for k, ((lo, hi), (a, e)) in enumerate(zip(parts, spans, strict=True)):
            mine = np.flatnonzero(part_of == k)
            read, _, _ = _without_hashes(units, tk.cut(texts, lo, hi))
            local = one[mine] - base[k]
            data, size = units.content(read, a[local], e[local])
            found.lengths[mine] = size
            cuts = np.concatenate([[0], np.cumsum(size)])
            at = cuts[np.searchsorted(group_of[mine], np.arange(n_groups + 1))].tolist()
            raw = data.tobytes()
            found.blobs.append([raw[x:y] for x, y in zip(at[:-1], at[1:], strict=True)])
    return found


def _send(units: Units, shards: int):
    def send(docs: pa.Table, right: pa.Table) -> pa.Table:
        empty = {c.split()[0]: pa.array([], pa.int64() if c.endswith("long") else pa.binary()) for c in _PACK.split(", ")}
        keys = _keys(right)
        if not docs.num_rows or not keys:
            return pa.table(empty)
        docs = _ordered(docs)
        slice_id = docs["slice"][0].as_py()
        p = _pieces(units, tk.as_texts(docs["text"]), _doc_ids(docs), _first_copies(docs, right), keys, shards, True)
        out: list[list] = [[], [], [], [], [], []]
        for group, (shard, a, b) in enumerate(p.groups()):
            packed = (shard, slice_id, b"".join(blob[group] for blob in p.blobs), p.lengths[a:b].astype("<i4").tobytes(),
                      p.least[a:b].tobytes(), np.unique(p.key[a:b]).tobytes())
            for column, value in zip(out, packed, strict=True):
                column.append(value)
        return pa.table({name: pa.array(column, kind.type) for (name, kind), column in zip(empty.items(), out, strict=True)})

    return send


@dataclass
class Batch:
    """The pieces that a slice is the first to send to a shard: their bytes end to end, and the length and least
    doc_id of each."""

    data: bytes
    lengths: np.ndarray
    ids: np.ndarray


def _answer(units: Units, match: Callable[[list[Batch]], np.ndarray]):
    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by("slice")
        known: dict[bytes, int] = {}
        new: list[list[bytes]] = []
        which = []
        for blob, lengths in zip(table["blob"].to_pylist(), table["lengths"].to_pylist(), strict=True):
            cuts = np.concatenate([[0], np.cumsum(np.frombuffer(lengths, dtype="<i4"))]).tolist()
            before = len(known)
            own = [blob[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            which.append(np.array([known.setdefault(x, len(known)) for x in own], dtype=np.int64))
            new.append(own if len(known) - before == len(own) else [own[i] for i in np.unique(which[-1], return_index=True)[1] if which[-1][i] >= before])
        ids = [np.frombuffer(x, dtype=np.int64) for x in table["ids"].to_pylist()]
        least = np.full(len(known), _NO_ID)
        np.minimum.at(least, np.concatenate(which), np.concatenate(ids))
        del known
        batches, at = [], 0
        for own in new:
            if own:
                batches.append(Batch(b"".join(own), np.array([len(x) for x in own], dtype=np.int64), least[at : at + len(own)]))
                at += len(own)
        windows = np.concatenate([units.windows(b) for b in batches])
        first = match(batches)
        bounds = np.concatenate([[0], np.cumsum(windows)])
        bits = []
        for own, mine in zip(which, ids, strict=True):
            at = tk.ranges(bounds[own], windows[own])
            bits.append(np.packbits(first[at] < np.repeat(mine, windows[own])).tobytes())
        return pa.table({"slice": table["slice"], "shard": table["shard"], "keys": table["keys"], "bits": pa.array(bits, pa.binary())})

    return answer


def _back(units: Units, shards: int, finish, schema: pa.Schema):
    def back(docs: pa.Table, right: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        docs = _ordered(docs)
        texts, ids, active = tk.as_texts(docs["text"]), _doc_ids(docs), _first_copies(docs, right)
        copies = ~active & (ids != _NO_ID)
        hit_rows, hit_starts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if keys := _keys(right):
            p = _pieces(units, texts, ids, active, keys, shards, False)
            bits_of = {s: b for s, b in zip(right["shard"].to_pylist(), right["bits"], strict=True) if s is not None}
            # windows of distinct pieces stand end to end in ``hits``
            at = np.concatenate([[0], np.cumsum(p.windows)])
            hits = np.zeros(int(at[-1]), dtype=bool)
            for s, a, b in p.groups():
                bits = np.unpackbits(np.frombuffer(bits_of[s].as_buffer(), dtype=np.uint8))
                hits[at[a] : at[b]] = bits[: at[b] - at[a]].astype(bool)
            owner = np.repeat(np.arange(len(p.rows)), p.counts)
            hit = hits[tk.ranges(at[p.piece], p.counts)] | (ids[p.rows] > p.least[p.piece])[owner]
            hit_rows = p.rows[owner][hit]
            hit_starts = tk.ranges(p.starts, p.counts)[hit]
        out = []
        for lo, hi in tk.slices(texts):
            a, b = np.searchsorted(hit_rows, [lo, hi])
            read, _, first = _without_hashes(units, tk.cut(texts, lo, hi))
            removed = tk.covered(first[hit_rows[a:b] - lo] + hit_starts[a:b], units.width, int(first[-1]))
            n = np.diff(first)
            removed |= np.repeat(copies[lo:hi] & (n >= units.width), n)
            out.append(pa.table([docs["doc_id"].slice(lo, hi - lo), *finish(read, first, removed)], schema=schema))
        return pa.concat_tables(out)

    return back


def _without_hashes(units: Units, texts: tk.Texts):
    if units.kind == "words":
        w = tk.words(texts, tk.NOT_SPACE)
        return w, None, w.first
    return texts, None, texts.offsets


def find(docs: DataFrame, units: Units, match, finish, columns: list[tuple[str, pa.DataType]], ddl: str,
         slice_text: int = SLICE_TEXT, shard_text: int = SHARD_TEXT) -> DataFrame:
    """``match(batches)`` gives the smallest doc_id of every window of the batches' pieces, end to end.
    ``finish(read, first, removed)`` gives the result columns after doc_id for some documents, from the units, their
    document bounds and which units a hit window covers."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(shuffle_partitions(spark), ratio(total, slice_text))
    parts = max(shuffle_partitions(spark), ratio(total, shard_text))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    plain = plain.withColumn("text_hash", F.xxhash64("text")).withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(slices)))
    firsts = plain.groupBy("text_hash", F.hash("text").alias("_h"), F.octet_length("text").alias("_n")).agg(F.min("doc_id").alias("first_id"))
    firsts = firsts.filter("first_id IS NOT NULL").select(
        F.pmod(F.xxhash64("first_id"), F.lit(slices)).alias("slice"), "first_id", F.col("text_hash").alias("first_hash"))
    own = plain.groupBy("slice")

    def beside_firsts(rows: DataFrame):
        return rows.unionByName(firsts, allowMissingColumns=True).groupBy("slice")

    seeds = own.cogroup(firsts.groupBy("slice")).applyInArrow(_seeds(units, parts), "part long, slice long, keys binary")
    known = seeds.groupBy("part").applyInArrow(_recurring, "slice long, keys binary")
    sent = own.cogroup(beside_firsts(known)).applyInArrow(_send(units, parts), _PACK)
    answers = sent.groupBy("shard").applyInArrow(_answer(units, match), "slice long, shard long, keys binary, bits binary")
    schema = pa.schema([("doc_id", pa.int64()), *columns])
    return own.cogroup(beside_firsts(answers)).applyInArrow(_back(units, parts, finish, schema), f"doc_id long, {ddl}")
