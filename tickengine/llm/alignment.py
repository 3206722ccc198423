"""Cross-tokenizer alignment: where two tokenizers cut the same bytes.

A text is encoded twice: by a byte-level vocabulary (A) and by a piece vocabulary with byte fallback (B, which puts a
space before the text, so A is given one too). The cumulative byte ends of each side are the keys of a dictionary from
end to index; the ends that both sides have (a hash-set intersection), sorted, slice the two id lists into groups, and
the links of a group (pairs of tokens whose bytes overlap) are expanded from its slice. :func:`align` does
so text by text; :func:`align_slice` takes the same from sorted arrays over all texts of a slice.

Links are counted over the whole corpus per pair of ids. A slice of documents (a few MB) holds each of its pairs once,
with the slice's count; Spark sums the counts by pair, marks the pairs that are the best of their B id, joins totals
back to the slices' pairs and cogroups them with the slices. A pair that stands everywhere arrives once a slice, not
once a link, and a slice's group holds no more than its own pairs, so there is no hot group.

Defined cases: a text that is null, empty or whose bytes the tokenizers do not give back (B may normalise) has no tokens,
no groups and no links; special tokens' strings in a text are plain text; repeated rows are repeated in the result (and
counted each); a null doc_id is kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickengine.llm import textkit as tk
from tickengine.llm.common import documents
from tickengine.session import materialize, ship

SLICE_BYTES = 1 << 20
STRETCH_BYTES = 1 << 17  # lists of ids and texts of groups are held for this much of a slice at once
GROUP_BYTES = 4 << 20  # a row group of the written slices: readers decode all rows of one at once, up to thousands
BYTE_VOCABULARY = "byte_bpe_50k"
PIECE_VOCABULARY = "piece_bpe_32k"
_SLICES = ("slice long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
           "groups_sha256 array<string>, pair array<long>, n array<long>, link array<int>")
_FIGURES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
GROUPS = "doc_id long, n_a long, n_b long, groups array<struct<a:array<int>,b:array<int>>>"
_GROUPS_TYPE = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

Encoder = Callable[[list[str]], list[list[int]]]


@dataclass
class Side:
    """One tokenizer: the ids of each of some texts, and the bytes of every id."""

    encode: Encoder
    pieces: list[bytes]
    lengths: list[int] = field(init=False)
    labels: list[str] = field(init=False, default_factory=list)
    widths: np.ndarray = field(init=False, default=None)

    def __post_init__(self):
        self.lengths = [len(p) for p in self.pieces]


_sides: dict = {}


def _byte_side(path: Callable[[str], str]) -> Side:
    """The rank file of the byte-level vocabulary, which has no special tokens; texts that its pattern engine gives up
    on take the json tokenizer (of the same ids), with special strings as plain text."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path(f"{BYTE_VOCABULARY}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(BYTE_VOCABULARY, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    plain: list = []

    def one(text: str) -> list[int]:
        try:
            return fast.encode_ordinary(text)
        except ValueError:
            if not plain:
                from tokenizers import Tokenizer

                plain.append(Tokenizer.from_file(path(f"{BYTE_VOCABULARY}.json")))
                plain[0].encode_special_tokens = True
            return plain[0].encode(text, add_special_tokens=False).ids

    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, number in ranks.items():
        pieces[number] = piece
    return Side(lambda texts: [one(t) for t in texts], pieces)


def _piece_side(path: Callable[[str], str]) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path(f"{PIECE_VOCABULARY}.model"))
    pieces = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        pieces.append(bytes([int(piece[3:-1], 16)]) if model.is_byte(number) else piece.replace("▁", " ").encode())
    return Side(lambda texts: model.encode(texts, num_threads=1), pieces)


def sides(folder: str | None = None) -> tuple[Side, Side]:
    """Both tokenizers, loaded once a process; ``folder`` holds the vocabulary files (default: the installed ones)."""
    if folder not in _sides:
        import os

        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = (lambda name: f"{folder}/{name}") if folder else public_tokenizers.path
        _sides[folder] = _byte_side(path), _piece_side(path)
    return _sides[folder]


def encoded(texts: list[str | None], a: Side, b: Side) -> Iterator[tuple[list[int], list[int]]]:
    """The ids of both sides for every text, or none where a side does not give the text's bytes back."""
    texts = [t or "" for t in texts]
    spaced = [" " + t for t in texts]
    for text, ids_a, ids_b in zip(spaced, a.encode(spaced), b.encode(texts), strict=True):
        raw = text.encode()
        same = len(raw) > 1 and all(b"".join(map(side.pieces.__getitem__, ids)) == raw for side, ids in ((a, ids_a), (b, ids_b)))
        yield (ids_a, ids_b) if same else ([], [])


def group_ends(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """Where the groups end in both token lists: the common ends, in order, looked up in both sides' dictionaries."""
    index_a = dict(zip(ends_a, range(1, len(ends_a) + 1), strict=True))
    index_b = dict(zip(ends_b, range(1, len(ends_b) + 1), strict=True))
    common = sorted(index_a.keys() & index_b.keys())
    return [index_a[end] for end in common], [index_b[end] for end in common]


def cumulative(ids: list[int], side: Side) -> list[int]:
    return list(accumulate(map(side.lengths.__getitem__, ids)))


def align(ids_a: list[int], ids_b: list[int], a: Side, b: Side) -> tuple[list[str], list[int], list[int]]:
    """A text's groups, as ``a1,a2|b1``, and the A ids and B ids of its links."""
    ends_a, ends_b = cumulative(ids_a, a), cumulative(ids_b, b)
    names_a, names_b = list(map(str, ids_a)), list(map(str, ids_b))
    groups, links_a, links_b = [], [], []
    i = j = 0
    for to_i, to_j in zip(*group_ends(ends_a, ends_b), strict=True):
        if to_i == i + 1 and to_j == j + 1:
            groups.append(f"{names_a[i]}|{names_b[j]}")
            links_a.append(ids_a[i])
            links_b.append(ids_b[j])
        else:
            groups.append(f"{','.join(names_a[i:to_i])}|{','.join(names_b[j:to_j])}")
            if to_j == j + 1:  # one token overlaps all of the other side's
                links_a += ids_a[i:to_i]
                links_b += ids_b[j:to_j] * (to_i - i)
            elif to_i == i + 1:
                links_a += ids_a[i:to_i] * (to_j - j)
                links_b += ids_b[j:to_j]
            else:
                x, y = i, j
                while x < to_i and y < to_j:
                    links_a.append(ids_a[x])
                    links_b.append(ids_b[y])
                    end_a, end_b = ends_a[x], ends_b[y]
                    x += end_a <= end_b
                    y += end_b <= end_a
        i, j = to_i, to_j
    return groups, links_a, links_b


def _labels(side: Side, last: str) -> list[str]:
    """Each id's text as it stands in a group (at 2 id) and at the end of its side of the group (at 2 id + 1)."""
    return [text for i in range(len(side.pieces)) for text in (f"{i},", f"{i}{last}")]


def align_slice(rows: list[tuple[list[int], list[int]]], a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]:
    """:func:`align` for many texts at once: the number of groups and of links of each, its groups' texts, and the A ids
    and B ids of all links. Texts lie end to end, and the end of a text is an end of both sides. The tokens that overlap
    are those around each stretch between neighbouring ends of either side, so links are read off the merged ends."""
    if not a.labels:
        a.labels, b.labels = _labels(a, "|"), _labels(b, ";")
        a.widths, b.widths = np.array(a.lengths, dtype=np.int64), np.array(b.lengths, dtype=np.int64)
    first_a, first_b = (np.cumsum([0, *(len(row[k]) for row in rows)]) for k in (0, 1))
    ids_a, ids_b = (np.fromiter(chain.from_iterable(row[k] for row in rows), np.int64, int(n[-1])) for k, n in ((0, first_a), (1, first_b)))
    ends_a, ends_b = np.cumsum(a.widths[ids_a]), np.cumsum(b.widths[ids_b])
    close_a, close_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
    to_a, to_b = np.flatnonzero(close_a) + 1, np.flatnonzero(close_b) + 1  # where the groups end
    ends = np.union1d(ends_a, ends_b)
    links_a, links_b = ids_a[np.searchsorted(ends_a, ends)], ids_b[np.searchsorted(ends_b, ends)]
    bounds = np.concatenate([[0], ends_a])[first_a]
    n_links = np.diff(np.searchsorted(ends, bounds, "right"))
    n_groups = np.diff(np.searchsorted(to_a, first_a, "right"))
    # a group's A tokens stand behind the B tokens of the groups before it, its B tokens behind its A tokens
    of_a, of_b = np.cumsum(close_a) - close_a, np.cumsum(close_b) - close_b
    text = np.empty(len(ids_a) + len(ids_b), dtype=object)
    text[np.arange(len(ids_a)) + np.concatenate([[0], to_b])[of_a]] = list(map(a.labels.__getitem__, (2 * ids_a + close_a).tolist()))
    text[np.arange(len(ids_b)) + to_a[of_b]] = list(map(b.labels.__getitem__, (2 * ids_b + close_b).tolist()))
    cuts = (first_a + first_b).tolist()
    return n_groups, n_links, ["".join(text[lo:hi].tolist())[:-1] for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)], links_a, links_b


def token_groups(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b and the groups (ids of A and of B) of every document. Narrow: no shuffle."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(folder)
        for batch in batches:
            texts = batch["text"]
            for lo, hi in tk.slices(tk.as_texts(texts), SLICE_BYTES):
                n_a, n_b, rows = [], [], []
                for ids_a, ids_b in encoded(texts.slice(lo, hi - lo).to_pylist(), a, b):
                    to_a, to_b = group_ends(cumulative(ids_a, a), cumulative(ids_b, b))
                    cuts = zip([0, *to_a[:-1]], to_a, [0, *to_b[:-1]], to_b, strict=True) if to_a else ()
                    rows.append([{"a": ids_a[i:k], "b": ids_b[j:m]} for i, k, j, m in cuts])
                    n_a.append(len(ids_a))
                    n_b.append(len(ids_b))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(rows, _GROUPS_TYPE)],
                    names=["doc_id", "n_a", "n_b", "groups"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, GROUPS)


def _one_row(values: dict[str, tuple[list | np.ndarray, pa.DataType]], number: int) -> pa.RecordBatch:
    """A batch of one row that holds each column's values as a list."""
    columns = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, kind)) for v, kind in values.values()]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *columns], names=["slice", *values])


def slice_links(texts: pa.Array, a: Side, b: Side, stretch_bytes: int = STRETCH_BYTES) -> tuple[dict[str, np.ndarray], list[str], np.ndarray]:
    """The figures of every text of a slice, the digests of their groups, and the pairs of all links (A id << 32 | B id).
    Texts are encoded and aligned by stretches, of which only numbers and digests stay."""
    figures, digests, links = {c: [] for c in ("n_a", "n_b", "n_groups", "n_links")}, [], []
    for lo, hi in tk.slices(tk.as_texts(texts), stretch_bytes):
        rows = list(encoded(texts.slice(lo, hi - lo).to_pylist(), a, b))
        n_groups, n_links, groups, links_a, links_b = align_slice(rows, a, b)
        for c, n in (("n_a", [len(row[0]) for row in rows]), ("n_b", [len(row[1]) for row in rows]), ("n_groups", n_groups), ("n_links", n_links)):
            figures[c].append(np.asarray(n, np.int64))
        digests += [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
        links.append(links_a << 32 | links_b)
    return {c: np.concatenate(n) for c, n in figures.items()}, digests, np.concatenate(links)


def aligned_slices(docs: DataFrame, folder: str | None = None, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per slice of documents: lists of the documents' figures, the distinct pairs of the slice with their
    counts, and for every link, document after document, the place of its pair. To be written once: the slices' numbers
    are those of the tasks that made them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(folder)
        gc.disable()  # lists of numbers hold no cycles, and there are many of them; the worker is the task's own
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch["text"]
            for lo, hi in list(tk.slices(tk.as_texts(texts), slice_bytes)):  # a list: the copy of the texts goes
                figures, digests, links = slice_links(texts.slice(lo, hi - lo), a, b)
                pair, link, n = np.unique(links, return_inverse=True, return_counts=True)
                long = pa.int64()
                yield _one_row({
                    "doc_id": (batch["doc_id"].slice(lo, hi - lo), long), **{c: (v, long) for c, v in figures.items()},
                    "groups_sha256": (digests, pa.string()), "pair": (pair, long), "n": (n, long),
                    "link": (link.astype(np.int32), pa.int32())}, number)
                number += 1
        gc.enable()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, _SLICES)


def _slice_pairs(slices: DataFrame) -> DataFrame:
    return slices.select("slice", F.posexplode(F.arrays_zip("pair", "n")).alias("k", "z")).select("slice", "k", "z.pair", "z.n")


def pair_counts(slices: DataFrame) -> DataFrame:
    """pair (A id << 32 | B id), total (its links in the corpus) and best (no pair of its B id has more)."""
    totals = _slice_pairs(slices).groupBy("pair").agg(F.sum("n").alias("total"))
    # a B id has at most as many pairs as A has ids
    most = F.max("total").over(Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF)))
    return totals.select("pair", "total", (F.col("total") == most).alias("best"))


def _judged(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of one slice with the totals of their links."""
    row = {c: left[c].chunk(0).flatten() if left[c].num_chunks else None for c in left.column_names if c != "slice"}
    total, best = np.zeros(len(row["pair"]), np.int64), np.zeros(len(row["pair"]), np.int64)
    at = right["k"].to_numpy()
    total[at], best[at] = right["total"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
    link = row["link"].to_numpy()
    ends = np.cumsum(row["n_links"].to_numpy())
    sums = {}
    for name, values in (("n_best", best), ("count_sum", total)):
        upto = np.concatenate([[0], np.cumsum(values[link])])
        sums[name] = pa.array(np.diff(upto[np.concatenate([[0], ends])]))
    columns = {c: row[c] for c in _FIGURES[:-1]} | sums | {"groups_sha256": row["groups_sha256"]}
    return pa.table(columns)


def alignment(docs: DataFrame, folder: str | None = None, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links that are the best of their B id in the corpus),
    count_sum (corpus counts over its links) and groups_sha256."""
    # a slice's row is a few MB, so the writer looks at the sizes of its pages and row groups after every row
    every = dict.fromkeys(("parquet.page.size.row.check.min", "parquet.page.size.row.check.max"), "1")
    slices = materialize(aligned_slices(docs, folder, slice_bytes), **every, **{"parquet.block.size": str(GROUP_BYTES)})
    totals = pair_counts(slices)
    back = _slice_pairs(slices).drop("n").join(totals, "pair").select(F.col("slice").alias("of"), "k", "total", "best")
    return slices.drop("n").groupBy("slice").cogroup(back.groupBy("of")).applyInArrow(_judged, ALIGNED)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return alignment(documents(spark, sf_dir))
