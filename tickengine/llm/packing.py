"""Packing: first-fit decreasing over randomised groups of pieces, with a tournament tree of bin capacities.

A document's ids are cut every ``length`` ids, so each piece fits a sequence and its checksum is known before it is
placed. Pieces are dealt into groups by a hash of document and start; every group is packed on its own, whole pieces
first (one sequence each), the rest by first-fit decreasing: the leftmost bin with room is found by one walk down a
tree whose nodes hold the largest capacity below them, so a piece costs O(log bins).

Defined cases: a null or empty text is one piece that holds only the end id; repeated rows are packed once each;
a null doc_id is kept as it is; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickengine.llm.common import documents, ratio
from tickengine.session import materialize, ship

LENGTH = 2048
END_ID = 1
GROUP_PIECES = 1 << 15
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"
# the one special string of this vocabulary, which the json tokenizer maps to an id of its own
SPECIAL = "<|endoftext|>"

_loaded: dict = {}


def _encoder(name: str, folder: str | None):
    """Text -> ids of the vocabulary, as numpy. The rank file gives the same ids as the json file, several times
    faster; the json tokenizer takes the texts with a special string and those that the other cannot do."""
    if (name, folder) not in _loaded:
        import base64
        import os

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = (lambda f: f"{folder}/{f}") if folder else public_tokenizers.path
        with open(path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        plain: list = []

        def encode(text: str) -> np.ndarray:
            if SPECIAL not in text:
                try:
                    return np.asarray(fast.encode_to_numpy(text), dtype=np.uint32)
                except ValueError:  # the pattern engine gives up on extreme runs of one class
                    pass
            if not plain:
                plain.append(Tokenizer.from_file(path(f"{name}.json")))
            return np.asarray(plain[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)

        _loaded[name, folder] = encode
    return _loaded[name, folder]


def token_pieces(docs: DataFrame, length: int = LENGTH, tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """Pieces of at most ``length`` ids of every document (its ids, then ``END_ID``). Narrow: no shuffle."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer, folder)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(ids), length):
                    part = ids[start : start + length]
                    for column, value in zip(rows, (doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in rows], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces, PIECES)


def first_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each size, in the order given (decreasing for first-fit decreasing)."""
    n = len(sizes)
    leaves = 1 << max(0, (n - 1).bit_length())
    tree = [capacity] * (2 * leaves)  # node k has children 2k and 2k + 1; leaves are bins
    bins, offsets = [0] * n, [0] * n
    for i, size in enumerate(sizes):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def pack(pieces: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Places every piece. ``pieces`` is counted, so it should be a written table. ``sequence_id`` holds the group
    above bit 32 and the bin below it."""
    groups = ratio(pieces.count(), group_pieces)

    def packed(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        sizes = pdf["length"].to_numpy()
        whole = int((sizes == length).sum())
        bins, offsets = first_fit(sizes[whole:].tolist(), length)
        bin_ids = np.concatenate([np.arange(whole), np.asarray(bins, dtype=np.int64) + whole])
        pdf["sequence_id"] = (np.int64(key[0]) << 32) + bin_ids
        pdf["offset"] = np.concatenate([np.zeros(whole, np.int64), np.asarray(offsets, dtype=np.int64)])
        pdf["doc_id"] = pdf["doc_id"].astype("Int64")
        return pdf.drop(columns="_group")

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(packed, PACKED)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return pack(materialize(token_pieces(documents(spark, sf_dir))))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: sequences over the documents that are left."""
    ship(spark)
    return pack(materialize(token_pieces(docs)))
