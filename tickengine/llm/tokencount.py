"""Token counts: greedy longest-match word pieces by a linear automaton.

A vocabulary trie gets failure links and, with each link, the number of pieces popped on the way: reading a word is
then one walk over its bytes, and the count of its pieces is a sum of popped counts. No piece is ever built. The
pieces are the byte strings of a public vocabulary; a word is read with one space before it, so that pieces which
start with a space are word-initial and the others continue a word. Every single byte must be a piece, so every word
has pieces.

Words are `[^\\x20\\x09-\\x0D]+`. Distinct words of a slice (told apart by their bytes) are read together, one byte position at a time
in numpy; words of more than ``LONG`` bytes are read alone.

Defined cases: a null or empty text has no words and no pieces; repeated rows are repeated in the result; a null
doc_id is kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickengine.llm import textkit as tk
from tickengine.llm.common import documents
from tickengine.session import ship

LONG = 128
ROOT = 0


class PieceCounter:
    def __init__(self, pieces: list[bytes]):
        goto: dict[int, int] = {}  # (node << 8 | byte) -> node
        final = bytearray(1)
        order: list[tuple[int, int, int]] = []  # (depth, node << 8 | byte, child)
        for piece in pieces:
            node = ROOT
            for depth, byte in enumerate(piece):
                key = node << 8 | byte
                child = goto.get(key)
                if child is None:
                    child = goto[key] = len(final)
                    final.append(0)
                    order.append((depth, key, child))
                node = child
            if node:
                final[node] = 1
        if any(b not in goto or not final[goto[b]] for b in range(256)):
            raise ValueError("every single byte must be a piece")
        order.sort()
        link, popped = [ROOT] * len(final), [0] * len(final)
        for _, key, child in order:
            parent, byte = key >> 8, key & 255
            if final[child]:
                popped[child] = 1  # the piece itself; what follows starts at the root
                continue
            node, count = link[parent], popped[parent]
            while (node << 8 | byte) not in goto:
                count += popped[node]
                node = link[node]
            link[child], popped[child] = goto[node << 8 | byte], count
        self.goto, self.link, self.popped = goto, link, popped
        keys = np.fromiter(goto, dtype=np.int64, count=len(goto))
        targets = np.fromiter(goto.values(), dtype=np.int64, count=len(goto))
        by_key = np.argsort(keys)
        self.keys, self.targets = keys[by_key], targets[by_key]
        self.links, self.pops = np.asarray(link), np.asarray(popped)

    def count(self, word: bytes) -> int:
        """Pieces of one word (with its leading space)."""
        node = total = 0
        for byte in word:
            while (node << 8 | byte) not in self.goto:
                total += self.popped[node]
                node = self.link[node]
            node = self.goto[node << 8 | byte]
        while node != ROOT:
            total += self.popped[node]
            node = self.link[node]
        return total

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word data[start:end], read with one space before it."""
        total = np.zeros(len(starts), dtype=np.int64)
        long = np.flatnonzero(ends - starts > LONG)
        for i in long.tolist():
            total[i] = self.count(b" " + data[starts[i] : ends[i]].tobytes())
        left = np.flatnonzero(ends - starts <= LONG)
        node = np.full(len(left), self.goto[0x20], dtype=np.int64)
        at = starts[left]
        while len(left):
            going = at < ends[left]
            if not going.all():
                self._finish(total, left[~going], node[~going])
                left, node, at = left[going], node[going], at[going]
                continue
            node = self._step(total, left, node, data[at].astype(np.int64))
            at = at + 1
        return total

    def _step(self, total, left, node, byte) -> np.ndarray:
        out, open_ = node.copy(), np.arange(len(node))
        while len(open_):
            key = out[open_] << 8 | byte[open_]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[place] == key
            out[open_[there]] = self.targets[place[there]]
            open_ = open_[~there]
            total[left[open_]] += self.pops[out[open_]]
            out[open_] = self.links[out[open_]]
        return out

    def _finish(self, total, left, node) -> None:
        while len(left):
            total[left] += self.pops[node]
            node = self.links[node]
            left, node = left[node != ROOT], node[node != ROOT]


_counters: dict = {}


def _counter(name: str, folder: str | None) -> PieceCounter:
    if (name, folder) not in _counters:
        import base64

        import public_tokenizers

        with open(f"{folder}/{name}" if folder else public_tokenizers.path(name), "rb") as f:
            _counters[name, folder] = PieceCounter([base64.b64decode(line.split()[0]) for line in f])
    return _counters[name, folder]


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens and max_word_tokens (null without words) of every document. Narrow: no shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary, folder)
        for batch in batches:
            texts = tk.as_texts(batch["text"])
            for lo, hi in tk.slices(texts):
                numbers: dict[bytes, int] = {}
                codes, first = [], [0]
                for d in range(lo, hi):
                    words = texts.data[texts.offsets[d] : texts.offsets[d + 1]].tobytes().split()
                    codes.extend([numbers.setdefault(w, len(numbers)) for w in words])
                    first.append(len(codes))
                ends = np.cumsum(np.fromiter(map(len, numbers), np.int64, len(numbers)))
                starts = np.concatenate([[0], ends])[:-1]
                each = counter.counts(np.frombuffer(b"".join(numbers), np.uint8), starts, ends)[np.array(codes, dtype=np.int64)]
                first = np.array(first, dtype=np.int64)
                n = np.diff(first)
                sums = np.concatenate([[0], np.cumsum(each)])
                most = np.maximum.reduceat(each, first[:-1][n > 0]) if len(each) else each
                peak = np.zeros(len(n), dtype=np.int64)
                peak[n > 0] = most
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo), pa.array(n.astype(np.int64)),
                     pa.array(sums[first[1:]] - sums[first[:-1]]), pa.array(peak, mask=n == 0)],
                    names=["doc_id", "n_words", "n_tokens", "max_word_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        count, "doc_id long, n_words long, n_tokens long, max_word_tokens long")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return token_counts(documents(spark, sf_dir))
