"""Repeated passages (words) and repeated bytes against plain Python, and against their SQL."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import SCHEMA, duck, plain, rows
from tickengine.llm import suffixlevels
from tickengine.llm import textkit as tk
from tickengine.llm.passages import OP1_SQL, remove_repeated_passages
from tickengine.llm.recurring import Batch
from tickengine.llm.suffixlevels import OP4_SQL, _byte_order, _levels, remove_repeated_bytes


def brute(units_of, width: int, data) -> list[tuple[int, list, list[bool]]]:
    first: dict = {}
    split = [(d, units_of(t)) for d, t in data]
    for d, u in split:
        for i in range(len(u) - width + 1):
            if d is not None:
                key = tuple(u[i : i + width])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, u in split:
        gone = [False] * len(u)
        for i in range(len(u) - width + 1):
            if d is not None and first[tuple(u[i : i + width])] < d:
                gone[i : i + width] = [True] * width
        out.append((d, u, gone))
    return out


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_words(data, width):
    out = []
    for d, u, gone in brute(words, width, data):
        kept = " ".join(w for w, g in zip(u, gone, strict=True) if not g)
        out.append((d, hashlib.sha256(kept.encode()).hexdigest(), sum(gone), len(u)))
    return sorted(out, key=repr)


def brute_bytes(data, width):
    out = []
    for d, u, gone in brute(lambda t: list((t or "").encode()), width, data):
        kept = bytes(b for b, g in zip(u, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, hashlib.sha256(kept).hexdigest(), len(u), sum(gone), spans))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [{}, {"slice_text": 500, "shard_text": 200}])
def test_passages(docs, sizes):
    assert plain(remove_repeated_passages(docs, **sizes)) == brute_words([r[:2] for r in rows()], 13)


@pytest.mark.parametrize("sizes", [{}, {"slice_text": 500, "shard_text": 200, "batch_windows": 16}])
def test_bytes(docs, sizes):
    assert plain(remove_repeated_bytes(docs, **sizes)) == brute_bytes([r[:2] for r in rows()], 50)


def test_texts_are_returned(spark, docs):
    data = [(1, "a b c d e f"), (2, "x a b c d e f y"), (3, "a b c d z")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in remove_repeated_passages(df, 4, 2, with_text=True).collect()}
    assert got == {1: "a b c d e f", 2: "x y", 3: "z"}
    got = {r.doc_id: bytes(r.kept_bytes) for r in remove_repeated_bytes(df, 5, 3, with_text=True).collect()}
    assert got == {1: b"a b c d e f", 2: b"x  y", 3: b"z"}


def test_one_value_over_and_over(spark, docs):
    data = [(1, "a " * 300), (2, "a " * 200), (3, "b" * 400), (4, "b" * 300), (5, None)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert plain(remove_repeated_passages(df)) == brute_words(data, 13)
    assert plain(remove_repeated_bytes(df)) == brute_bytes(data, 50)


def test_empty_table(no_docs):
    assert plain(remove_repeated_passages(no_docs)) == plain(remove_repeated_bytes(no_docs)) == []


def test_sql_agrees(spark):
    data = [{"doc_id": r[0], "text": r[1]} for r in rows()]
    assert duck(OP1_SQL, documents=data) == brute_words([r[:2] for r in rows()], 13)
    assert duck(OP4_SQL, documents=data) == brute_bytes([r[:2] for r in rows()], 50)


def eight_bytes(data: np.ndarray) -> np.ndarray:
    eight = np.zeros(len(data), dtype=np.uint64)
    for k in range(8):
        eight[: len(data) - k] |= data[k:].astype(np.uint64) << np.uint64(56 - 8 * k)
    return eight


@pytest.mark.parametrize("width", [3, 8, 13, 20, 50])
def test_windows_are_sorted_and_merged_by_their_bytes(width):
    rng = np.random.default_rng(7)
    text = b"abracadabra abracadabra! abracadabrac" * 5 + bytes(60) + bytes(rng.integers(0, 2, 300).tolist())
    data = np.frombuffer(text, dtype=np.uint8)
    eight = eight_bytes(data)
    window = [text[i : i + width] for i in range(len(text) - width)]
    starts = rng.permutation(len(window))

    def check(starts, order, new):
        got = [window[s] for s in starts[order]]
        assert got == sorted(window[s] for s in starts)
        assert new.tolist() == [not i or got[i - 1] != got[i] for i in range(len(got))]

    check(starts, *_byte_order(eight, starts, width))
    halves = [h[_byte_order(eight, h, width)[0]] for h in (starts[:150], starts[150:])]
    both = np.concatenate(halves)
    check(both, *_byte_order(eight, both, width, 150))


def pieces(n_batches: int, seed: int) -> list[Batch]:
    """Batches of pieces that share stretches of a common text."""
    rng = np.random.default_rng(seed)
    common = bytes(rng.integers(97, 123, 400, dtype=np.uint8))
    out = []
    for _ in range(n_batches):
        own = []
        for _ in range(rng.integers(1, 6)):
            a = int(rng.integers(0, 300))
            own.append(bytes(rng.integers(97, 123, 10, dtype=np.uint8)) + common[a : a + int(rng.integers(60, 100))])
        out.append(Batch(b"".join(own), np.array([len(x) for x in own]), rng.integers(0, 1000, len(own))))
    return out


def least_ids(batches: list[Batch], width: int) -> list[int]:
    windows = []
    for batch in batches:
        ends = np.cumsum(batch.lengths)
        for end, n, i in zip(ends, batch.lengths, batch.ids, strict=True):
            windows += [(batch.data[k : k + width], i) for k in range(end - n, end - width + 1)]
    least: dict[bytes, int] = {}
    for w, i in windows:
        least[w] = min(least.get(w, i), i)
    return [least[w] for w, _ in windows]


@pytest.mark.parametrize("n_batches", [1, 2, 7, 13])
def test_levels_give_the_least_id_of_each_window(n_batches):
    for seed in range(5):
        batches = pieces(n_batches, seed)
        assert _levels(50, 64)(batches).tolist() == least_ids(batches, 50)


def test_matches_come_from_the_byte_order(monkeypatch):
    """With the order shuffled, equal windows are no neighbours and are not matched."""
    def shuffled(eight, starts, width, cut=0):
        order, _ = _byte_order(eight, starts, width, cut)
        order = np.random.default_rng(1).permutation(order)
        at = [eight[starts[order] + k] for k in (*range(0, width - 8, 8), width - 8)]
        new = np.ones(len(order), dtype=bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in at], axis=0)
        return order, new

    batches = pieces(7, 0)
    monkeypatch.setattr(suffixlevels, "_byte_order", shuffled)
    assert _levels(50, 64)(batches).tolist() != least_ids(batches, 50)


def test_word_and_window_hashes():
    texts = tk.as_texts(pa.array(["a  bb a", None, "", "bb\ta bb"]))
    w = tk.words(texts, tk.NOT_SPACE)
    assert w.first.tolist() == [0, 3, 3, 3, 6]
    h = w.hashes()
    assert h[0] == h[2] == h[4] and h[1] == h[3] == h[5] and h[0] != h[1]
    pairs = tk.windows_hash(tk.rolling(h), 2)
    assert pairs[0] == pairs[4] and pairs[1] == pairs[3] and pairs[0] != pairs[1]
    assert tk.inside_windows(w.first, 2).tolist() == [True, True, False, True, True]


def test_rows_schema():
    assert len(SCHEMA.split(", ")) == len(rows()[0])
