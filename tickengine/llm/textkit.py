"""Array views of a batch of texts: word bounds and rolling hashes, computed over the batch's UTF-8 buffer at once.

Word separators of both word rules are ASCII, so byte classes decide them and no text is decoded. A batch is cut
into slices of a few MB (at document bounds, one document at least), which bounds the arrays built from it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_U = np.uint64


def _byte_class(keep) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for b in range(256):
        table[b] = keep(b)
    return table


# [^\x20\x09-\x0D]+
NOT_SPACE = _byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z is lower-cased: digits, a-z and every non-ASCII byte
LETTERS_DIGITS = _byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word (in place)."""
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
# two polynomials modulo the prime 2^31 - 1: unlike one modulo 2^64, they tell texts of a doubling structure apart
_PRIME = (1 << 31) - 1
_P, _SHIFT = _U(_PRIME), _U(31)
_BASES = (0x2E6B1F4D, 0x517CC1B7)
_powers = [np.ones(1, dtype=np.uint64) for _ in range(4)]  # of the bases, then of their inverses


_CHUNK = 1 << 14  # values at a time, so that the passes below stay in the cache


def _fold(x: np.ndarray, spare: np.ndarray) -> None:
    """One step of x modulo 2^31 - 1 (in place): from below 2^62 to below 2^32, from there to 2^31 at most."""
    np.right_shift(x, _SHIFT, out=spare)
    np.bitwise_and(x, _P, out=x)
    np.add(x, spare, out=x)


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo 2^31 - 1 (in place)."""
    spare = np.empty_like(x)
    _fold(x, spare)
    _fold(x, spare)
    x[x >= _P] -= _P
    return x


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((*_BASES, *(pow(b, -1, _PRIME) for b in _BASES))):
            p = _powers[k]
            while len(p) < n:  # twice as many: the second half is the first times base^len
                p = np.concatenate([p, _reduced(p * _U(pow(base, len(p), _PRIME)))])
            _powers[k] = p
    return _powers


def rolling(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * base^i, one row for each base (of the low and the next 31 bits of the values);
    :func:`span_hash` takes the hash of any span from them."""
    n = len(values)
    up = _power_tables(n + 1)
    out = np.zeros((2, n + 1), dtype=np.uint64)
    spare = np.empty(min(n, _CHUNK), dtype=np.uint64)
    for lo in range(0, n, _CHUNK):
        hi = min(lo + _CHUNK, n)
        room = spare[: hi - lo]
        for k in range(2):
            own = out[k, lo + 1 : hi + 1]
            if k:
                np.right_shift(values[lo:hi], _SHIFT, out=own)
                np.bitwise_and(own, _P, out=own)
            else:
                np.bitwise_and(values[lo:hi], _P, out=own)
            np.multiply(own, up[k][lo:hi], out=own)
            _fold(own, room)
            np.cumsum(own, out=own)
            np.add(own, out[k, lo], out=own)
            _fold(own, room)
            _fold(own, room)
    return out


def _joined(prefix: np.ndarray, n: int, starts, ends) -> np.ndarray:
    """Hashes of ``n`` spans; ``starts`` and ``ends`` give the k-th to the l-th as something to index with."""
    down = _power_tables(prefix.shape[1])[2:]
    out = np.empty(n, dtype=np.uint64)
    for lo in range(0, n, _CHUNK):
        hi = min(lo + _CHUNK, n)
        a, b = starts(lo, hi), ends(lo, hi)
        lanes = []
        for k in range(2):
            own = prefix[k][b] + _U(2 * _PRIME)
            own -= prefix[k][a]
            _fold(own, spare := np.empty_like(own))
            own *= down[k][a]
            _fold(own, spare)
            _fold(own, spare)
            own[own >= _P] -= _P
            lanes.append(own)
        lanes[0] <<= _SHIFT
        out[lo:hi] = mix(lanes[0] | lanes[1])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash (62 bits, spread over 64) of each span [start, end), the same wherever the span stands."""
    return _joined(prefix, len(starts), lambda lo, hi: starts[lo:hi], lambda lo, hi: ends[lo:hi])


def windows_hash(prefix: np.ndarray, width: int) -> np.ndarray:
    """Hash of each span of ``width`` values, by its start."""
    n = prefix.shape[1] - width
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return _joined(prefix, n, slice, lambda lo, hi: slice(lo + width, hi + width))


def sliding(values: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over each run of ``width`` values, by doubling."""
    if len(values) < width:
        return values[:0]
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = op(out[: len(out) - step], out[step:])
        have += step
    return out


@dataclass
class Texts:
    """The bytes of some documents end to end; ``offsets`` has a document's bounds."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def as_texts(column) -> Texts:
    """A string column (null: empty text)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(texts: Texts, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes, one document at least."""
    lo, n = 0, len(texts)
    while lo < n:
        hi = int(np.searchsorted(texts.offsets, texts.offsets[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def cut(texts: Texts, lo: int, hi: int) -> Texts:
    a, b = texts.offsets[lo], texts.offsets[hi]
    return Texts(texts.data[a:b], texts.offsets[lo : hi + 1] - a)


@dataclass
class Words:
    """Word bounds in ``data``; words ``first[d]`` to ``first[d + 1]`` belong to document d."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return span_hash(rolling(_BYTE_VALUES[self.data]), self.starts, self.ends)


def words(texts: Texts, classes: np.ndarray, lower: bool = False) -> Words:
    data = LOWER[texts.data] if lower else texts.data
    inside = classes[data]
    n = len(data)
    bounds = texts.offsets
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[bounds[bounds < n]] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    last = bounds[bounds > 0] - 1
    after[last] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, bounds, "left"))


def byte_values(texts: Texts) -> np.ndarray:
    return _BYTE_VALUES[texts.data]


def inside_windows(first: np.ndarray, width: int, active: np.ndarray | None = None) -> np.ndarray:
    """Which window starts (of all units end to end) hold ``width`` units of one (active) document."""
    total = int(first[-1])
    ok = np.zeros(max(total - width + 1, 0), dtype=bool)
    lengths = np.diff(first) - width + 1
    keep = lengths > 0 if active is None else (lengths > 0) & active
    starts, lengths = first[:-1][keep], lengths[keep]
    if len(starts):
        ok[ranges(starts, lengths)] = True
    return ok


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every (start, length), end to end."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    shift = np.repeat(np.asarray(starts, dtype=np.int64) - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total, dtype=np.int64) + shift


def covered(hits: np.ndarray, width: int, total: int) -> np.ndarray:
    """Units inside a window of ``width`` that starts at one of the ``hits`` (each given once)."""
    edge = np.zeros(total + 1, dtype=np.int32)
    edge[hits] = 1
    edge[np.minimum(hits + width, total)] -= 1
    return np.cumsum(edge[:-1]) > 0
