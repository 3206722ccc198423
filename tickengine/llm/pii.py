"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns (email, ip, card, phone) are found by short scans, linear in a text, that follow their leftmost matches.
The field adds what the patterns miss, such as phone numbers without a country code. It is trained on a small labelled
table (at most ``LABELLED_ROWS`` sentences are read) by gradient ascent on the exact likelihood, and decoded by Viterbi
over numpy batches of word sequences. Its sequences are the runs of words near a word with a digit or an ``@``; all
other words have plain shapes and carry no label. The patterns' spans always stay: words that a pattern's span touches
are cut out of a span of the field, and the runs of words that remain are spans of their own.

Defined cases: a null or empty text has no spans; repeated rows are repeated in the result; a null doc_id is kept;
other columns are ignored (or kept, on request); offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickengine.llm import textkit as tk
from tickengine.llm.common import documents, keeping_columns
from tickengine.session import ship

KINDS = ["email", "ip", "card", "phone"]
LABELLED_ROWS = 5000
CONTEXT = 2

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    low, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > low and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            yield "email", start, domain.end()
            low = domain.end()
        at = text.find("@", max(at + 1, low))


def _ips(text: str) -> Iterator[Span]:
    for chain in _DOTTED.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield "ip", at, end
            at = end + 1


def luhn(digits: str) -> bool:
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()


def _phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield "phone", m.start(), m.end()


def pattern_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind and start."""
    found: list[Span] = []
    if "@" in text:
        found += _emails(text)
    found += _ips(text)
    found += _cards(text)
    if "+" in text:
        found += _phones(text)
    return found


# ---- the field

LABELS = ["other", *KINDS]
N_LABELS = len(LABELS)
_DIGIT = np.array([0x30 <= b <= 0x39 for b in range(256)])
_LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_SYMBOLS = b"@.-+()=:/_,#"
_TRIM = {"email": b".,;:!?()[]<>\"'", "ip": b".,;:!?()[]<>\"'", "card": b".,;:!?()[]<>\"'-", "phone": b".,;:!?)[]<>\"'-"}


def _steps(counts: np.ndarray, edges: list[int]) -> np.ndarray:
    """One column for each range between the edges that holds the count."""
    low, high = np.array(edges), np.array([*edges[1:], 1 << 60])
    return (counts[:, None] >= low) & (counts[:, None] < high)


def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Binary shape features of each word: lengths, counts of digits, letters and symbols, first and last byte."""

    def count(inside: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(inside[data])])
        return sums[ends] - sums[starts]

    length = ends - starts
    digits, letters = count(_DIGIT), count(_LETTER)
    symbol = {s: count(np.arange(256) == s) for s in _SYMBOLS}
    first, last = data[starts], data[ends - 1]
    plain = digits == length
    parts = [
        np.ones((len(starts), 1), dtype=bool), _steps(length, [1, 4, 8, 13, 20]), _steps(digits, [0, 1, 2, 3, 4, 5, 7, 9, 12, 13, 20]),
        _steps(letters, [0, 1, 4]), _steps(symbol[0x2E], [0, 1, 2, 3, 4]), _steps(symbol[0x2D], [0, 1, 2, 3]),
        np.stack([symbol[s] > 0 for s in _SYMBOLS], axis=1),
        np.stack([first == 0x2B, first == 0x28, _DIGIT[first], _DIGIT[last], plain, plain & (length == 4), plain & (length == 3),
                  (digits > 0) & (letters > 0), (digits > 0) & (letters == 0) & (symbol[0x2E] == 3), (symbol[0x40] == 1) & (symbol[0x2E] > 0),
                  (digits == 7) & (symbol[0x2D] == 1), (digits == 10) & (symbol[0x2D] == 2), (digits == 16) & (symbol[0x2D] == 3)], axis=1),
    ]
    own = np.concatenate(parts, axis=1).astype(np.float64)
    return own


def with_neighbours(own: np.ndarray, sequence: np.ndarray) -> np.ndarray:
    """The features of each word, and of the words before and after it in its sequence."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = sequence[1:] == sequence[:-1]
    before[1:][same] = own[:-1][same]
    after[:-1][same] = own[1:][same]
    return np.concatenate([own, before, after], axis=1)


def _padded(scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """[word, label] scores of sequences end to end as [sequence, place, label]."""
    out = np.zeros((len(lengths), int(lengths.max()), scores.shape[1]))
    out[np.repeat(np.arange(len(lengths)), lengths), tk.ranges(np.zeros(len(lengths), np.int64), lengths)] = scores
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Field:
    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def decode(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Most likely labels (Viterbi), over batches of sequences of like length."""
        scores = features @ self.weights
        starts = np.cumsum(lengths) - lengths
        out = np.zeros(len(scores), dtype=np.int64)
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            longest = int(lengths[order[at]])
            batch = order[at : at + max(1, (1 << 18) // max(longest, 16))]
            batch = batch[lengths[batch] <= 2 * longest]
            at += len(batch)
            n = lengths[batch]
            s = _padded(scores[tk.ranges(starts[batch], n)], n)
            best, back = s[:, 0], np.zeros(s.shape, dtype=np.int8)
            for t in range(1, s.shape[1]):
                both = best[:, :, None] + self.moves
                back[:, t] = both.argmax(axis=1)
                best = np.where((t < n)[:, None], both.max(axis=1) + s[:, t], best)
            label = best.argmax(axis=1)
            rows = np.arange(len(batch))
            for t in range(s.shape[1] - 1, -1, -1):
                live = t < n
                out[starts[batch][live] + t] = label[live]
                label = np.where(live, back[rows, t, label] if t else label, label)
        return out


def fit(features: np.ndarray, labels: np.ndarray, lengths: np.ndarray, rounds: int = 150, rate: float = 0.2, decay: float = 1e-3) -> Field:
    """Gradient ascent (with per-weight steps) on the log-likelihood of whole label sequences."""
    n_seq = len(lengths)
    weights, moves = np.zeros((features.shape[1], N_LABELS)), np.zeros((N_LABELS, N_LABELS))
    seen = [np.zeros_like(weights), np.zeros_like(moves)]
    truth = np.eye(N_LABELS)[labels]
    inner = np.ones(len(labels), dtype=bool)
    inner[np.cumsum(lengths) - lengths] = False
    pairs = np.zeros_like(moves)
    np.add.at(pairs, (labels[np.flatnonzero(inner) - 1], labels[inner]), 1)
    place = tk.ranges(np.zeros(n_seq, np.int64), lengths)
    seq = np.repeat(np.arange(n_seq), lengths)
    longest = int(lengths.max())
    live = np.arange(longest)[None, :] < lengths[:, None]
    for _ in range(rounds):
        s = _padded(features @ weights, lengths)
        ahead = [s[:, 0]]
        for t in range(1, longest):
            step = _logsum(ahead[-1][:, :, None] + moves, 1) + s[:, t]
            ahead.append(np.where(live[:, t, None], step, ahead[-1]))
        behind = [np.zeros((n_seq, N_LABELS))]
        for t in range(longest - 1, 0, -1):
            step = _logsum(moves[None] + (s[:, t] + behind[0])[:, None, :], 2)
            behind.insert(0, np.where(live[:, t, None], step, behind[0]))
        total = _logsum(ahead[-1], 1)
        chance = np.exp(np.stack(ahead, 1) + np.stack(behind, 1) - total[:, None, None])
        expected = np.zeros_like(moves)
        for t in range(1, longest):
            on = live[:, t]
            both = ahead[t - 1][on][:, :, None] + moves + (s[on, t] + behind[t][on])[:, None, :] - total[on][:, None, None]
            expected += np.exp(both).sum(axis=0)
        grads = (features.T @ (truth - chance[seq, place]) / n_seq - decay * weights, (pairs - expected) / n_seq - decay * moves)
        for value, grad, square in zip((weights, moves), grads, seen, strict=True):
            square += grad**2
            value += rate * grad / (np.sqrt(square) + 1e-8)
    return Field(weights, moves)


def labelled_examples() -> list[tuple[str, list[Span]]]:
    """A small labelled table by rule: sentence frames with one slot each, filled with forms of every kind and with
    numbers that are no personal data."""
    frames = ["write to {} today", "{} is the contact", "please call or mail {}.", "the note says {} and nothing else", "server {} answered late",
              "paid with {} in May", "see ({}) for more", "Contact: {}, then wait", "on the list {} stood first", "from {} to the office"]
    forms = {
        "email": ["ann.lee{d2}@mail{d1}.example.com", "bob_{d2}@example.org", "info+{d3}@web.example.net", "x{d1}@localhost"],
        "ip": ["10.{d2}.{d2}.{d1}", "192.168.{d1}.{d2}", "8{d1}.1{d2}.2{d1}.7{d1}"],
        "card": ["4{d3} {d4} {d4} {d4}", "4{d3}-{d4}-{d4}-{d4}", "5{d3}{d4}{d4}{d4}", "4{d3}{d4}{d4}{d4}", "37{d2} {d3}{d3} {d3}{d2}"],
        "phone": ["({d3}) 555-{d4}", "+1 ({d3}) 555-{d4}", "{d3}-555-{d4}", "+49 30 {d3}{d3}", "+44 20 {d4} {d4}"],
        "other": ["{d4}", "{d2}", "{d1}.{d1}.{d1}", "20{d2}-0{d1}-1{d1}", "1{d1}:{d2}", "token=a{d3}f{d2}b{d4}e", "password=e{d2}d{d4}a{d2}c", "{d3},{d3}",
                  "no. {d3}", "{d2}%", "v{d1}.{d2}", "id{d4}{d4}", "sk_{d3}a{d4}b{d3}c{d3}d", "chapter {d1}", "CC BY 4.0.", "Version 2.0.", "@", "a{d1}b{d3}c{d4}{d4}d{d2}e{d4}f",
                  "{d4}{d4}{d4}{d4}{d4}{d4}", "{d1} {d1} {d2} {d3}", "{d2} {d4} {d2} {d4}", "{d4}{d2}", "{d3} {d3}", "ext {d4}"],
    }
    digits = np.random.default_rng(7)
    out = []
    for frame in frames:
        for kind, patterns in forms.items():
            for pattern in patterns:
                for _ in range(2 if kind == "other" else 4):
                    value = re.sub(r"\{d(\d)\}", lambda m: "".join(map(str, digits.integers(1, 10, int(m[1])))), pattern)
                    at = frame.index("{}")
                    out.append((frame.replace("{}", value), [] if kind == "other" else [(kind, at, at + len(value))]))
    return out


def labelled_table(spark: SparkSession) -> DataFrame:
    rows = [(text, [{"kind": k, "start": a, "end": b} for k, a, b in spans]) for text, spans in labelled_examples()]
    return spark.createDataFrame(rows, "text string, spans array<struct<kind:string,start:int,end:int>>")


def train(labelled: DataFrame, limit: int = LABELLED_ROWS) -> Field:
    """The field for a small table of sentences (ASCII) and their spans; ``limit`` bounds the rows read."""
    rows = [r for r in labelled.limit(limit).collect() if r.text]
    texts = tk.as_texts(pa.array([r.text for r in rows], pa.string()))
    w = tk.words(texts, tk.NOT_SPACE)
    labels = np.zeros(len(w.starts), dtype=np.int64)
    docs = w.docs()
    for d, row in enumerate(rows):
        a, b = w.first[d], w.first[d + 1]
        for span in row.spans or []:
            shift = texts.offsets[d]
            inside = (w.starts[a:b] < shift + span.end) & (w.ends[a:b] > shift + span.start)
            labels[a:b][inside] = LABELS.index(span.kind)
    lengths = np.diff(w.first)
    return fit(with_neighbours(shapes(w.data, w.starts, w.ends), docs), labels, lengths[lengths > 0])


def _field_spans(field: Field, texts: tk.Texts) -> list[tuple[int, str, int, int]]:
    """(document, kind, start, end) in bytes of ``texts``."""
    w = tk.words(texts, tk.NOT_SPACE)
    marked = np.concatenate([[0], np.cumsum(_DIGIT[w.data] | (w.data == 0x40))])
    near = np.flatnonzero(marked[w.ends] > marked[w.starts])
    if not len(near):
        return []
    docs = w.docs()
    take = np.zeros(len(w.starts), dtype=bool)
    for shift in range(-CONTEXT, CONTEXT + 1):
        to = near + shift
        ok = (to >= 0) & (to < len(docs))
        ok[ok] = docs[to[ok]] == docs[near[ok]]
        take[to[ok]] = True
    at = np.flatnonzero(take)
    new = np.concatenate([[True], (np.diff(at) > 1) | (docs[at][1:] != docs[at][:-1])])
    sequence = np.cumsum(new) - 1
    labels = field.decode(with_neighbours(shapes(w.data, w.starts[at], w.ends[at]), sequence), np.bincount(sequence))
    edge = np.concatenate([[True], new[1:] | (labels[1:] != labels[:-1]), [True]])
    bounds = np.flatnonzero(edge)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if labels[a]:
            kind = LABELS[labels[a]]
            start, end = _trimmed(w.data, kind, int(w.starts[at[a]]), int(w.ends[at[b - 1]]))
            if start < end:
                out.append((int(docs[at[a]]), kind, start, end))
    return out


def _trimmed(data: np.ndarray, kind: str, start: int, end: int) -> tuple[int, int]:
    raw = data[start:end].tobytes()
    return start + len(raw) - len(raw.lstrip(_TRIM[kind])), start + len(raw.rstrip(_TRIM[kind]))


def _remaining(data: np.ndarray, kind: str, start: int, end: int, touched: Callable[[int, int], bool]) -> Iterator[tuple[int, int]]:
    """The runs of words in ``data[start:end]`` of which no word is touched."""
    run: list[int] = []
    for m in _WORD.finditer(data[start:end].tobytes()):
        a, b = start + m.start(), start + m.end()
        if not touched(a, b):
            run = [run[0] if run else a, b]
        elif run:
            yield _trimmed(data, kind, *run)
            run = []
    if run:
        yield _trimmed(data, kind, *run)


def _document_spans(field: Field, texts: tk.Texts) -> list[tuple[list[Span], list[Span]]]:
    """Pattern spans and added spans of each document, in code points."""
    found: list[tuple[list[Span], list[Span]]] = [([], []) for _ in range(len(texts))]
    marked = np.concatenate([[0], np.cumsum(_DIGIT[texts.data] | (texts.data == 0x40))])[texts.offsets]
    for d in np.flatnonzero(marked[1:] > marked[:-1]).tolist():
        text = texts.data[texts.offsets[d] : texts.offsets[d + 1]].tobytes().decode("utf-8", "replace")
        found[d] = (pattern_spans(text), [])
    points = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    edges: dict[int, tuple[list[int], list[int]]] = {}  # of a document's patterns: starts, and how far those so far reach
    for d, kind, start, end in _field_spans(field, texts):
        if d not in edges:
            fixed = sorted((x, y) for _, x, y in found[d][0])
            edges[d] = [x for x, _ in fixed], list(accumulate((y for _, y in fixed), max))
        starts, reach = edges[d]
        base = points[texts.offsets[d]]

        def touched(a: int, b: int, starts=starts, reach=reach, base=base) -> bool:
            before = bisect_left(starts, points[b] - base)
            return before > 0 and reach[before - 1] > points[a] - base

        for a, b in _remaining(texts.data, kind, start, end, touched) if touched(start, end) else [(start, end)]:
            if a < b:
                found[d][1].append((kind, int(points[a] - base), int(points[b] - base)))
    return found


_SPANS = "array<struct<kind:string,start:long,end:long,pattern:boolean>>"
_SPANS_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("pattern", pa.bool_())]))


def find_private(docs: DataFrame, field: Field, keep_columns: bool = False) -> DataFrame:
    """Documents with ``_spans``, by kind (as listed) and start; ``pattern`` tells the fixed patterns' spans from the
    field's. ``keep_columns`` keeps the documents' own columns. Narrow: no shuffle."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tk.as_texts(batch["text"])
            for lo, hi in tk.slices(texts):
                out = []
                for base, added in _document_spans(field, tk.cut(texts, lo, hi)):
                    spans = [(KINDS.index(k), a, b, True) for k, a, b in base] + [(KINDS.index(k), a, b, False) for k, a, b in added]
                    out.append([{"kind": KINDS[k], "start": a, "end": b, "pattern": p} for k, a, b, p in sorted(spans)])
                part = batch.slice(lo, hi - lo)
                columns = [part.column(i) for i in range(part.num_columns - (0 if keep_columns else 1))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(out, _SPANS_TYPE)], names=[*part.schema.names[: len(columns)], "_spans"])

    if keep_columns:
        return docs.mapInArrow(scan, T.StructType(list(docs.schema.fields)).add("_spans", T.DataType.fromDDL(_SPANS)))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, f"doc_id long, _spans {_SPANS}")


def _digest(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op7_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = find_private(documents(spark, sf_dir), train(labelled_table(spark)))
    base = F.filter("_spans", lambda s: s["pattern"])
    counts = [F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]  # noqa: B023
    return found.select("doc_id", *counts, F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("_spans")).alias("spans"))


def masked(text, spans):
    """``text`` with every span replaced by its kind in brackets; of overlapping spans the first one's kind stands."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    step = lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
        F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(
            acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
            F.lit("["), F.upper(s["kind"]), F.lit("]"))).alias("out"), s["end"].alias("at")))
    done = lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2**31 - 1)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, state, step, done))


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: personal data is masked in the texts; every document stays, ``n_chars`` follows the text."""
    ship(spark)
    field = train(labelled_table(spark))

    def mask(plain: DataFrame) -> DataFrame:
        found = find_private(plain, field, keep_columns=True).withColumn("_masked", masked(F.col("text"), F.col("_spans")))
        columns = {"text": F.col("_masked")}
        if "n_chars" in plain.columns:
            kind = plain.schema["n_chars"].dataType
            columns["n_chars"] = F.when(F.size("_spans") == 0, F.col("n_chars")).otherwise(F.length("_masked").cast(kind))
        return found.select(*(columns.get(c, F.col(c)).alias(c) for c in plain.columns))

    return keeping_columns(docs, mask)
