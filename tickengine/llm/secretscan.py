"""Secrets: fixed patterns, and a character convolutional network over every candidate with its context.

The patterns (assign, access, hex) follow their leftmost matches in the text's bytes; all their characters are ASCII, so
bytes and code points give the same matches. The network adds what the patterns miss. Its candidates are all longest
runs of key characters (letters, digits, ``+/_.~-``, with trailing ``=``) that hold a digit and 12 characters
(``token``), or that stand behind ``:`` or ``=`` with 8 characters (``value``). A candidate of any length is read whole,
with ``CONTEXT`` bytes on both sides: character embeddings and an inside flag, one convolution, the largest and the mean
response inside the candidate and the largest on each side, one hidden layer.

It is trained on a labelled table of findings (part ``train``); logits are turned into probabilities by a logistic fit on
the part ``calibrate``, and each kind's threshold is the largest one that keeps the wanted recall there. A candidate that
lies inside a pattern's span is not added again; pattern spans always stay.

Defined cases: a null or empty text has no spans; repeated rows are repeated in the result; a null doc_id is kept; other
columns are ignored; offsets are code points, ends exclusive; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickengine.llm import textkit as tk
from tickengine.llm.common import documents
from tickengine.session import ship

PATTERNS = ["assign", "access", "hex"]
LEARNED = ["value", "token"]
KINDS = PATTERNS + LEARNED
LABELLED_ROWS = 20_000
RECALL = 0.97
CONTEXT = 24
VALUE_BYTES = 8
TOKEN_BYTES = 12

_ASSIGN = re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = tk._byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x66)
_DIGIT = tk._byte_class(lambda b: 0x30 <= b <= 0x39)
_KEY = tk._byte_class(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b in b"+/_.~-")
_QUOTE = tk._byte_class(lambda b: b in b"\"'`")

Span = tuple[int, int, int]  # kind, start, end


def pattern_spans(texts: tk.Texts) -> list[list[Span]]:
    """Spans of the fixed patterns of each document, in bytes from its start, by start and kind."""
    raw = texts.data.tobytes()
    access = b"AKIA" in raw
    out: list[list[Span]] = []
    for lo, hi in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True):
        own = [(0, m.start() - lo, m.end() - lo) for m in _ASSIGN.finditer(raw, lo, hi) if m.end(1) - m.start(1) >= 8]
        if access:
            own += [(1, m.start() - lo, m.end() - lo) for m in _ACCESS.finditer(raw, lo, hi) if m.end() - m.start() >= 16]
        out.append(own)
    runs = tk.words(texts, _HEX)
    long = np.flatnonzero(runs.ends - runs.starts >= 32)
    docs = np.searchsorted(runs.first, long, "right") - 1
    for d, a, b in zip(docs.tolist(), runs.starts[long].tolist(), runs.ends[long].tolist(), strict=True):
        lo = int(texts.offsets[d])
        out[d].append((2, a - lo, b - lo))
    for own in out:
        own.sort(key=lambda s: (s[1], s[0]))
    return out


@dataclass
class Candidates:
    """Runs of key characters, in bytes of the texts; ``kind`` is a place in KINDS."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    kind: np.ndarray


def candidates(texts: tk.Texts) -> Candidates:
    data = texts.data
    runs = tk.words(texts, _KEY)
    start, end, doc = runs.starts, runs.ends, runs.docs()
    low, high = texts.offsets[:-1][doc], texts.offsets[1:][doc]
    at = lambda where: data[np.clip(where, 0, max(len(data) - 1, 0))]
    before = start - 1
    before = before - ((before >= low) & _QUOTE[at(before)])
    for _ in range(2):
        before = before - ((before >= low) & (at(before) == 0x20))
    assigned = (before >= low) & ((at(before) == 0x3A) | (at(before) == 0x3D))
    for _ in range(3):  # dots around a run end or begin a sentence
        end = end - ((end > start) & (at(end - 1) == 0x2E))
        start = start + ((end > start) & (at(start) == 0x2E))
    for _ in range(2):
        end = end + ((end > start) & (end < high) & (at(end) == 0x3D))
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    length = end - start
    value = assigned & (length >= VALUE_BYTES)
    token = ~value & (length >= TOKEN_BYTES) & (digits[end] > digits[start])
    take = np.flatnonzero(value | token)
    return Candidates(doc[take], start[take], end[take], np.where(value[take], KINDS.index("value"), KINDS.index("token")))


# ---- the network

_WIDTH, _EMBED, _FILTERS, _HIDDEN = 5, 8, 32, 32
_CHUNK = 1 << 16
_SEGMENTS = 3  # left context, the candidate, right context


def windows(texts: tk.Texts, found: Candidates) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All candidates' windows end to end, each between pads: characters, inside flags, and the first place of each
    candidate's left context, candidate and right context. Contexts end with the document."""
    left = np.maximum(found.start - CONTEXT, texts.offsets[:-1][found.doc])
    right = np.minimum(found.end + CONTEXT, texts.offsets[1:][found.doc])
    pad = _WIDTH // 2 + 1  # every segment holds a place
    sizes = right - left + 2 * pad
    first = np.cumsum(sizes) - sizes
    chars = np.zeros(int(sizes.sum()), dtype=np.uint8)
    to = tk.ranges(first + pad, right - left)
    chars[to] = np.minimum(texts.data[tk.ranges(left, right - left)], 127)
    begin = first + pad + found.start - left
    end = begin + found.end - found.start
    flags = np.zeros(len(chars) + 1, dtype=np.int8)
    flags[begin] += 1
    flags[end] -= 1
    return chars, np.cumsum(flags[:-1]).astype(np.float32), np.stack([first, begin, end], axis=1).ravel()


def _columns(embedded: np.ndarray) -> np.ndarray:
    """The values around each place, side by side; zeros beyond both ends."""
    half = _WIDTH // 2
    padded = np.pad(embedded, ((half, half), (0, 0)))
    return np.concatenate([padded[k : k + len(embedded)] for k in range(_WIDTH)], axis=1)


class Network:
    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @classmethod
    def fresh(cls, seed: int = 5) -> Network:
        rnd = np.random.default_rng(seed)
        shapes = {"embed": (128, _EMBED), "conv": (_WIDTH * (_EMBED + 1), _FILTERS), "conv_bias": (_FILTERS,), "hidden": (4 * _FILTERS, _HIDDEN),
                  "hidden_bias": (_HIDDEN,), "out": (_HIDDEN,), "out_bias": (1,)}
        scale = {"embed": 0.5, "conv": 0.2, "hidden": 0.12, "out": 0.2}
        return cls({k: rnd.normal(0, scale.get(k, 0.0), s) for k, s in shapes.items()})

    def responses(self, chars: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = self.weights
        columns = _columns(np.concatenate([w["embed"][chars], inside[:, None]], axis=1))
        return columns, np.maximum(columns @ w["conv"] + w["conv_bias"], 0)

    def pooled(self, chars: np.ndarray, inside: np.ndarray, segments: np.ndarray) -> np.ndarray:
        """Largest responses of the three segments and the mean one inside, a bounded number of places at a time."""
        top, total = np.zeros((len(segments), _FILTERS)), np.zeros((len(segments), _FILTERS))
        half = _WIDTH // 2
        for lo in range(0, len(chars), _CHUNK):
            hi = min(lo + _CHUNK, len(chars))
            a, b = max(lo - half, 0), min(hi + half, len(chars))
            _, act = self.responses(chars[a:b], inside[a:b])
            act = act[lo - a : hi - a]
            of = np.searchsorted(segments, [lo, hi - 1], "right") - 1
            cuts = np.maximum(segments[of[0] : of[1] + 1] - lo, 0)
            rows = slice(of[0], of[1] + 1)
            top[rows] = np.maximum(top[rows], np.maximum.reduceat(act, cuts, axis=0))
            total[rows] += np.add.reduceat(act, cuts, axis=0)
        sizes = np.diff(np.append(segments, len(chars)))
        top, mean = top.reshape(-1, _SEGMENTS, _FILTERS), (total / np.maximum(sizes, 1)[:, None]).reshape(-1, _SEGMENTS, _FILTERS)
        return np.concatenate([top[:, 0], top[:, 1], top[:, 2], mean[:, 1]], axis=1)

    def logits(self, chars: np.ndarray, inside: np.ndarray, segments: np.ndarray) -> np.ndarray:
        if not len(segments):
            return np.zeros(0)
        w = self.weights
        hidden = np.maximum(self.pooled(chars, inside, segments) @ w["hidden"] + w["hidden_bias"], 0)
        return hidden @ w["out"] + w["out_bias"]

    def loss(self, chars, inside, segments, secret, decay: float = 1e-4) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss with squared weights, and its gradient."""
        w = self.weights
        columns, act = self.responses(chars, inside)
        top = np.maximum.reduceat(act, segments, axis=0)
        sizes = np.diff(np.append(segments, len(chars)))
        mean = np.add.reduceat(act, segments, axis=0) / sizes[:, None]
        three = top.reshape(-1, _SEGMENTS, _FILTERS)
        pooled = np.concatenate([three[:, 0], three[:, 1], three[:, 2], mean.reshape(-1, _SEGMENTS, _FILTERS)[:, 1]], axis=1)
        hidden = np.maximum(pooled @ w["hidden"] + w["hidden_bias"], 0)
        logit = hidden @ w["out"] + w["out_bias"]
        n = len(secret)
        value = float(np.mean(np.logaddexp(0, logit) - secret * logit)) + decay / 2 * sum(float((v**2).sum()) for v in w.values())
        grads: dict[str, np.ndarray] = {}
        g = (1 / (1 + np.exp(-logit)) - secret) / n
        grads["out"], grads["out_bias"] = hidden.T @ g, np.array([g.sum()])
        g = np.outer(g, w["out"]) * (hidden > 0)
        grads["hidden"], grads["hidden_bias"] = pooled.T @ g, g.sum(axis=0)
        g = g @ w["hidden"].T
        g_top = np.stack([g[:, k * _FILTERS : (k + 1) * _FILTERS] for k in range(3)], axis=1).reshape(-1, _FILTERS)
        g_mean = np.zeros_like(top).reshape(-1, _SEGMENTS, _FILTERS)
        g_mean[:, 1] = g[:, 3 * _FILTERS :] / sizes.reshape(-1, _SEGMENTS)[:, 1, None]
        of = np.repeat(np.arange(len(segments)), sizes)
        largest = (act == top[of]) & (act > 0)
        share = np.maximum(np.add.reduceat(largest, segments, axis=0, dtype=np.float64), 1)  # ties share
        g = (largest * (g_top / share)[of] + g_mean.reshape(-1, _FILTERS)[of]) * (act > 0)
        grads["conv"], grads["conv_bias"] = columns.T @ g, g.sum(axis=0)
        g = g @ w["conv"].T
        half, width = _WIDTH // 2, _EMBED + 1
        back = np.zeros((len(chars) + 2 * half, width))
        for k in range(_WIDTH):
            back[k : k + len(chars)] += g[:, k * width : (k + 1) * width]
        back = back[half : half + len(chars), :_EMBED]
        grads["embed"] = np.stack([np.bincount(chars, back[:, j], minlength=128) for j in range(_EMBED)], axis=1)
        return value, {k: grads[k] + decay * w[k] for k in w}


def fit(texts: tk.Texts, found: Candidates, secret: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 4e-3, seed: int = 5) -> Network:
    """Adam over shuffled batches of findings."""
    network = Network.fresh(seed)
    rnd = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in network.weights.items()}
    second = {k: np.zeros_like(v) for k, v in network.weights.items()}
    step = 0
    for epoch in range(epochs):
        order = rnd.permutation(len(secret))
        for lo in range(0, len(order), batch):
            part = order[lo : lo + batch]
            _, grads = network.loss(*windows(texts, _taken(found, part)), secret[part])
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                pace = rate * (0.3 if epoch >= 2 * epochs // 3 else 1.0)
                network.weights[k] -= pace * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return network


def _taken(found: Candidates, part: np.ndarray) -> Candidates:
    return Candidates(found.doc[part], found.start[part], found.end[part], found.kind[part])


def calibration(logits: np.ndarray, secret: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(slope, shift) of the logistic fit of the labels on the logits (Newton, with a small ridge)."""
    a, b = 1.0, 0.0
    x = np.stack([logits, np.ones_like(logits)], axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        grad = x.T @ (p - secret) + 1e-3 * np.array([a - 1, b])
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(curve, grad)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return float(a), float(b)


@dataclass
class Scanner:
    network: Network
    slope: float
    shift: float
    thresholds: dict[str, float]

    def probabilities(self, texts: tk.Texts, found: Candidates) -> np.ndarray:
        logits = self.network.logits(*windows(texts, found))
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -30, 30)))

    def accepted(self, texts: tk.Texts, found: Candidates) -> np.ndarray:
        least = np.array([self.thresholds.get(k, 1.0) for k in KINDS])
        return self.probabilities(texts, found) >= least[found.kind]


# ---- labelled findings


def labelled_findings(seed: int = 11, each: int = 40) -> list[tuple[str, str, bool, str]]:
    """(text, value, secret, part) by rule: values of many forms, secret or not, in contexts of code, settings, logs and
    prose. One value in four is for calibration."""
    rnd = np.random.default_rng(seed)
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

    def some(letters: str, n: int) -> str:
        return "".join(letters[i] for i in rnd.integers(0, len(letters), n))

    def one(options: list[str]) -> str:
        return options[int(rnd.integers(0, len(options)))]

    def between(a: int, b: int) -> int:
        return int(rnd.integers(a, b))

    def word() -> str:
        return "".join(some("bcdfghklmnprst", 1) + some("aeiou", 1) for _ in range(between(2, 5)))

    def password() -> str:
        return one([word().title() + some(digits, between(2, 5)) + one(["", "-", "_", "."]) + some(lower + upper + digits, between(2, 8)),
                    some(lower + upper + digits, between(9, 20)), some(lower + digits, between(10, 18)), word() + "-" + word() + "-" + word() + some(digits, 2)])

    def encoded(n: int) -> str:
        return base64.b64encode(rnd.integers(0, 256, n, dtype=np.uint8).tobytes()).decode()

    mixed = lower + upper + digits
    free = {  # secret wherever they stand
        "hub": lambda: one(["ghp_", "gho_", "ghs_"]) + some(mixed, 36), "chat": lambda: "xoxb-" + some(digits, 11) + "-" + some(digits, 12) + "-" + some(mixed, 24),
        "pay": lambda: one(["sk_live_", "rk_live_", "sk_test_"]) + some(mixed, between(20, 30)), "maps": lambda: "AIza" + some(mixed + "_-", 35),
        "web": lambda: "eyJ" + some(mixed, between(17, 40)) + ".eyJ" + some(mixed, between(20, 60)) + "." + some(mixed + "_-", 43),
        "random": lambda: some(mixed, between(24, 44)), "base": lambda: encoded(between(24, 60)), "mail": lambda: "SG." + some(mixed, 22) + "." + some(mixed, 43),
        "lab": lambda: "glpat-" + some(mixed, 20), "upper": lambda: some(upper + digits, between(24, 40)),
    }
    given = {"password": password, "short": lambda: some(mixed, between(10, 20)), "hexes": lambda: some("0123456789abcdef", between(16, 31))}
    plain = {  # never secret
        "version": lambda: f"v{between(0, 20)}.{between(0, 30)}.{between(0, 99)}-{one(['beta', 'rc', 'alpha'])}.{between(1, 9)}",
        "path": lambda: "/".join(word() for _ in range(between(2, 6))) + f"/{word()}{between(1, 99)}.{one(['txt', 'py', 'html', 'json'])}",
        "host": lambda: f"www.{word()}{between(1, 99)}.example.{one(['com', 'org', 'net'])}/{word()}", "name": lambda: "_".join(word() for _ in range(between(2, 5))) + f"_{between(1, 999)}",
        "camel": lambda: word() + "".join(word().title() for _ in range(between(1, 4))) + str(between(1, 99)),
        "date": lambda: f"20{between(10, 30)}-{between(10, 13)}-{between(10, 29)}T{between(10, 24)}", "long": lambda: some(digits, between(12, 20)),
        "uuid": lambda: "-".join(some("0123456789abcdef", n) for n in (8, 4, 4, 4, 12)), "count": lambda: f"{some(digits, 4)}-{some(digits, 4)}-{some(digits, 4)}-{some(digits, 4)}",
        "dashes": lambda: "-".join(word() for _ in range(between(2, 6))) + f"-{between(1, 2999)}", "fill": lambda: one(["xxxxxxxxxxxxxxxx0", "00000000000000000000", "123456789012", "abcdefgh12345678"]),
        "words": lambda: "/".join(word() for _ in range(between(2, 4))) + str(between(1, 9)), "dotted": lambda: ".".join(word() for _ in range(between(2, 5))) + f".{between(1, 20)}",
        "numbers": lambda: f"{between(1, 255)}.{between(1, 255)}.{between(1, 255)}.{between(1, 255)}", "phone": lambda: f"{some(digits, 3)}-{some(digits, 3)}-{some(digits, 4)}",
        "isbn": lambda: f"978-{some(digits, 1)}-{some(digits, 4)}-{some(digits, 4)}-{some(digits, 1)}",
    }
    said = {  # behind a colon or equals sign, not secret
        "word": lambda: word() + word(), "title": lambda: word().title() + word(), "dashed": lambda: word() + "-" + word(), "file": lambda: f"{word()}{word()}.{one(['txt', 'csv', 'png'])}",
        "place": lambda: one(["localhost", "production", "undefined", "disabled", "changeme", "your_value_here", "placeholder", "true-or-false"]), "snake": lambda: word() + "_" + word(),
        "day": lambda: f"20{between(10, 30)}-{between(10, 13)}-{between(10, 29)}", "amount": lambda: f"{some(digits, 6)}.{some(digits, 2)}", "link": lambda: f"/{word()}/{word()}/{between(1, 99)}",
    }
    around = ["{w} {v} {w} {w}.", "{w} {w} {w} ({v}) {w}", "{w} is \"{v}\" {w}", "{w}, {v}, {w} {w} {w}", "- {v}\n{w} {w}", "{v}", "{w}\n{v}\n{w}", "{w} {w} {v}"]
    naming = ["pwd", "auth", "key", "credential", "access", "pin", "bearer", "pass", "login", "private", "client_key", "signing"]
    neutral = ["name", "title", "date", "file", "path", "mode", "note", "see", "host", "id", "result", "about", "city", "label"]
    setting = ["{n}: {v}\n{w} {w}", "{n}={v}", "{w} {w} {n} = \"{v}\" {w}", "\"{n}\": \"{v}\", \"{w}\": 1", "export {n}={v}\n{w}", "{w} {n}: '{v}' {w} {w}", "--{n}={v} {w}"]

    def filled(frame: str, value: str, name: str = "") -> str:
        return re.sub(r"\{w\}", lambda _: word(), frame).replace("{n}", name).replace("{v}", value)

    rows: list[tuple[str, str, bool, str]] = []

    def add(frame: str, value: str, secret: bool, name: str = ""):
        rows.append((filled(frame, value, name), value, secret, "calibrate" if rnd.random() < 0.25 else "train"))

    for _ in range(each):
        for make in free.values():
            add(one(around), make(), True)
            add(one(setting), make(), True, one(naming + neutral))
        for make in given.values():
            for _ in range(3):
                value = make()
                add(one(setting), value, True, one([word() + "_", "", ""]) + one(naming))
        for make in plain.values():
            add(one(around), make(), False)
            add(one(setting), make(), False, one(neutral))
        for make in said.values():
            add(one(setting), make(), False, one(neutral))
            add(one(setting), make(), False, one(neutral + naming + [word(), word()]))
    return rows


def findings_table(spark: SparkSession, seed: int = 11) -> DataFrame:
    rows = [(text, text.index(value), text.index(value) + len(value), secret, part) for text, value, secret, part in labelled_findings(seed)]
    return spark.createDataFrame(rows, "text string, start int, end int, secret boolean, part string")


def _labelled(rows: list) -> tuple[tk.Texts, Candidates, np.ndarray]:
    """The candidates of labelled texts; a candidate is secret if it overlaps a finding that is, and one that overlaps
    no finding (context words) is not."""
    texts = tk.as_texts(pa.array([r["text"] for r in rows], pa.string()))
    found = candidates(texts)
    start, end = np.array([r["start"] for r in rows]), np.array([r["end"] for r in rows])
    secret = np.array([bool(r["secret"]) for r in rows])
    low = texts.offsets[:-1][found.doc]
    touched = (found.start - low < end[found.doc]) & (found.end - low > start[found.doc])
    return texts, found, (touched & secret[found.doc]).astype(np.float64)


def train(labelled: DataFrame, recall: float = RECALL, limit: int = LABELLED_ROWS) -> Scanner:
    """The scanner of a labelled table of findings: text (ASCII), start, end, secret, part (train or calibrate). At most
    ``limit`` rows are read, the first by text and start."""
    rows = [r.asDict() for r in labelled.orderBy("text", "start", "end", "secret", "part").limit(limit).collect() if r.text]
    parts = {p: [r for r in rows if r["part"] == p] for p in ("train", "calibrate")}
    texts, found, secret = _labelled(parts["train"])
    network = fit(texts, found, secret)
    texts, found, secret = _labelled(parts["calibrate"])
    slope, shift = calibration(network.logits(*windows(texts, found)), secret)
    scanner = Scanner(network, slope, shift, {})
    chance = scanner.probabilities(texts, found)
    for kind in LEARNED:
        of_kind = np.sort(chance[(found.kind == KINDS.index(kind)) & (secret > 0)])
        if len(of_kind):  # the largest threshold that keeps the recall; a kind never seen is never added
            scanner.thresholds[kind] = float(of_kind[int((1 - recall) * len(of_kind))])
    return scanner


# ---- the operator

_SPANS = "array<struct<kind:string,start:long,end:long,pattern:boolean>>"
_SPANS_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("pattern", pa.bool_())]))


def _document_spans(scanner: Scanner, texts: tk.Texts) -> list[list[dict]]:
    """Every document's spans in code points, by start and kind."""
    fixed = pattern_spans(texts)
    found = candidates(texts)
    yes = np.flatnonzero(scanner.accepted(texts, found))
    added: list[list[Span]] = [[] for _ in fixed]
    for d, a, b, kind in zip(found.doc[yes].tolist(), found.start[yes].tolist(), found.end[yes].tolist(), found.kind[yes].tolist(), strict=True):
        lo = int(texts.offsets[d])
        added[d].append((kind, a - lo, b - lo))
    points = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    out = []
    for d, (base, more) in enumerate(zip(fixed, added, strict=True)):
        reach, k, spans = -1, 0, [(a, kind, b) for kind, a, b in base]
        for kind, a, b in more:  # by start, like the patterns' spans: inside one of those that start before?
            while k < len(base) and base[k][1] <= a:
                reach = max(reach, base[k][2])
                k += 1
            if b > reach:
                spans.append((a, kind, b))
        lo = int(texts.offsets[d])
        at = lambda x, lo=lo: int(points[lo + x] - points[lo])
        out.append([{"kind": KINDS[kind], "start": at(a), "end": at(b), "pattern": kind < len(PATTERNS)} for a, kind, b in sorted(spans)])
    return out


def find_secrets(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """doc_id and spans (kind, start, end, pattern; by start, then kind as listed) of every document. Narrow: no shuffle."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tk.as_texts(batch["text"])
            for lo, hi in tk.slices(texts):
                spans = pa.array(_document_spans(scanner, tk.cut(texts, lo, hi)), _SPANS_TYPE)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), spans], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, f"doc_id long, spans {_SPANS}")


def _digest(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = find_secrets(documents(spark, sf_dir), train(findings_table(spark)))
    base = F.filter("spans", lambda s: s["pattern"])
    counts = [F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in PATTERNS]  # noqa: B023
    return found.select("doc_id", *counts, F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("spans")).alias("spans"))
