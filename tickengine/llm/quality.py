"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every document (bad, good, or no vote) for two questions: is it junk (repeats,
shouting, symbols), is it abusive (a word of the lexicon, a beginning of one, a beginning that several words share, two
or more such words). The votes of all documents are counted by pattern (at most 3^6 and 3^4 of them), and
expectation-maximisation over the counts estimates each labeller's accuracy in both classes and the posterior of every
pattern. The posteriors of a bounded sample (``TRAIN_ROWS`` documents by a hash of id and text, of a document with more
than ``TRAIN_FEATURES`` features those of least hash) train one hashed linear scorer a question, over words, word
beginnings and steps of the measures; the scorers judge every whole document.

The lexicon holds, from a bounded sample of ``LABELLED_ROWS`` rows of ``labels``, the words, word beginnings and
repeated beginnings that are far more frequent in abusive documents (at most ``LEXICON`` of them). No list is fixed.

Defined cases: a null or empty text, or one without words, has no evidence: scores 0, kept; a null doc_id is kept and
scored like any; repeated rows are repeated; without labels no document counts as abusive; other columns are ignored
(or kept, on request); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickengine.llm import textkit as tk
from tickengine.llm.common import documents, keeping_columns
from tickengine.session import ship

TRAIN_ROWS = 6000
LABELLED_ROWS = 6000
TRAIN_FEATURES = 8192
LEXICON = 4096
BEGINNINGS = (4, 6)  # bytes of a longer word
LEAST_DOCS = 8  # documents of the sample that must hold a feature
ODDS = 3.0

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#%$&*|")] = True
_LOUD = _SYMBOL.copy()
_LOUD[0x21] = True

# (measure, bad from, good below, least words)
JUNK_LABELLERS = [("repeats", 0.3, 0.1, 5), ("sameness", 0.7, 0.5, 20), ("capitals", 0.6, 0.3, 1), ("shouts", 0.5, 0.1, 1),
                  ("symbols", 0.3, 0.1, 1), ("tails", 0.3, 0.1, 1)]
# kinds of features; the first three are those of the lexicon, and each has a labeller of abuse beside "two or more words"
WORD, BEGINNING, REPEATED, MEASURE = 0, 1, 2, 3
ABUSE_LABELLERS = 4
BAD, GOOD, NONE = 0, 1, 2


@dataclass
class View:
    """What one slice of texts shows: words a document, measures, and hashed features with their kinds, documents and words."""

    n_words: np.ndarray
    measures: dict[str, np.ndarray]
    features: np.ndarray
    kinds: np.ndarray
    of: np.ndarray
    word: np.ndarray


def _share(amount: np.ndarray, of: np.ndarray) -> np.ndarray:
    return amount / np.maximum(of, 1)


def term_hashes(w: tk.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, kind and word of every (lower-case) word, of the beginnings of longer ones, and of each beginning that at
    least two words of its document have (once a document, with one of them)."""
    prefix = tk.rolling(tk.byte_values(tk.Texts(w.data, w.starts)))
    terms, kinds, words = [tk.span_hash(prefix, w.starts, w.ends)], [WORD], [np.arange(len(w.starts))]
    docs = w.docs().astype(np.uint64)
    for n in BEGINNINGS:
        long = np.flatnonzero(w.ends - w.starts > n)
        begin = tk.mix(tk.span_hash(prefix, w.starts[long], w.starts[long] + n) ^ np.uint64(0x5851F42D4C957F2D + n))
        _, first, count = np.unique(tk.mix(begin ^ tk.mix(docs[long])), return_index=True, return_counts=True)
        first = first[count > 1]
        terms += [begin, tk.mix(begin[first] ^ np.uint64(0x14057B7EF767814F))]
        kinds += [BEGINNING, REPEATED]
        words += [long, long[first]]
    return np.concatenate(terms), np.repeat(np.array(kinds, dtype=np.int8), [len(t) for t in terms]), np.concatenate(words)


def view(texts: tk.Texts) -> View:
    raw = tk.words(texts, tk.NOT_SPACE)
    n, docs = np.diff(raw.first), raw.docs()
    hashes = raw.hashes()

    def per_doc(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[texts.offsets[1:]] - sums[texts.offsets[:-1]]

    again = np.zeros(len(docs), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (docs[1:] == docs[:-1])
    order = np.lexsort((hashes, docs))
    new = np.ones(len(docs), dtype=bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (docs[order][1:] != docs[order][:-1])
    upper = (raw.data >= 0x41) & (raw.data <= 0x5A)
    lower = (raw.data >= 0x61) & (raw.data <= 0x7A)
    count = lambda flags: np.bincount(docs[flags], minlength=len(n))
    measures = {
        "repeats": _share(count(again), n),
        "sameness": 1 - _share(count(new[np.argsort(order)]), n),
        "capitals": _share(per_doc(upper), per_doc(upper) + per_doc(lower)),
        "shouts": _share(per_doc(raw.data == 0x21), n),
        "symbols": _share(per_doc(_SYMBOL[raw.data]), n),
        "tails": _share(count(_LOUD[raw.data[raw.ends - 1]] if len(docs) else again), n),
    }
    w = tk.words(texts, tk.LETTERS_DIGITS, lower=True)
    terms, kinds, word = term_hashes(w)
    features, of = [terms], [w.docs()[word]]
    for k, value in enumerate(measures.values()):
        step = np.minimum((value * 10).astype(np.uint64), np.uint64(10))
        features.append(tk.mix(step + np.uint64(1000 * (k + 1))))
        of.append(np.arange(len(n)))
    rest = len(n) * len(measures)
    return View(n, measures, np.concatenate(features), np.concatenate([kinds, np.full(rest, MEASURE, dtype=np.int8)]), np.concatenate(of),
                np.concatenate([word, np.full(rest, -1)]))


def _holds(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), dtype=bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


def votes(v: View, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[document, labeller] votes on junk and on abuse."""
    junk = np.full((len(v.n_words), len(JUNK_LABELLERS)), NONE, dtype=np.int8)
    for k, (name, bad, good, least) in enumerate(JUNK_LABELLERS):
        x = v.measures[name]
        junk[x >= bad, k] = BAD
        junk[x < good, k] = GOOD
        junk[v.n_words < least, k] = NONE
    abuse = np.full((len(v.n_words), ABUSE_LABELLERS), GOOD, dtype=np.int8)
    hit = np.flatnonzero(_holds(v.features, lexicon) & (v.kinds != MEASURE))
    abuse[v.of[hit], v.kinds[hit]] = BAD
    _, one = np.unique(v.word[hit], return_index=True)
    abuse[np.bincount(v.of[hit[one]], minlength=len(v.n_words)) > 1, ABUSE_LABELLERS - 1] = BAD
    abuse[v.n_words == 0] = NONE
    return junk, abuse


def _pattern(v: np.ndarray) -> np.ndarray:
    return v.astype(np.int64) @ (3 ** np.arange(v.shape[1]))


def _unpattern(codes: np.ndarray, labellers: int) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(labellers)) % 3


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over [pattern, labeller] votes: the posterior of "bad" for each pattern, and the
    chances [class, labeller, vote]. Classes are told apart by the start: any bad vote points to "bad"."""
    bad = np.where((patterns == BAD).any(axis=1), 0.9, 0.05)
    bad[(patterns == NONE).all(axis=1)] = 0.05
    one_hot = np.eye(3)[patterns]
    for _ in range(rounds):
        chance, prior = [], []
        for p in (bad, 1 - bad):
            mass = counts * p
            prior.append(mass.sum() + 1)
            tally = np.einsum("p,plv->lv", mass, one_hot) + 0.1
            chance.append(tally / tally.sum(axis=1, keepdims=True))
        log = [np.log(prior[c]) + np.einsum("plv,lv->p", one_hot * (patterns != NONE)[:, :, None], np.log(chance[c])) for c in (0, 1)]
        bad = 1 / (1 + np.exp(np.clip(log[1] - log[0], -500, 500)))
    return bad, np.stack(chance)


@dataclass
class Scorer:
    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, v: View) -> np.ndarray:
        n = max(len(self.keys), 1)
        hit = np.flatnonzero(_holds(v.features, self.keys))
        # a feature counts once a document
        pairs = np.unique(v.of[hit].astype(np.int64) * n + np.searchsorted(self.keys, v.features[hit]))
        total = np.bincount(pairs // n, self.weights[pairs % n] if len(pairs) else None, minlength=len(v.n_words))
        out = 1 / (1 + np.exp(-np.clip(total + self.bias, -50, 50)))
        return np.where(v.n_words > 0, out, 0.0)


def train_scorer(docs: np.ndarray, features: np.ndarray, target: np.ndarray, rounds: int = 300, rate: float = 0.1, sparse: float = 1e-3) -> Scorer:
    """Logistic regression on soft labels over (document, feature) pairs, the classes weighted alike; features of few
    documents are left out, and ``sparse`` (an L1 weight) drops those that say little."""
    keys, column, n = np.unique(features, return_inverse=True, return_counts=True)
    common = n >= LEAST_DOCS
    keep = common[column]
    keys, column, docs = keys[common], (np.cumsum(common) - 1)[column[keep]], docs[keep]
    weights, bias = np.zeros(len(keys)), 0.0
    # the pairs once by document and once by feature, so that both sums are taken over stretches
    order = np.argsort(docs, kind="stable")
    of_doc, rows, row_starts = column[order].astype(np.int32), *np.unique(docs[order], return_index=True)
    order = np.argsort(column, kind="stable")
    of_key, key_starts = docs[order].astype(np.int32), np.searchsorted(column[order], np.arange(len(keys)))
    seen, seen_bias = np.full(len(keys), 1e-12), 1e-12
    share = np.clip(target.mean(), 1e-6, 1 - 1e-6)
    balance = (target / share + (1 - target) / (1 - share)) / 2
    for _ in range(rounds):
        total = np.zeros(len(target))
        if len(keys):
            total[rows] = np.add.reduceat(weights.astype(np.float32)[of_doc], row_starts)
        out = 1 / (1 + np.exp(-np.clip(total + bias, -50, 50)))
        error = balance * (target - out) / len(target)
        grad = np.add.reduceat(error.astype(np.float32)[of_key], key_starts).astype(np.float64) if len(keys) else weights
        seen += grad**2
        step = rate / np.sqrt(seen)
        weights += step * grad
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * sparse, 0)
        seen_bias += error.sum() ** 2
        bias += rate * error.sum() / np.sqrt(seen_bias)
    return Scorer(keys[weights != 0], weights[weights != 0], float(bias))


# ---- on Spark


def _sampled(table: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """About ``rows`` rows, by a hash of the columns; all if there are no more."""
    n = table.count()
    return table if n <= rows else table.filter(F.pmod(F.xxhash64(*columns, F.lit(17)), F.lit(1 << 30)) < int(rows / n * (1 << 30)))


def mine_lexicon(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Hashes of the terms that the abusive documents of a bounded sample hold far more often than the others."""
    sample = _sampled(labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")), ["doc_id"], LABELLED_ROWS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tk.as_texts(batch["text"])
            toxic = batch["toxic"].to_numpy(zero_copy_only=False) > 0
            for lo, hi in tk.slices(texts):
                w = tk.words(tk.cut(texts, lo, hi), tk.LETTERS_DIGITS, lower=True)
                terms, _, word = term_hashes(w)
                of = w.docs()[word]
                order = np.lexsort((of, terms))
                terms, of = terms[order], of[order]
                new = np.ones(len(terms), dtype=bool)
                new[1:] = (terms[1:] != terms[:-1]) | (of[1:] != of[:-1])
                keys, column = np.unique(terms[new], return_inverse=True)
                bad = np.bincount(column, toxic[lo:hi][of[new]], minlength=len(keys)).astype(np.int64)
                total = np.bincount(column, minlength=len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(bad), pa.array(total)], names=["term", "bad", "total"])

    # the sample is bounded by LABELLED_ROWS (id and flag only), so it is copied to the documents
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
    size = sample.agg(F.sum((F.col("toxic") > 0).cast("int")).alias("bad"), F.count("*").alias("n")).first()
    n_bad, n_good = size.bad or 0, size.n - (size.bad or 0)
    counted = texts.mapInArrow(count, "term long, bad long, total long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("total").alias("total"))
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("total") - F.col("bad") + 0.5) / (n_good + 1))
    found = counted.filter(F.col("bad") >= LEAST_DOCS).withColumn("odds", odds).filter(F.col("odds") >= ODDS)
    mined = [r.term for r in found.orderBy(F.desc("odds"), F.desc("bad"), "term").limit(LEXICON).collect()]
    return np.sort(np.array(mined, dtype=np.int64).view(np.uint64))


def vote_patterns(docs: DataFrame, lexicon: np.ndarray) -> tuple[tuple, tuple]:
    """(patterns, counts) over all documents for junk and for abuse; their number is bounded by the labellers."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tk.as_texts(batch["text"])
            for lo, hi in tk.slices(texts):
                out = []
                for question, v in enumerate(votes(view(tk.cut(texts, lo, hi)), lexicon)):
                    codes, n = np.unique(_pattern(v), return_counts=True)
                    out += [(question, int(c), int(k)) for c, k in zip(codes, n, strict=True)]
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["question", "pattern", "n"])

    rows = docs.select("text").mapInArrow(scan, "question int, pattern long, n long").groupBy("question", "pattern").agg(F.sum("n").alias("n")).collect()
    out = []
    for question, labellers in enumerate((len(JUNK_LABELLERS), ABUSE_LABELLERS)):
        own = sorted((r.pattern, r.n) for r in rows if r.question == question)
        codes = np.array([p for p, _ in own], dtype=np.int64)
        out.append((_unpattern(codes, labellers), np.array([n for _, n in own], dtype=np.float64), codes))
    return out[0], out[1]


@dataclass
class Model:
    junk: Scorer
    abuse: Scorer
    accuracies: list[np.ndarray]


def train(docs: DataFrame, labels: DataFrame) -> Model:
    lexicon = mine_lexicon(docs, labels)
    posteriors, accuracies = [], []
    for patterns, counts, codes in vote_patterns(docs, lexicon):
        if len(codes):
            bad, chance = label_model(patterns, counts)
            accuracies.append(chance)
        else:
            bad = np.zeros(0)
        posteriors.append((codes, bad))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tk.as_texts(batch["text"])
            for lo, hi in tk.slices(texts):
                v = view(tk.cut(texts, lo, hi))
                targets = [bad[np.searchsorted(codes, _pattern(x))] for x, (codes, bad) in zip(votes(v, lexicon), posteriors, strict=True)]
                order = np.lexsort((v.features, v.of))
                of, features = v.of[order], v.features[order]
                new = np.ones(len(of), dtype=bool)
                new[1:] = (of[1:] != of[:-1]) | (features[1:] != features[:-1])
                of, features = of[new], features[new]
                cuts = np.searchsorted(of, np.arange(len(v.n_words) + 1))
                full = v.n_words > 0
                # features come in the order of their hashes: a long document gives those of least hash
                packed = [features[a : min(b, a + TRAIN_FEATURES)].tobytes() for a, b, f in zip(cuts[:-1], cuts[1:], full, strict=True) if f]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), pa.array(targets[0][full]), pa.array(targets[1][full])], names=["features", "junk", "abuse"])

    def fit(table: pa.Table) -> pa.Table:
        packed = [np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in table["features"]]
        of, features = np.repeat(np.arange(len(packed)), [len(p) for p in packed]), np.concatenate(packed)
        found = [train_scorer(of, features, table[c].to_numpy()) for c in ("junk", "abuse")]
        return pa.table({"question": pa.array([0, 1], pa.int32()), "keys": pa.array([s.keys.tobytes() for s in found], pa.binary()),
                         "weights": pa.array([s.weights.tobytes() for s in found], pa.binary()), "bias": pa.array([s.bias for s in found])})

    rows = _sampled(docs.select("doc_id", "text"), ["doc_id", "text"], TRAIN_ROWS).select("text").mapInArrow(sample, "features binary, junk double, abuse double")
    trained = rows.groupBy(F.lit("all").alias("_all")).applyInArrow(fit, "question int, keys binary, weights binary, bias double").collect()
    scorers = {r.question: Scorer(np.frombuffer(r["keys"], np.uint64), np.frombuffer(r.weights, np.float64), r.bias) for r in trained}
    empty = Scorer(np.zeros(0, np.uint64), np.zeros(0), -50.0)
    return Model(scorers.get(0, empty), scorers.get(1, empty), accuracies)


def classify(docs: DataFrame, model: Model, keep_columns: bool = False) -> DataFrame:
    """Documents with ``_junk`` and ``_abuse`` scores (0 to 1). Narrow: no shuffle."""
    junk, abuse = model.junk, model.abuse

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tk.as_texts(batch["text"])
            for lo, hi in tk.slices(texts):
                v = view(tk.cut(texts, lo, hi))
                part = batch.slice(lo, hi - lo)
                columns = [part.column(i) for i in range(part.num_columns - (0 if keep_columns else 1))]
                scores = [pa.array(np.round(s.score(v), 6)) for s in (junk, abuse)]
                yield pa.RecordBatch.from_arrays([*columns, *scores], names=[*part.schema.names[: len(columns)], "_junk", "_abuse"])

    if keep_columns:
        return docs.mapInArrow(scan, T.StructType(list(docs.schema.fields)).add("_junk", "double").add("_abuse", "double"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, _junk double, _abuse double")


def kept():
    return (F.col("_junk") < 0.5) & (F.col("_abuse") < 0.5)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = documents(spark, sf_dir)
    found = classify(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return found.select("doc_id", F.col("_junk").alias("junk_score"), F.col("_abuse").alias("abuse_score"), kept().alias("kept"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that a scorer rejects go, the others stay as they are."""
    ship(spark)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keeping_columns(docs, lambda plain: classify(plain, model, keep_columns=True).filter(kept()))
