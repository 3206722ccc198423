"""Packing, token counts, personal data, licences, quality and the pipeline against plain Python."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import duck, plain, rows
from tickengine.llm import licenses, pii, quality
from tickengine.llm import textkit as tk
from tickengine.llm.packing import END_ID, _encoder, first_fit, pack, packing_stage, token_pieces
from tickengine.llm.tokencount import PieceCounter, _counter, token_counts

DATA = [r[:2] for r in rows()]


# ---- packing


def ids_of(text):
    return np.append(_encoder("byte_bpe_50k", None)(text or ""), np.uint32(END_ID)).astype("<u4")


@pytest.mark.parametrize("length", [16, 64, 2048])
def test_packing_is_an_exact_round_trip(docs, length):
    packed = pack(token_pieces(docs, length), length, group_pieces=40).toPandas()
    assert (packed.length <= length).all() and (packed.length > 0).all()
    want = sorted((repr(d), s, min(length, len(i) - s), zlib.crc32(i[s : s + length].tobytes()), len(i))
                  for d, t in DATA for i in [ids_of(t)] for s in range(0, len(i), length))
    got = sorted((repr(None if np.isnan(float(r.doc_id)) else int(r.doc_id)), r.start, r.length, r.ids_crc32, r.doc_tokens)
                 for r in packed.fillna({"doc_id": float("nan")}).itertuples()) if packed.doc_id.isna().any() else None
    assert got is None or got == want
    for _, sequence in packed.sort_values("offset").groupby("sequence_id"):
        assert sequence.offset.tolist() == [0, *np.cumsum(sequence.length)[:-1]] and sequence.length.sum() <= length


def test_packing_pads_little(docs):
    packed = pack(token_pieces(docs, 64), 64).toPandas()
    assert packed.length.sum() / (64 * packed.sequence_id.nunique()) > 0.97


def test_packing_deals_pieces_of_one_id(spark, docs):
    data = [(d, f"text {k} of one id") for d in (None, 1) for k in range(200)]
    packed = pack(token_pieces(spark.createDataFrame(data, "doc_id long, text string"), 64), 64, group_pieces=40)
    sizes = [r["count"] for r in packed.groupBy(F.shiftright("sequence_id", 32).alias("g")).count().collect()]
    assert sum(sizes) == len(data) and max(sizes) < 100


def test_first_fit_matches_a_plain_scan():
    rnd = np.random.default_rng(0)
    for n in (0, 1, 2, 50, 400):
        sizes = sorted(rnd.integers(1, 100, n).tolist(), reverse=True)
        room, want = [], []
        for s in sizes:
            k = next((i for i, r in enumerate(room) if r >= s), len(room))
            if k == len(room):
                room.append(100)
            want.append((k, 100 - room[k]))
            room[k] -= s
        assert list(zip(*first_fit(sizes, 100), strict=True)) == want


def test_ids_are_those_of_the_json_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    json_tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["a <|endoftext|> b", "naïve  café\n\n\n x", "", " " * 40 + "x", "日本語 😀 " * 5, *(t or "" for _, t in DATA)]:
        assert _encoder("byte_bpe_50k", None)(text).tolist() == json_tokenizer.encode(text, add_special_tokens=False).ids


# ---- token counts


def greedy(word: bytes, pieces: set[bytes]) -> int:
    at = n = 0
    while at < len(word):
        at += next(k for k in range(len(word) - at, 0, -1) if word[at : at + k] in pieces)
        n += 1
    return n


def test_pieces_are_counted_like_greedy_longest_match():
    rnd = np.random.default_rng(4)
    pieces = [bytes([b]) for b in range(256)] + [bytes(rnd.choice(list(b" abc"), rnd.integers(2, 7)).tolist()) for _ in range(60)]
    counter = PieceCounter(pieces)
    words = [bytes(rnd.choice(list(b"abcd"), rnd.integers(1, 200)).tolist()) for _ in range(300)]
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) for w in words])
    want = [greedy(b" " + w, set(pieces)) for w in words]
    assert counter.counts(data, ends - [len(w) for w in words], ends).tolist() == want
    assert [counter.count(b" " + w) for w in words] == want


def test_token_counts(docs, no_docs):
    import base64

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        pieces = {base64.b64decode(line.split()[0]) for line in f}
    want = []
    for d, t in DATA:
        each = [greedy(b" " + w.encode(), pieces) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        want.append((d, max(each, default=None), sum(each), len(each)))
    assert plain(token_counts(docs)) == sorted(want, key=repr)
    assert token_counts(no_docs).collect() == []
    with pytest.raises(ValueError):
        PieceCounter([b"a"])
    assert _counter("byte_bpe_50k.tiktoken", None).count(b" the") == 1


# ---- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def patterns(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_patterns_follow_their_expressions():
    rnd = np.random.default_rng(9)
    alphabet = list("aZ09.@+-() _%é") + ["4111 1111 1111 1111", "1.2.3.4", "a@b.co", "+12 (345) 678-901", "4111111111111111", "300.1.1.1", "00255.1.1.1"]
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet, rnd.integers(1, 30)))
        assert pii.pattern_spans(text) == patterns(text), text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 100_000, "9 " * 150_000 + "@x.y"):
        pii.pattern_spans(text)


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(pii.labelled_table(spark))


def test_field_on_sentences_it_has_not_seen(field):
    good = [("Reach her at (415) 555-0134 before noon", "phone", "(415) 555-0134"), ("the host 172.16.4.20, is down", "ip", "172.16.4.20"),
            ("charge 4716-2210-5188-5662 now", "card", "4716-2210-5188-5662"), ("cc dan.roe77@corp.example.org please", "email", "dan.roe77@corp.example.org")]
    for text, kind, span in good:
        at = text.index(span)
        assert [(k, a, b) for _, k, a, b in pii._field_spans(field, tk.as_texts(pa.array([text])))] == [(kind, at, at + len(span))], text
    for text in ("In 1987 it sold 4500 units", "open from 12:30 to 14:00", "password=e90d80a2fd8e1f8fde of", "version 3 of 4", "no digits here"):
        assert pii._field_spans(field, tk.as_texts(pa.array([text]))) == []


def test_field_words_beside_a_pattern_stay(monkeypatch):
    text = "é 212-555-0100, +1 (415) 555-1234, 415-555-9999, 415-555-8888; (+1 415 555 7777)."
    cut = [(text.index(v), text.index(v) + len(v)) for v in ("212-555-0100", "415-555-9999, 415-555-8888;")]
    texts = tk.as_texts(pa.array(["none", text]))
    a, b = (4 + len(text[:i].encode()) for i in (text.index("212"), len(text)))
    monkeypatch.setattr(pii, "_field_spans", lambda field, texts: [(1, "phone", a, b)])
    (_, _), (base, added) = pii._document_spans(None, texts)
    assert base == patterns(text) and len(base) == 2
    assert added == [("phone", cut[0][0], cut[0][1]), ("phone", cut[1][0], cut[1][1] - 1)]


def test_viterbi_is_the_best_of_all_labellings():
    from itertools import product

    rnd = np.random.default_rng(1)
    f = pii.Field(rnd.normal(size=(3, pii.N_LABELS)), rnd.normal(size=(pii.N_LABELS, pii.N_LABELS)))
    lengths = np.array([1, 4, 2, 5])
    x = rnd.normal(size=(12, 3))
    got, at = f.decode(x, lengths), 0
    for n in lengths.tolist():
        s = x[at : at + n] @ f.weights
        best = max(product(range(pii.N_LABELS), repeat=n), key=lambda y: sum(s[i, y[i]] for i in range(n)) + sum(f.moves[a, b] for a, b in zip(y, y[1:], strict=False)))
        assert tuple(got[at : at + n]) == best
        at += n


def test_find_and_mask(spark, docs, no_docs, field):
    data = [(1, "é mail a.b@c.org or +12 (345) 678-901!"), (2, None), (3, ""), (4, "ip 1.2.3.4, é 4111 1111 1111 1111"), (5, "nothing"), (None, "x@y.zz")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    for r in pii.find_private(df, field).collect():
        text = dict(data)[r.doc_id] or ""
        base = [(s.kind, s.start, s.end) for s in r._spans if s.pattern]
        assert base == patterns(text)
    got = {r.doc_id: r.text for r in pii.private_stage(spark, df, "").collect()}
    assert got[1] == "é mail [EMAIL] or [PHONE]!" and got[4] == "ip [IP], é [CARD]" and got[2] is None and got[3] == "" and got[5] == "nothing"
    out = pii.private_stage(spark, docs, "")
    assert out.columns == docs.columns and out.count() == docs.count() and pii.private_stage(spark, no_docs, "").count() == 0
    changed = out.filter(F.length("text") != F.col("n_chars")).count()
    assert changed == 0


# ---- licences


def test_licenses(spark, docs, no_docs):
    extra = [(1, "x Licensed under CC BY-NC 4.0. and all rights reserved"), (2, "Released under the MIT License."), (3, "cc by cc by"), (4, "CC\nBY"), (5, None), (6, "cc 1 by"),
             (7, "licensed under the gnu general public license, version 3"), (8, "general public licenses"), (9, "Key İ cc by"), (10, "the mit license")]
    df = spark.createDataFrame(extra, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    found = licenses.scan_licenses(df)
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, []).append(r)
    for d, t in extra + DATA:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        want = sorted((label, i) for phrase, label in licenses.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())
        assert any(sorted((x.label, x.start) for x in r.found if x.base) == want and r.n_words == len(w) for r in got[d]), (d, t)
    labels = {d: {x.label for r in got[d] for x in r.found} for d in range(1, 11)}
    assert labels[1] >= {"cc-by", "cc-by-nc", "reserved"} and "mit" in labels[2] and not labels[10] and "gpl-3.0" in labels[7] and not labels[5]
    assert licenses.scan_licenses(no_docs).collect() == []


def test_a_file_of_all_licences_has_every_label(spark, docs):
    lines = [line for _, line, _ in licenses.TEMPLATES]
    data = [(0, " . x ".join(lines)), (1, "none of these"), *((10 + k, line) for k, line in enumerate(lines))]
    for r in licenses.scan_licenses(spark.createDataFrame(data, "doc_id long, text string")).collect():
        if r.doc_id == 0:
            assert {x.label for x in r.found if not x.base} == {label for label, _, _ in licenses.TEMPLATES} and r.best == 1.0


def test_an_altered_line_is_reached_by_its_key_phrase(spark):
    """The three rarest words of the line are others; its key phrase and most of its weight stand."""
    line = next(line for label, line, _ in licenses.TEMPLATES if label == "isc")
    rest = [(k, "permission to use modify or this software for purpose with without fee is hereby granted and") for k in range(20)]
    data = [(100, line.replace("copy", "x").replace("distribute", "y").replace("any", "z"))]
    found = licenses.scan_licenses(spark.createDataFrame(rest + data, "doc_id long, text string"), templates=[t for t in licenses.TEMPLATES if t[1] == line])
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[100].best > 0 and all(not rows[k].found for k, _ in rest)
    assert bool(rows[100].found) == (rows[100].best >= licenses.LEAST)
    # all words in the same number of files: the line keeps 19 of 22 words
    same = licenses.scan_licenses(spark.createDataFrame([*data, (1, line)], "doc_id long, text string")).collect()
    assert all("isc" in {x.label for x in r.found} for r in same)


def test_query_and_sql_agree_on_a_file_of_all_licences(spark, tmp_path):
    lines = [line for _, line, _ in licenses.TEMPLATES]
    data = [(0, " . x ".join(lines)), (1, " and ".join(reversed(lines))), (2, "none"), (3, None), (4, lines[5].replace("copy", "x").replace("any", "z"))]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = duck(licenses.OP9_SQL, documents=[{"doc_id": d, "text": t} for d, t in data])
    assert plain(licenses.op9_licenses(spark, str(tmp_path))) == want


def test_sql_of_licenses(spark, docs, tmp_path):
    path = str(tmp_path / "documents.parquet")
    docs.select("doc_id", "text").write.parquet(path)
    want = duck(licenses.OP9_SQL, documents=[{"doc_id": d, "text": t} for d, t in DATA])
    assert plain(licenses.op9_licenses(spark, str(tmp_path))) == want


# ---- quality


def test_label_model_finds_the_accuracies():
    rnd = np.random.default_rng(6)
    truth = rnd.random(20000) < 0.2
    hit, alarm = [0.9, 0.6, 0.7, 0.5], [0.02, 0.05, 0.01, 0.1]
    v = np.stack([np.where(rnd.random(20000) < np.where(truth, h, a), quality.BAD, quality.GOOD) for h, a in zip(hit, alarm, strict=True)], axis=1)
    codes, n = np.unique(quality._pattern(v), return_counts=True)
    bad, chance = quality.label_model(quality._unpattern(codes, 4), n.astype(float))
    assert np.abs(chance[0, :, quality.BAD] - hit).max() < 0.05 and np.abs(chance[1, :, quality.BAD] - alarm).max() < 0.05
    assert ((bad[np.searchsorted(codes, quality._pattern(v))] > 0.5) == truth).mean() > 0.96


def test_held_out_accuracy(spark, docs):
    """The lexicon sees the labels of even documents; the odd ones judge the result."""
    sf = "/root/testdata/sf0.1"
    table, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(table, labels.filter("doc_id % 2 = 0"))
    found = quality.classify(table, model).withColumn("kept", quality.kept())
    found = found.join(labels.filter("doc_id % 2 = 1"), "doc_id").toPandas()
    clean, junk = found[(found.quality == 1) & (found.toxic == 0)], found[found.quality == 0]
    assert clean.kept.mean() > 0.99 and junk.kept.mean() < 0.05 and found[found.toxic == 1].kept.mean() <= 0.1
    print("held out:", len(clean), (~clean.kept).sum(), len(junk), (~junk.kept).sum(), (found.toxic == 1).sum(), (~found[found.toxic == 1].kept).sum())


def test_scorer_is_the_least_of_its_loss():
    """A plain gradient of the same weighted loss, over a dense matrix, finds no lower value nearby."""
    rnd = np.random.default_rng(3)
    dense = rnd.random((400, 12)) < 0.3
    target = 1 / (1 + np.exp(-(3 * dense[:, 0] - 2 * dense[:, 1] + dense[:, 2] - 1)))
    docs, column = np.nonzero(dense)
    keys = np.sort(rnd.integers(1, 1 << 60, 12).astype(np.uint64))
    found = quality.train_scorer(docs, keys[column], target, rounds=3000, sparse=0.0)
    assert list(found.keys) == list(keys)
    share = target.mean()
    balance = (target / share + (1 - target) / (1 - share)) / 2

    def gradient(weights, bias):
        error = balance * (target - 1 / (1 + np.exp(-(dense @ weights + bias)))) / len(target)
        return np.append(dense.T @ error, error.sum())

    weights, bias = np.zeros(12), 0.0
    for _ in range(20000):
        g = gradient(weights, bias)
        weights, bias = weights + g[:-1], bias + g[-1]
    assert np.abs(found.weights - weights).max() < 0.05 and abs(found.bias - bias) < 0.05


def test_quality_query_is_its_scorers_on_every_row(spark, docs, tmp_path):
    """op6_quality: one row a document, the scores those of a scorer run by hand over the same features, texts without words kept."""
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(d, 1, d % 2) for d in range(12)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = quality.op6_quality(spark, str(tmp_path)).collect()
    assert len(rows) == docs.count()
    model = quality.train(docs.select("doc_id", "text"), spark.read.parquet(str(tmp_path / "labels.parquet")))
    texts = [r.text for r in docs.collect()]
    want = []
    for t in texts:
        v = quality.view(quality.tk.as_texts(quality.pa.array([t], quality.pa.string())))
        for s in (model.junk, model.abuse):
            own = set(v.features.tolist())
            total = s.bias + sum(w for k, w in zip(s.keys.tolist(), s.weights.tolist(), strict=True) if k in own)
            want.append(round(float(1 / (1 + np.exp(-np.clip(total, -50, 50)))), 6) if v.n_words[0] else 0.0)
    got = sorted((r.junk_score, r.abuse_score, r.kept) for r in rows)
    assert np.allclose([x[:2] for x in got], sorted(zip(want[::2], want[1::2], strict=True)), atol=2e-6)
    assert all(k == (j < 0.5 and a < 0.5) for j, a, k in got)


def test_null_ids_are_sampled_by_their_texts(spark):
    rows = spark.range(20000).selectExpr("if(id % 4 = 0, id, null) AS doc_id", "concat('t', id) AS text")
    found = quality._sampled(rows, ["doc_id", "text"], 2000)
    assert 1700 < found.count() < 2300 and 1200 < found.filter("doc_id IS NULL").count() < 1800


def test_quality_stage_takes_any_table(spark, docs, no_docs, tmp_path):
    spark.createDataFrame([(5, None, None), (None, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = quality.quality_stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    empty = [r for r in out.collect() if not (r.text or "").strip()]
    assert len(empty) == 3
    assert quality.quality_stage(spark, no_docs, str(tmp_path)).collect() == []


# ---- pipeline


def test_pipeline_stages_in_turn(spark):
    """Each stage on what its predecessor kept, at the smallest size, against plain Python."""
    from tests.llm.test_pairs import brute_hits, brute_near

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "near duplicates", "benchmark decontamination", "personal data", "packing"]
    tables, at = [docs], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf).cache()
        assert at.columns == docs.columns
        tables.append(at)
    texts = [{r.doc_id: r.text for r in t.collect()} for t in tables]
    assert set(texts[1]) < set(texts[0])
    assert set(texts[2]) == {d for c, d, kept, _ in brute_near(list(texts[1].items()), 5) if kept}
    assert set(texts[3]) == {d for bad, d, *_ in brute_hits(list(texts[2].items()), items) if not bad}
    assert set(texts[4]) == set(texts[3])
    for d, text in texts[4].items():
        assert not EMAIL.search(text)
        assert (text == texts[3][d]) == (not patterns(texts[3][d]) and text == texts[3][d])
    packed = corpus_pipeline.run(spark, sf).toPandas()
    ids = {d: ids_of(t) for d, t in texts[4].items()}
    assert packed.groupby("doc_id").length.sum().to_dict() == {d: len(i) for d, i in ids.items()}
    for r in packed.itertuples():
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert packing_stage(spark, docs.limit(0), sf).collect() == []


def test_every_query_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)

