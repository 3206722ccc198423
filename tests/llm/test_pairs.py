"""Near-duplicates, benchmark hits and top-k search against plain Python."""

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import duck, plain, rows
from tickengine.llm import nearduplicates as nd
from tickengine.llm import textkit as tk
from tickengine.llm.components import components
from tickengine.llm.decontamination import OP2_SQL, ItemAutomaton, benchmark_hits, contaminated, decontamination_stage, item_words
from tickengine.llm.topk import OP8_SQL, scaled, search
from tickengine.session import materialize


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_near(data, width, percent=80):
    sets = [shingles(t, width) for _, t in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and data[i][0] is not None and data[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(data):
        c = None if d is None else least[find(i)]
        out.append((c, d, d is None or c == d, len(sets[i])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(docs, width):
    assert plain(nd.near_duplicates(docs, width).drop("text_hash")) == brute_near([r[:2] for r in rows()], width)


def test_long_lists_and_clusters_are_cut_into_blocks(docs, monkeypatch):
    monkeypatch.setattr(nd, "KEYED_ROWS", 3)
    monkeypatch.setattr(nd, "LIST_ROWS", 3)
    monkeypatch.setattr(nd, "CLUSTER_ROWS", 4)
    assert plain(nd.near_duplicates(docs, 4).drop("text_hash")) == brute_near([r[:2] for r in rows()], 4)


def test_near_copies_of_many_degrees(spark, docs):
    rnd = np.random.default_rng(5)
    base = [[f"b{k}_{i}" for i in range(120)] for k in range(4)]
    data = []
    for i in range(160):
        text = list(base[i % 4])
        for at in rnd.choice(120, rnd.integers(0, 7), replace=False):
            text[at] = f"e{rnd.integers(10**6)}"
        data.append((int(1000 - i), " ".join(text)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert plain(nd.near_duplicates(df, 4).drop("text_hash")) == brute_near(data, 4)


@pytest.mark.parametrize("edits", [3, 9])
def test_large_groups_of_near_copies(spark, monkeypatch, edits):
    """Copies of one text, each with words of its own: with few edits all are linked, with many only to the first text
    and some neighbours, so that lists and clusters of several blocks stay in pieces after their own blocks."""
    monkeypatch.setattr(nd, "KEYED_ROWS", 8)
    monkeypatch.setattr(nd, "LIST_ROWS", 8)
    monkeypatch.setattr(nd, "CLUSTER_ROWS", 8)
    rnd = np.random.default_rng(edits)
    base = [f"b{i}" for i in range(200)]
    data = [(0, " ".join(base)), (500, " ".join(base).upper())]
    for i in range(1, 70):
        text = list(base)
        for at in rnd.choice(200, edits, replace=False):
            text[at] = f"e{i}x{at}"
        data.append((i, " ".join(text)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert plain(nd.near_duplicates(df, 4).drop("text_hash")) == brute_near(data, 4)


def test_links_of_a_large_group_grow_with_its_members(spark, monkeypatch):
    """Every task gives a forest, and blocks that are connected already are not compared again."""
    given, edges = [], nd._links_table
    monkeypatch.setattr(nd, "LIST_ROWS", 8)
    rnd = np.random.default_rng(2)
    members = [sorted(rnd.integers(0, 1 << 60, 40).astype(np.uint64).tolist()) for _ in range(1)] * 64
    table = {"k1": [0] * 64, "k2": [0] * 64, "_i": [i // 8 for i in range(64)], "sig": [bytes([i]) for i in range(64)],
             "n_shingles": [40] * 64, "sketch": [np.array(m, dtype=np.uint64).tobytes() for m in members]}
    monkeypatch.setattr(nd, "_links_table", lambda links: given.append(len(links)) or edges(links))
    nd._cluster_lists(0.8, 64, ("k1", "k2", "_i"))(pa.table(table))
    assert given == [56]
    nd._cluster_lists(0.8, 64, ("k1", "k2"))(pa.table(table | {"comp": [bytes([i % 2]) for i in range(64)]}))
    assert given[1] == 1


def test_lists_of_the_same_classes_are_compared_once(spark, docs, monkeypatch, tmp_path):
    """Two near copies share most of their lists, which all hold the same two classes."""
    lists, folder = nd._cluster_lists, str(tmp_path)

    def counted(*args):
        work = lists(*args)

        def compare(table):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(table.num_rows))
            return work(table)

        return compare

    monkeypatch.setattr(nd, "_cluster_lists", counted)
    texts = [[f"{k}w{i}" for i in range(120)] for k in range(30)]
    data = [(k, " ".join(t)) for k, t in enumerate(texts)] + [(100 + k, " ".join(t[:60] + ["x"] + t[61:])) for k, t in enumerate(texts)]
    assert plain(nd.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 4).drop("text_hash")) == brute_near(data, 4)
    assert 60 <= sum(int(f.read_text()) for f in tmp_path.iterdir()) <= 300


def test_texts_that_are_wanted_are_found_by_their_bits(spark):
    texts = spark.range(-3000, 3000).selectExpr("id AS doc_id", "concat('t', id) AS text", "xxhash64(concat('t', id)) AS text_hash")
    wanted = texts.filter("doc_id % 7 = 0")
    got = nd._of_wanted(texts, wanted)
    assert got.columns == texts.columns
    ids = {r.doc_id for r in got.collect()}
    assert {i for i in range(-3000, 3000) if i % 7 == 0} <= ids and len(ids) < 900
    assert nd._of_wanted(texts, wanted.limit(0)).count() == 0


def thue_morse(n):
    bits = [0]
    while len(bits) < n:
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_of_a_doubling_structure_stay_apart(spark, docs):
    one, other = thue_morse(2048)
    tail = " ".join(f"t{i}" for i in range(20))
    data = [(1, one), (2, other), (3, f"{one} {tail}"), (4, f"{other} {tail}")]
    got = plain(nd.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 4).drop("text_hash"))
    assert got == brute_near(data, 4) and [r[0] for r in got] == [1, 2, 3, 3]  # the shared tail links 3 and 4
    sets = nd.word_sets(tk.as_texts(pa.array([one, other, one])), 4, tk.NOT_SPACE)
    assert sets[0].tolist() == sets[2].tolist() != sets[1].tolist()


def test_sql_of_near_duplicates():
    data = [r[:2] for r in rows() if r[0] is not None]
    assert duck(nd.OP10_SQL, documents=[{"doc_id": d, "text": t} for d, t in data]) == brute_near(data, 4)


def test_stage_keeps_one_of_each_group(spark, docs):
    kept = nd.near_duplicates_stage(spark, docs, "")
    assert kept.columns == docs.columns
    want = {d for c, d, k, _ in brute_near([r[:2] for r in rows()], 5) if k and d is not None}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(d for d in got if d is not None) == sorted(want) and got.count(None) == 2


def test_stage_keeps_rows_of_one_id_in_different_groups(spark, docs):
    text = {c: " ".join(f"{c}{k}" for k in range(30)) for c in "abc"}
    data = [(1, text["a"]), (1, text["b"]), (1, text["b"]), (1, text["c"] + " end"), (2, text["c"]), (2, text["a"]), (0, text["c"]),
            (1, ""), (1, ""), (1, " "), (1, None), (None, text["a"]), (None, text["a"])]
    kept = nd.near_duplicates_stage(spark, spark.createDataFrame(data, "doc_id long, text string"), "")
    want = [(1, text["a"]), (1, text["b"]), (0, text["c"]), (1, ""), (1, " "), (1, None), (None, text["a"]), (None, text["a"])]
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, want))


def test_components(spark, docs):
    rnd = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rnd.integers(0, 120, (90, 2))] + [(200 + i, 201 + i) for i in range(40)] + [(300, 300 + i) for i in range(1, 50)]
    root = {n: n for e in links for n in e}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: root[n] for n in linked}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_empty_tables(spark, no_docs):
    assert nd.near_duplicates(no_docs).collect() == []
    assert benchmark_hits(no_docs, spark.createDataFrame([], "item_id long, text string")).collect() == []
    none = scaled(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert search(none, none).collect() == []


# ---- benchmark

ITEMS = [(1, " ".join(r[1].split()[:20])) for r in rows() if r[1] and len(r[1].split()) > 25][:8]
ITEMS += [(11, "short one"), (12, "The OF and"), (12, "the of and"), (13, None), (14, "..."), (None, "x1 it"), (15, "re the of re"), (16, "of")]
ITEMS = [(None if i is None else i + 100 * k, t) for k, (i, t) in enumerate(ITEMS)]


def brute_hits(data, items):
    toks = lambda t: [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]
    windows = {}
    for i, t in items:
        w = toks(t)
        if i is not None:
            for p in range(max(1, len(w) - 12)) if w else ():
                windows.setdefault(tuple(w[p : p + 13]), set()).add(str(i))
    out = []
    for d, t in data:
        w, hit, ids = toks(t), set(), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                if (g := tuple(w[p : p + n])) in windows:
                    hit.update(range(p, p + n))
                    ids |= windows[g]
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((len(hit) > 0 and 20 * len(hit) >= len(w), d, digest, len(hit), len(ids), len(w)))
    return sorted(out, key=repr)


def columns(hits):
    from pyspark.sql import functions as F

    return hits.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"), F.size("_items").alias("n_items"),
                       F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


@pytest.mark.parametrize("shard_bytes", [1 << 20, 120])
def test_benchmark_hits(spark, docs, shard_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert plain(columns(benchmark_hits(docs, items, shard_bytes=shard_bytes))) == brute_hits([r[:2] for r in rows()], ITEMS)


def test_sql_of_benchmark_hits():
    got = duck(OP2_SQL, documents=[{"doc_id": r[0], "text": r[1]} for r in rows()], benchmark=[{"item_id": i, "text": t} for i, t in ITEMS])
    assert got == brute_hits([r[:2] for r in rows()], ITEMS)


def test_spans_and_stage(spark, docs, tmp_path):
    items = spark.createDataFrame([(1, "a b c"), (2, "c d")], "item_id long, text string")
    got = benchmark_hits(spark.createDataFrame([(1, "x A b! c d y c d")], "doc_id long, text string"), items).first()
    assert [(s.start, s.end) for s in got._spans] == [(1, 5), (6, 8)] and got._items == ["1", "2"]
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = decontamination_stage(spark, docs, str(tmp_path))
    clean = [d for bad, d, *_ in brute_hits([r[:2] for r in rows()], ITEMS) if not bad]
    assert left.columns == docs.columns and sorted(map(repr, clean)) == sorted(repr(r.doc_id) for r in left.collect())


def test_automaton_against_every_substring():
    rnd = np.random.default_rng(2)
    for _ in range(30):
        items = [(str(i), " ".join(rnd.choice(list("abc"), rnd.integers(1, 12)))) for i in range(4)]
        a = ItemAutomaton(items, width=4)
        text = item_words(" ".join(rnd.choice(list("abcd"), 60)))
        windows = {}
        for i, t in items:
            w = item_words(t)
            for p in range(max(1, len(w) - 3)):
                windows.setdefault(tuple(w[p : p + 4]), set()).add(i)
        want = {(p, p + n) for n in range(1, 5) for p in range(61 - n) if tuple(text[p : p + n]) in windows}
        spans: set = set()
        items_found: set = set()
        for chunk_start in [0]:
            s, it = a.stream(text)
            spans |= {(x + chunk_start, y + chunk_start) for x, y in s}
            items_found |= it
        assert spans == want
        assert items_found == {i for p, q in want for i in windows[tuple(text[p:q])]}


# ---- top k


def vectors():
    rnd = np.random.default_rng(3)
    out = [(int(i), [float(x) for x in rnd.integers(-2, 3, 6) / 7]) for i in range(230)]
    out += [(1000, None), (1050, []), (1100, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1150, [float("nan")] * 6), (1200, [float("inf")] * 6), (1250, [1.0, 2.0]),
            (None, [1.0] * 6), (50, out[50][1]), (51, out[51][1])]
    return out


def test_search(spark, docs, monkeypatch):
    from tickengine.llm import topk

    monkeypatch.setattr(topk, "SHARD_ROWS", 20)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 2)
    monkeypatch.setattr(topk, "FAN", 3)
    df = scaled(spark.createDataFrame([(*v, "x") for v in vectors()], "vec_id long, embedding array<float>, shard string"))
    got = plain(search(df.filter("vec_id % 50 = 0"), df))
    good = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(float))) for i, v in vectors()
            if i is not None and v and None not in v and np.isfinite(v).all()]
    want = []
    for q in {i for i, _ in good if i % 50 == 0}:
        x = next(v for i, v in good if i == q)
        hits = sorted((-int(x @ v), i) for i, v in good if i != q and len(v) == len(x))[:5]
        want += [(q, k + 1, -s, i) for k, (s, i) in enumerate(hits)]
    assert got == sorted(want, key=repr)


def test_search_broadcasts_neither_blocks_nor_shards(spark, docs):
    """Packed rows and their copies count as small in Spark's estimates, at any size."""
    df = materialize(scaled(spark.createDataFrame([(i, v) for i, v in vectors() if i is not None], "vec_id long, embedding array<float>")))
    found = search(df.filter("vec_id % 50 = 0"), df)
    assert found.count()
    plan = found._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_sql_of_search():
    import pyarrow as pa

    data = [v for k, v in enumerate(vectors()) if k < 230]
    table = pa.table({"vec_id": [i for i, _ in data], "embedding": pa.array([v for _, v in data], pa.list_(pa.float32()))})
    assert len(duck(OP8_SQL, embeddings=table)) == 25
