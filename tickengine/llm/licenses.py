"""License scan with a positional rare-token index, in DataFrame operations only.

The templates (fixed licence lines, a bounded list) and the base phrases are indexed by their rarest words: document
frequencies are counted over the whole table, a template is posted under its ``RARE`` words of highest IDF and under the
rarest word of its mandatory key phrase (no place is accepted without that one, so none is missed), a base phrase under
its rarest word. A file looks up every index word that it holds. Every place of such a word, less the word's
place in the template, is a place where the template may start: equal places of several words fall together there. A
start is scored by the IDF share of the template's words that stand at their relative place, and counts if the share
is ``LEAST`` or more and the template's mandatory key phrase stands in full. A base phrase must stand in full. All of
it is one row per file: no shuffle but the counting of index words.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows are repeated in the result; a
null doc_id is kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickengine.llm.common import documents

RARE = 3
LEAST = 0.6

# The phrases of the contract and their labels
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

# Label, lines of the licence as words, the key phrase that must stand in them
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
     "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under "
     "the license is distributed on an as is basis without warranties or conditions of any kind", "apache org licenses license 2 0"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
     "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in "
     "the documentation and or other materials provided with the distribution", "redistributions in binary form must reproduce"),
    ("gpl-3.0", "it under the terms of the gnu general public license as published by the free software foundation either version 3 of "
     "the license or at your option any later version", "either version 3 of the license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
     "that the above copyright notice and this permission notice appear in all copies", "permission notice appear in all copies"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
     "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
     "publish distribute sublicense and or sell"),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at", "if a copy of the mpl"),
]

# what stands between words once A-Z is lower-cased; the Kelvin sign is kept from becoming an ASCII letter
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ÿ")))
    return F.array_remove(F.split(lowered, _BETWEEN, -1), "")


def _patterns(templates, base) -> list[dict]:
    found = [{"label": label, "words": line.split(), "base": True, "key": line.split()} for line, label in base]
    found += [{"label": label, "words": line.split(), "base": False, "key": key.split()} for label, line, key in templates]
    for p in found:
        n = len(p["key"])
        p["at"] = next(i for i in range(len(p["words"])) if p["words"][i : i + n] == p["key"])
    return found


def document_frequencies(words: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of files, and how many hold each word of the (bounded) vocabulary."""
    held = words.select(F.explode_outer(F.array_intersect("w", F.array(*map(F.lit, vocabulary)))).alias("word"))
    counts = {r.word: r["count"] for r in held.groupBy("word").count().collect()}
    counts.pop(None, None)
    return words.count(), counts


def _literal(patterns: list[dict], idf: dict[str, float]) -> Column:
    def one(p: dict) -> Column:
        weights = [idf[w] for w in p["words"]]
        return F.struct(
            F.lit(p["label"]).alias("label"), F.lit(p["base"]).alias("base"), F.array(*map(F.lit, p["words"])).alias("words"),
            F.array(*map(F.lit, weights)).alias("weights"), F.lit(float(sum(weights))).alias("total"),
            F.array(*map(F.lit, p["key"])).alias("key"), F.lit(p["at"]).alias("at"))

    return F.array(*map(one, patterns))


def _index(patterns: list[dict], idf: dict[str, float]) -> dict[str, list[tuple[int, int]]]:
    """Rare word -> (pattern, place of the word in it)."""
    index: dict[str, list[tuple[int, int]]] = {}
    for k, p in enumerate(patterns):
        order = lambda w: (-idf[w], w)
        rare = [min(p["key"], key=order)] if p["base"] else [*sorted(set(p["words"]), key=order)[:RARE], min(p["key"], key=order)]
        for i, w in enumerate(p["words"]):
            if w in rare:
                index.setdefault(w, []).append((k, i))
    return index


def scan_licenses(docs: DataFrame, templates=TEMPLATES, base=BASE) -> DataFrame:
    """Per file: doc_id, n_words, ``found`` (every accepted place: label, base, start, end, score) and ``best``."""
    patterns = _patterns(templates, base)
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), license_words(F.col("text")).alias("w"))
    vocabulary = sorted({w for p in patterns for w in p["words"]})
    n, counts = document_frequencies(words, vocabulary)
    idf = {w: round(math.log((n + 1) / (counts.get(w, 0) + 1)) + 1e-6, 9) for w in vocabulary}
    index = _index(patterns, idf)

    place = "array<struct<p:int,i:int>>"
    postings = F.create_map(*(x for w in sorted(index) for x in (
        F.lit(w), F.array(*(F.struct(F.lit(k).alias("p"), F.lit(i).alias("i")) for k, i in index[w])).cast(place))))
    table = _literal(patterns, idf)

    anchors = F.array_intersect("w", F.array(*map(F.lit, sorted(index))))
    hits = F.filter(F.transform("w", lambda w, i: F.when(F.array_contains("anchors", w), F.struct(w.alias("w"), i.alias("i")))),
                    lambda h: h.isNotNull())
    starts = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.transform(
        F.element_at(postings, h["w"]), lambda q: F.struct(q["p"].alias("p"), (h["i"] - q["i"]).alias("s"))))))

    def scored(c: Column) -> Column:
        t = F.get(table, c["p"])
        share = F.aggregate(F.sequence(F.lit(0), F.size(t["words"]) - 1), F.lit(0.0), lambda acc, k: acc + F.when(
            (c["s"] + k >= 0) & F.get("w", c["s"] + k).eqNullSafe(F.get(t["words"], k)), F.get(t["weights"], k)).otherwise(0.0))
        from_key = c["s"] + t["at"]
        key = (from_key >= 0) & F.slice("w", F.greatest(from_key + 1, F.lit(1)), F.size(t["key"])).eqNullSafe(t["key"])
        return F.struct(t["label"].alias("label"), t["base"].alias("base"), c["s"].alias("start"), (c["s"] + F.size(t["words"])).alias("end"),
                        F.round(F.least(share / t["total"], F.lit(1.0)), 6).alias("score"), key.alias("key"))

    none = F.array().cast("array<struct<label:string,base:boolean,start:int,end:int,score:double,key:boolean>>")
    some = words.withColumn("anchors", anchors).withColumn("hits", F.when(F.size("anchors") > 0, hits))
    some = some.select("doc_id", F.size("w").cast("long").alias("n_words"),
                       F.when(F.size("hits") > 0, F.transform(starts, scored)).otherwise(none).alias("places"))
    accepted = F.filter("places", lambda x: x["key"] & (x["base"] | (x["score"] >= LEAST)))
    best = F.coalesce(F.array_max(F.transform("places", lambda x: x["score"])), F.lit(0.0))
    return some.select("doc_id", "n_words", accepted.alias("found"), best.alias("best"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(documents(spark, sf_dir))
    own = F.filter("found", lambda x: x["base"])
    starts = F.transform(own, lambda x: x["start"].cast("long"))
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda x: x["label"]))), ",")
    return found.select("doc_id", "n_words", F.size(own).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                        F.array_max(starts).alias("last_word"), labels(own).alias("base_labels"), labels("found").alias("labels"),
                        F.col("best").alias("score"))


def _sql() -> str:
    patterns = _patterns(TEMPLATES, BASE)
    rows = ", ".join(f"({k}, '{p['label']}', {p['base']}, {p['words']}, {p['key']}, {p['at']})" for k, p in enumerate(patterns))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM documents),
pat(k, label, base, words, phrase, koff) AS (VALUES {rows}),
pw AS (SELECT k, base, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i FROM pat),
dw AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d),
hits AS (SELECT * FROM dw SEMI JOIN pw USING (word)),
df AS (SELECT word, count(DISTINCT r) AS n FROM hits GROUP BY word),
idf AS (SELECT word, round(ln(((SELECT count(*) FROM d) + 1) / (coalesce(n, 0) + 1)) + 1e-6, 9) AS x
  FROM (SELECT DISTINCT word FROM pw) LEFT JOIN df USING (word)),
rare AS (SELECT k, word FROM (SELECT k, base, word, row_number() OVER (PARTITION BY k ORDER BY x DESC, word) AS o
  FROM (SELECT DISTINCT k, base, word FROM pw) JOIN idf USING (word)) WHERE o <= CASE WHEN base THEN 1 ELSE {RARE} END
  UNION SELECT k, word FROM (SELECT k, word, row_number() OVER (PARTITION BY k ORDER BY x DESC, word) AS o
  FROM (SELECT DISTINCT k, unnest(phrase) AS word FROM pat) JOIN idf USING (word)) WHERE o = 1),
post AS (SELECT k, word, i FROM pw SEMI JOIN rare USING (k, word)),
starts AS (SELECT DISTINCT h.r, k, h.i - p.i AS s FROM hits h JOIN post p ON p.word = h.word),
total AS (SELECT k, sum(x) AS t FROM pw JOIN idf USING (word) GROUP BY k),
share AS (SELECT st.r, st.k, st.s, round(least(coalesce(sum(x) FILTER (h.word IS NOT NULL), 0) / any_value(t), 1.0), 6) AS score
  FROM starts st JOIN pw ON pw.k = st.k JOIN idf USING (word) JOIN total ON total.k = st.k
  LEFT JOIN hits h ON h.r = st.r AND h.i = st.s + pw.i AND h.word = pw.word GROUP BY ALL),
places AS (SELECT r, label, base, s, score, s + koff >= 0 AND w[s + koff + 1 : s + koff + len(phrase)] = phrase AS is_key
  FROM share JOIN pat USING (k) JOIN d USING (r)),
found AS (SELECT * FROM places WHERE is_key AND (base OR score >= {LEAST})),
lab AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels, string_agg(label, ',' ORDER BY label) FILTER (b) AS base_labels
  FROM (SELECT r, label, bool_or(base) AS b FROM found GROUP BY r, label) GROUP BY r),
own AS (SELECT r, count(*) AS n, min(s) AS a, max(s) AS b FROM found WHERE base GROUP BY r),
best AS (SELECT r, max(score) AS score FROM places GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(a AS BIGINT) AS first_word,
  CAST(b AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN lab USING (r) LEFT JOIN own USING (r) LEFT JOIN best USING (r)
"""


OP9_SQL = _sql()
