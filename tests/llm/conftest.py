import random

import pytest
from pyspark.sql import functions as F

from tickengine.session import ship

WORDS = "the of and re inter license cc by general public all rights reserved moron it's x1 Ünder co-op EL.. 42 +1".split()


def rows(seed: int = 3, n: int = 60) -> list[tuple]:
    """Small documents that share passages: nulls, empty texts, repeated rows and ids, copies, near copies, a long
    text, a null id."""
    rnd = random.Random(seed)
    passages = [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(8, 40))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [rnd.choice(passages) if rnd.random() < 0.6 else " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 30)) for _ in range(rnd.randint(1, 25)))
                 for _ in range(rnd.randint(1, 4))]
        out.append((1000 - 7 * i if i % 3 else i, rnd.choice([" ", "\n", "  ", "\t"]).join(parts)))
    out += [(5000, None), (5001, ""), (5002, " \n "), (5003, "short one"), (5003, "short one"), (None, passages[0]), (None, passages[0])]
    out += [(6000 + k, out[5][1]) for k in range(5)] + [(out[7][0], out[8][1]), out[9], out[9]]
    near = [f"w{k}" for k in range(60)]
    out += [(7000 + k, " ".join(near[:k] + ["edit"] + near[k + 1 :])) for k in range(0, 60, 7)]
    out.append((8000, " ".join(f"long{k % 977} {passages[k % 6]}" for k in range(400))))
    return [(d, t, "en", f"s{(d or 0) % 3}", len(t or ""), "clash") for d, t in out]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slice string"


@pytest.fixture(scope="session")
def docs(spark):
    """The rows, with extra columns whose names the operators use inside."""
    ship(spark)
    df = spark.createDataFrame(rows(), SCHEMA)
    for name in ("text_hash", "sig", "part", "_n_hit", "_junk", "_spans", "_text_hash", "_id", "c0", "first_id"):
        df = df.withColumn(name, F.lit(name))
    return df


@pytest.fixture(scope="session")
def no_docs(spark, docs):
    return spark.createDataFrame([], docs.schema)


def plain(df) -> list[tuple]:
    """Rows as tuples with the columns by name, sorted."""
    names = sorted(df.columns)
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def duck(sql: str, **tables) -> list[tuple]:
    """The SQL over rows given as lists of dicts."""
    import duckdb
    import pyarrow as pa

    con = duckdb.connect()
    for name, table in tables.items():
        con.register(name, table if isinstance(table, pa.Table) else pa.Table.from_pylist(table))
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in got.fetchall()), key=repr)
