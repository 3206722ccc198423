"""Exact top-k search: tiled matrix products of query blocks and shards, partial selection in each tile, and a tree
of merges of the per-query top lists.

Vectors are packed into shards of bounded size by a hash of their id, queries into blocks likewise. Every (block,
shard) tile is one row of work; Spark deals the tiles out. A tile leaves ``k`` hits a query; a merge joins the lists
of ``FAN`` shards at most, level by level, so no task or group sees more than ``FAN * k`` entries of a query.

Defined cases: a vector that is null, empty, of another length than most, or holds a null or non-finite component
takes no part; rows that share a vec_id count as the query's own and are no candidates for it; repeated query rows
are answered once; ties go to the smaller vec_id; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickengine.llm.common import ratio
from tickengine.session import materialize, ship

SHARD_ROWS = 4096
BLOCK_ROWS = 1024
FAN = 64


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows that take part, with components floor(256 x). ``dim`` must agree between a query and a candidate."""
    x = F.col(vector_col)
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda v: v.cast("double")).alias("x"))
        .filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & ~F.exists("x", bad))
        .select("vec_id", F.transform("x", lambda v: F.floor(v * 256).cast("double")).alias("x"), F.size("x").alias("dim"))
    )


def _packed(rows: DataFrame, bin_col: str, bins: int, salt: Column) -> DataFrame:
    """One row per bin: ids and matrix as bytes."""

    def pack(table: pa.Table) -> pa.Table:
        ids = table["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        matrix = np.asarray(table["x"].combine_chunks().values if table.num_rows else [], dtype=np.float64)
        matrix = matrix.reshape(len(ids), -1)[order]
        return pa.table({bin_col: table[bin_col][:1], "dim": table["dim"][:1],
                         f"{bin_col}_ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                         f"{bin_col}_x": pa.array([matrix.tobytes()], pa.binary())})

    schema = f"{bin_col} long, dim int, {bin_col}_ids binary, {bin_col}_x binary"
    dealt = rows.withColumn(bin_col, F.pmod(salt, F.lit(bins)).cast("long"))
    return dealt.select("vec_id", "x", "dim", bin_col).groupBy(bin_col, "dim").applyInArrow(pack, schema)


def _tile(k: int):
    def tile(table: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        for row in table.to_pylist():
            q_ids, s_ids = (np.frombuffer(row[c], dtype="<i8") for c in ("block_ids", "shard_ids"))
            q, s = (np.frombuffer(row[c], dtype=np.float64).reshape(-1, row["dim"]) for c in ("block_x", "shard_x"))
            scores = q @ s.T
            scores[q_ids[:, None] == s_ids[None, :]] = -np.inf
            take = min(k, len(s_ids))
            # candidates stand in id order, so among equal scores the first ones are the smaller ids
            least = -np.partition(-scores, take - 1, axis=1)[:, take - 1 : take]
            above, equal = scores > least, scores == least
            room = take - above.sum(axis=1, keepdims=True)
            at_q, at_s = np.nonzero((above | (equal & (np.cumsum(equal, axis=1) <= room))) & np.isfinite(scores))
            for column, part in zip(out, (q_ids[at_q], s_ids[at_s], scores[at_q, at_s], np.full(len(at_q), row["shard"])), strict=True):
                column.append(part)
        got = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.table({"query_id": pa.array(got[0].astype(np.int64)), "vec_id": pa.array(got[1].astype(np.int64)),
                         "score": pa.array(got[2].astype(np.int64)), "node": pa.array(got[3].astype(np.int64))})

    return tile


def search(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` candidates of largest inner product for every query. Both inputs come from :func:`scaled` and are
    counted, so they should be written tables."""
    shards, blocks = ratio(vectors.count(), SHARD_ROWS), ratio(queries.count(), BLOCK_ROWS)
    by_id = F.xxhash64("vec_id")
    shard_rows = _packed(vectors, "shard", shards, by_id)
    block_rows = _packed(queries.dropDuplicates(["vec_id", "x"]), "block", blocks, by_id)
    # every query block meets every shard: the blocks are copied to the shards, as packed rows
    copies = block_rows.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    # the same plan at every size: Spark takes packed rows and copies for far smaller than they are, so neither side is broadcast
    tiles = copies.hint("merge").join(shard_rows, ["shard", "dim"])
    hits = tiles.groupBy("shard", "block", "dim").applyInArrow(_tile(k), "query_id long, vec_id long, score long, node long")
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
    while True:
        merged = hits.withColumn("node", F.floor(F.col("node") / FAN)).groupBy("query_id", "node").agg(best.alias("top"))
        shards = ratio(shards, FAN)
        if shards == 1:
            break
        hits = merged.select("query_id", "node", F.inline("top")).select("query_id", "node", "vec_id", (-F.col("s")).alias("score"))
    ranked = merged.select("query_id", F.posexplode("top").alias("place", "hit"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                         (-F.col("hit.s")).alias("score"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    vectors = materialize(scaled(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    return search(vectors.filter(F.col("vec_id") % 50 == 0), vectors)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
