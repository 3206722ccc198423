"""Small shared pieces: sizing from counts, and keeping a table's other columns out of the way."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ratio(amount: int, per: int) -> int:
    return max(1, -(-int(amount) // int(per)))


def keeping_columns(docs: DataFrame, work: Callable[[DataFrame], DataFrame], own: tuple[str, ...] = ("doc_id", "text", "n_chars")) -> DataFrame:
    """``work`` on the documents with every column but ``own`` renamed out of the way, then their columns as before:
    whatever else a table holds cannot clash with the columns that ``work`` adds."""
    plain = {c: c if c in own else f"c{i}" for i, c in enumerate(docs.columns)}
    done = work(docs.select(*(F.col(f"`{c}`").alias(to) for c, to in plain.items())))
    return done.select(*(F.col(to).alias(c) for c, to in plain.items()))
