"""From raw documents to training sequences, in five stages of operators of ``tickengine.llm``:

quality classifier (rejected documents go), MinHash near-duplicates (one document of each group stays), benchmark
decontamination (contaminated documents go), personal data (masked in the texts), packing into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickengine.llm.decontamination import decontamination_stage
from tickengine.llm.nearduplicates import near_duplicates_stage
from tickengine.llm.packing import packing_stage
from tickengine.llm.pii import private_stage
from tickengine.llm.quality import quality_stage
from tickengine.session import materialize

STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("personal data", private_stage),
    ("packing", packing_stage),
]

# trained models, a tokenizer and bin packing cannot be expressed in SQL: the tests hold run() against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's result is written to the checkpoint folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
