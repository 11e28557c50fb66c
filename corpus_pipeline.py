"""Document pipeline: quality, near copies, benchmark passages, mixing, sharding.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on every document its
predecessor kept; ``run`` writes each stage's result as Parquet in the shared folder and
reads it back as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stopwise.llm import stages
from stopwise.llm.shared import documents, stored

STAGES = [
    ("quality", stages.drop_low_quality),
    ("near_copies", stages.drop_near_copies),
    ("benchmark", stages.drop_contaminated),
    ("mix", stages.mix_sources),
    ("shard", stages.shard),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
