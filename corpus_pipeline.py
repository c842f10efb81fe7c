"""Training-data pipeline over ``documents``; each stage is written as Parquet and read again by the next."""

from pyspark.sql import DataFrame, SparkSession

from heatgrid.llm import stages
from heatgrid.llm.shared import documents, stored

STAGES = [
    ("quality rules", stages.quality_rules),
    ("line dedup", stages.line_dedup_stage),
    ("near dedup", stages.near_dedup_stage),
    ("mixing", stages.mixing_stage),
    ("byte-level BPE", stages.byte_bpe),
]

#: Near-duplicate search and EM have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
