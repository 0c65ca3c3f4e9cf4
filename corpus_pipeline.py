"""The corpus pipeline: language, near copies, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's ``docs``.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickspark.llm.common import read_table, written
from tickspark.llm.decontam import decontamination_stage
from tickspark.llm.langid import language_stage
from tickspark.llm.minhash import near_duplicate_stage
from tickspark.llm.packing import packing_stage
from tickspark.llm.substring import substring_stage

STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", substring_stage),
    ("benchmark_leaks", decontamination_stage),
    ("packing", packing_stage),
]

#: Learned models, sketches and tokenizers: SQL cannot express the stages; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
