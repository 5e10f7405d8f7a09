"""The corpus pipeline: documents through quality rules, line deduplication, near-duplicates, mixing and packing.

Each stage takes (spark, docs, sf_dir), is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreline.llm.base import Workspace, made, release
from scoreline.llm.lines import lines_stage
from scoreline.llm.mixing import mix_stage
from scoreline.llm.packing import packing_stage
from scoreline.llm.quality import quality_stage
from scoreline.llm.simhash import simhash_stage

#: Rejected documents go; frequent lines go from all texts; one document of each near-duplicate group stays;
#: documents are repeated or left out as the mix takes them; pieces are packed into sequences.
STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", lines_stage),
    ("SimHash near-dedup", simhash_stage),
    ("mixing sources to target weights", mix_stage),
    ("best-fit packing", packing_stage),
]

#: SQL has neither the fingerprints' hash nor the dynamic program and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        mark, before = made(), docs
        docs = work.put(stage(spark, docs, sf_dir))
        release(mark)  # what the stage has staged; its result is written
        work.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
