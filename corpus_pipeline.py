"""The corpus pipeline: toxic documents go, boilerplate lines go, one document
of each group of near duplicates stays, documents that overlap the benchmark
go, and the rest is packed into sequences.

Every stage is one operator of ``oreflow.llm`` over all that its predecessor
kept.  ``run`` writes each stage's rows to the shared scratch folder and reads
them again, so a lost executor never costs an earlier stage.  Empty tables,
NULLs and repeated rows are handled as the operators' own texts say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm.common import Tables, documents, free_name
from oreflow.llm.op1_packing import pack
from oreflow.llm.op4_minhash_dedup import drop_near_duplicates
from oreflow.llm.op6_decontamination import decontaminate
from oreflow.llm.op7_line_dedup import line_dedup
from oreflow.llm.op9_toxicity import toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic.  Columns that share a name with the
    operator's own stand aside meanwhile."""
    aside, own = {}, docs
    for c in docs.columns:
        if c.lower() in ("held_out", "score", "predicted"):
            aside[c] = free_name(own, f"_{c}")
            own = own.withColumnRenamed(c, aside[c])
    scored = toxicity(own, spark.read.parquet(f"{sf_dir}/labels.parquet")).where(F.col("predicted") == 0)
    return scored.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that fill their source; n_chars follows the text."""
    out = line_dedup(docs, host="source")
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 80 %)."""
    return drop_near_duplicates(docs, words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no item of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# toxicity and packing can't be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tables = documents(spark, sf_dir), Tables(spark)
    for name, stage in STAGES[:-1]:
        before, docs = docs, tables(stage(spark, docs, sf_dir), f"pipeline-{name}")
        tables.drop(before)
        tables.sweep()
    return STAGES[-1][1](spark, docs, sf_dir)
