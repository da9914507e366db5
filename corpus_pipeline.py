"""Training-data pipeline over ``documents``: quality, toxicity, near duplicates, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return
the columns of ``documents``. A stage's result is written to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sembra.llm.combination_join import Jaccard, jaccard_join
from sembra.llm.common import table
from sembra.llm.line_quality import keep_good
from sembra.llm.toxicity_fm import fit_toxicity, keep_clean
from sembra.llm.window_packing import load_byte_vocabulary, pack_documents
from sembra.session import materialize, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base and lose little text to the line rules; their texts stay whole."""
    ship_package(spark)
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below the threshold, by a machine fitted on the labelled rows of ``docs``."""
    ship_package(spark)
    return keep_clean(docs, fit_toxicity(table(spark, sf_dir, "labels"), docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest doc_id.

    Rows that share a doc_id are one document, of which the first text in order stays. Rows with a
    null doc_id cannot be linked and all stay.
    """
    ship_package(spark)
    found = jaccard_join(docs, Jaccard(words=5, percent=80))
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    named = docs.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi")
    first = named.withColumn("_place", place).where("_place = 1").select(*docs.columns)
    return first.unionByName(docs.where(F.col("doc_id").isNull()))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    ship_package(spark)
    return pack_documents(docs, load_byte_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]
#: Toxicity is a fitted model, which SQL cannot express; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
