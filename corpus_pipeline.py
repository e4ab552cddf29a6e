"""From raw documents to training batches: classify, apply rules, drop near-duplicates, mix sources, pack.

Each stage is a function of (spark, docs, sf_dir); all but the last return the columns of `documents`. A stage's result
is written to the shared folder and read back by the next, so a lost executor costs one stage at most. Every stage
takes null and repeated rows, empty texts, empty tables and added columns as its operator states; documents without an
id go through, except that they are linked with no duplicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourweave.llm import mixing, near_duplicates, packing, quality_classifier, quality_rules
from hourweave.llm.common import col, fresh, read_table, word_count
from hourweave.llm.queries import GOOD_FROM, MIX_WEIGHTS, held_out
from hourweave.session import materialise


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored `GOOD_FROM` or better; the rows held out in the query stay held out here."""
    model = quality_classifier.fit(docs, read_table(spark, sf_dir, "labels").where(~held_out()))
    name = fresh("score", docs.columns)
    return quality_classifier.score(docs, model, name=name).where(col(name) >= GOOD_FROM).select(*[col(c) for c in docs.columns])


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule."""
    return quality_rules.keep_good(docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group; documents are linked from a likeness of 0.8 on, not 0.85 as in op10."""
    return near_duplicates.deduplicate(docs, percent=near_duplicates.REMOVE_PERCENT)


def source_mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix_rows(docs, word_count(F.col("text")), MIX_WEIGHTS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and place of each row."""
    return packing.pack(docs, word_count(F.col("text")))


STAGES = [
    ("quality_classifier", quality_classifier_stage),
    ("quality_rules", quality_rules_stage),
    ("near_duplicates", near_duplicates_stage),
    ("source_mix", source_mix_stage),
    ("packing", packing_stage),
]

#: The classifier, the signatures and the hash orders have no SQL form; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
