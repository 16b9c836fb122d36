"""Training-data pipeline over `documents`: five stages, each on what its predecessor kept.

1. toxicity: documents that the nearest labelled examples call toxic go.
2. near_duplicates: of each group of near copies the document with the smallest id stays.
3. decontamination: documents that overlap a benchmark item go.
4. pii: personal data in the text is replaced by its kind; every document stays.
5. mixing: every document gets the words that the mix of sources takes of it.

Stages 1 to 4 return the columns of documents, the last adds size, source_size, target and taken. Between stages the
rows are a Parquet table in the shared folder, so a lost executor repeats a part of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playtrail.llm import decontamination, jaccard, mixing, pii, toxicity
from playtrail.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go. Null and empty texts get the score of a text without neighbours; null keys are scored
    like others; without labels nothing goes. Columns of any name pass; an empty table stays empty.
    """
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays. Rows with a null doc_id and texts without words stay; of rows
    that repeat id and text one stays. Columns of any name pass; an empty table stays empty.
    """
    return jaccard.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go, with all rows of the same text. Null and empty texts stay; items without id count. Columns
    of any name pass; an empty table stays empty.
    """
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text is replaced by its kind and n_chars follows. Every row stays, null and empty texts and other columns as they are."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets the words that the mix takes of it. Null texts have no words, a null source is a source of its own, repeated rows each
    count. Columns called like the four added ones are replaced, all others pass; an empty table stays empty.
    """
    return mixing.mix(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_leaks),
          ("pii", mask_personal_data), ("mixing", mix_sources)]
# The classifier and the similarity search have no form in SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
