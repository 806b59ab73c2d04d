"""A training corpus from ``documents``: toxic and poor texts go, near-duplicates are thinned, secrets masked, the rest packed.

Each stage gets what its predecessor has kept, as the table it was written to, and all but the last return the columns of
``documents``. Nothing else is passed on, so a stage can be run again from the table before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnkit.llm import jaccard, packing, repetition, secrets, toxicity
from churnkit.llm.common import stored, table
from churnkit.llm.queries import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold, by a model learned from the labels. A null text counts as empty."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep; a null or empty text has too few words and goes."""
    return repetition.keep_quality(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the document with the smallest doc_id, once if rows repeat it."""
    return jaccard.drop_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked, n_chars as the new text has it."""
    return secrets.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 ids at most."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("quality_rules", keep_quality), ("near_duplicates", drop_near_duplicates),
          ("secret_scans", mask_secrets), ("packing", pack)]

# A trained model and a tokenizer are beyond SQL; tests hold the result against plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each earlier stage's are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
