"""A training-data pipeline: five stages from documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the last return the columns of
documents. Documents of low quality go, of equal and near-equal texts one stays, personal data is masked, and what is left
is packed into sequences.

Defined cases, for all stages: a null text counts as empty, and stays null where rows pass; an empty or very long text is
treated as a whole like any other; further columns pass through, whatever their names; an empty table gives an empty one.
What ties and repeated rows do is said with each stage.
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewick.llm import exact_dedup, jaccard_join, packing, personal_data, quality
from tidewick.llm.common import checkpointed, ship, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant scores below its cut go. Equal texts score equally, so that they stay or go together."""
    ship(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the greatest id stays, and of rows that repeat that id one of them; a null id is the least."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more on shingles of five words, the one with the least id stays.

    A null id is the greatest. Rows are told apart by id and text, so that of rows which repeat both one stays.
    """
    ship(spark)
    return jaccard_join.keep_one_of_each(docs, words=5, percent=80)


def personal_data_masks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind in brackets, in each row by itself; n_chars is that of the new text."""
    return personal_data.mask_personal_data(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their sequence and place. Repeated rows are packed each."""
    ship(spark)
    return packing.pack(docs, tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("personal_data", personal_data_masks),
    ("pattern_packing", sequence_packing),
]

# A learned classifier and a tokenizer can't be told in SQL; a test compares with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
