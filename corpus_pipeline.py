"""Corpus pipeline: five operators in a row over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written and read again as the next one's
``docs``. All but the last return the columns of ``documents``. The classifier
and the span model are fitted on what the stage is given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import decontaminate, ngram_join, pii, sentencepiece_viterbi, toxicity
from kestrel.session import apply_defaults
from kestrel.sources.tables import load
from kestrel.storage import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    apply_defaults(spark)
    return toxicity.drop_toxic(docs, load(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    apply_defaults(spark)
    return ngram_join.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    apply_defaults(spark)
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes [KIND]; n_chars follows the new text."""
    apply_defaults(spark)
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document."""
    apply_defaults(spark)
    return sentencepiece_viterbi.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("sentencepiece", encode),
]

#: SQL cannot express the classifier, the span model and the encoder
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
