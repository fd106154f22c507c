"""A corpus pipeline: toxicity, near-duplicates, secrets, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each stage's
rows as Parquet to the shared folder and rereads them as the next stage's documents. All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from aeromill.llm import mixing, packing, secrets, simhash, toxicity
from aeromill.llm.common import stored, table

#: A document that scores this much is rejected as toxic.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject. One pass, no shuffle.

    The model learns from labelled documents that are not held out; a text is judged alone, so equal
    texts share their fate. Null and empty texts stay. Repeated rows stay repeated, no rows give
    none, and all columns are kept whatever their names.
    """
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id, null ids last.

    Texts link where their sets of five-word shingles have a Jaccard similarity of 0.8 or more, which
    is verified; candidates are pairs of near SimHash fingerprints. Null texts are empty, and texts
    without words are alike. Of rows that repeat id and text one stays. No rows give none; all
    columns are kept whatever their names.
    """
    return simhash.keep_first(docs, words=5, similarity=0.8)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts are replaced, n_chars follows. No shuffle.

    Null texts stay null and empty ones empty. Repeated rows stay repeated, no rows give none, and
    other columns are kept as they are.
    """
    return secrets.redact_texts(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, as often as the mix uses each.

    Rows are range-sorted by position; the columns are those of ``docs``, so the position itself is
    in the order of the written rows only. Null and empty texts have no words and are never used.
    Null sources are one source, last. Ties go by the digest of the id, the id and the digest of
    the text; repeated rows are documents of their own. No rows give none.
    """
    return mixing.curriculum(docs, docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences.

    A null or empty text is one piece, the end id alone. Repeated rows are packed once each, and
    equal pieces are interchangeable. No rows give none; other columns are ignored.
    """
    return packing.op7(docs, packing.vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the toxicity model nor the tokeniser.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(partial(stage, spark, docs, sf_dir), spark, f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

