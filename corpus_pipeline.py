"""The corpus pipeline: every stage is one of the operators in reportloom.llm, applied to all its predecessor kept.

1. language ID: documents without a recognisable language go
2. SimHash near-duplicates: one document of each group stays
3. secret scan: secrets are replaced in the texts
4. mixing: sources are interleaved, and repeated, to their target weights
5. SentencePiece: the token ids of every document, with its place in the mix
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reportloom.llm import mixing, rank_order, secrets, simhash, wfst
from reportloom.llm.queries import MIX_EXPONENT
from reportloom.llm.storage import documents, file_places, public_vocabulary, stored

ROWS_A_BATCH = 1024  # documents that Spark hands a Python worker at once; whole texts are many times a row of numbers
LEAST_SCORE = 0.1  # least agreement with the best language's profile, whatever the scores of the labelled texts are


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; the profiles and the scores wanted at each length are learned from all
    labelled documents of the stage."""
    profiles = rank_order.learn(docs)
    return rank_order.accepted(docs, profiles, LEAST_SCORE, by_length=rank_order.least_scores(docs, profiles))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_of_each(docs, shingle=4, max_bits=4)


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced; no document goes."""
    return secrets.mask_secrets(docs)


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix, sources repeated up to their weights; no document goes."""
    return mixing.mixed(docs, mixing.tempered(mixing.source_sizes(docs), MIX_EXPONENT))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix; (mix_file, mix_row) is its place in the written order of the stage before."""
    placed = file_places(docs.select("doc_id", "text"), "mix_file", "mix_row")
    return wfst.encoded(placed, public_vocabulary("piece_bpe_32k.model"), numbers=["mix_file", "mix_row"])


STAGES = [
    ("language ID", known_language),
    ("simhash near-dedup", near_duplicates),
    ("secret scans", secrets_masked),
    ("mixing to target weights", sources_mixed),
    ("sentencepiece encoding", token_ids),
]

# Fingerprints, profiles and merges are out of reach for SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read back as the next one's documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_A_BATCH)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
