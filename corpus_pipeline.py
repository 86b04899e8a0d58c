"""Corpus pipeline: toxicity, exact dedup, near-duplicate dedup, redaction of personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last return the
columns of ``documents``; the last returns the pieces of packed sequences. ``run`` writes every stage's result as
Parquet in the folder the session names in spark.checkpoint.dir and reads it again, so no stage is ever computed twice
and a lost executor costs one stage at most.

Rows without text are harmless, equal to each other and have no personal data; one of them survives the exact dedup. Rows
are told apart by their id and text, so texts that share an id are judged one by one, of rows repeated as a whole one stays, and
rows without an id take part like any other; where a copy has an id, that one stays. Columns beyond those of documents do
not pass. An empty table goes through all stages as an empty one. The folder of a run is left to whoever owns the shared one, since its result is read from it.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm import common, exact_dedup, ngram_join, packing, pii, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


@common.small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grader rejects go; it learns from the labels of those documents that arrive."""
    model = toxicity.train(docs, common.read(spark, sf_dir, "labels"), "toxic")
    return toxicity.accepted(docs.select(*COLUMNS), model)


@common.small_batches
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (ASCII case aside) the row with the largest doc_id stays."""
    return exact_dedup.without_copies(docs.select(*COLUMNS))


@common.small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return ngram_join.without_near_copies(docs.select(*COLUMNS))


@common.small_batches
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found is replaced by its kind; n_chars follows the text."""
    redacted = pii.redact(docs.select(*COLUMNS), pii.train(docs))
    return redacted.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


@common.small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    path = public_tokenizers.path
    return packing.piece_digests(packing.pack(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken")))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL cannot express the trained stages; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = common.read(spark, sf_dir, "documents")
    folder = f"{common.shared_folder(spark)}/corpus_pipeline_{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
