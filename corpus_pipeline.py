"""A corpus pipeline: from raw documents to packed token sequences.

Each stage takes the documents that the stage before it kept, applies one operator, and returns
documents with the same columns; the last one returns the pieces of the packed sequences.

Defined results: an empty table gives no rows. Documents with null or empty text, or without letters, go in the
language stage. Of repeated rows, and of copies under different ids, one document stays, that of the smallest doc_id.
Very long texts are cut only by packing, into pieces that hold all their ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webtext.llm import jaccard, langid, packing, secretscan, toxicity
from webtext.session import materialise

#: A document with this toxicity score or more is rejected.
TOXIC = 0.7
#: A document in which no language holds this share of the letters is rejected, and so is one without letters.
MAIN_LANGUAGE = 0.34
CAPACITY = 4096
#: Bytes of an Arrow batch. Both the executor and its Python worker hold a batch, some of it twice while it grows, so
#: Spark's own 64 MB cost a task several times that; stages work on slices of 1 to 2 MB anyway.
BATCH_BYTES = 8 << 20


def _small_batches(spark: SparkSession) -> None:
    """Set the session's limit, where it has none of its own."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, BATCH_BYTES)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the table ``labels`` and drops documents that score as toxic."""
    _small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return model.below(docs, TOXIC)


def reject_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the column ``lang`` and drops documents without letters or without a main language.

    ``lang`` of the others becomes the predicted language, which packing goes by; the given one may be null or wrong.
    """
    _small_batches(spark)
    return langid.fit(docs).certain(docs, MAIN_LANGUAGE, into="lang")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near-duplicates."""
    _small_batches(spark)
    return jaccard.one_per_group(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts, encoded ones too; ``n_chars`` follows the new text."""
    _small_batches(spark)
    clean = secretscan.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents, packed into sequences of one language each."""
    _small_batches(spark)
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 1, CAPACITY, by="lang")


STAGES = [
    ("toxicity", reject_toxic),
    ("language_id", reject_unknown_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: No stage but the join has an SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; what a stage keeps is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
