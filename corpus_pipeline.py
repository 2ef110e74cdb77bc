"""From raw documents to token ids: five stages, each on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trilayer.llm.common import read
from trilayer.llm.line_dedup import without_repeated_lines
from trilayer.llm.mixing import mixed_documents
from trilayer.llm.ngram_join import first_of_each_component
from trilayer.llm.pieces import encode_documents
from trilayer.llm.toxicity import fit, score_documents
from trilayer.operators.settle import scratch_path

#: Documents with this score or more are rejected.
TOXIC = 0.7


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below ``TOXIC``; the grammar is fitted on the labelled ones that are not held out."""
    grammar = fit(docs, read(spark, sf_dir, "labels"))
    return score_documents(docs, grammar).where(F.col("score") < TOXIC).select(*docs.columns)


def without_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that match an earlier line; ``n_chars`` follows the text."""
    return without_repeated_lines(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), "n_chars")).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by four fifths of their five-word shingles; documents without words stay."""
    return first_of_each_component(docs, k=5, part=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near their target weights."""
    return mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, number, CRC-32 and bytes of the piece ids of every document."""
    import public_tokenizers

    rows = encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), "ids")


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_lines),
    ("ngram_join", without_near_copies),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]

#: The learned grammar and the merges of pieces have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
