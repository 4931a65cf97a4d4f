"""The corpus pipeline over ``documents``: language, near copies, repeated passages, secrets,
packing.

Each stage is (spark, docs, sf_dir) -> DataFrame. ``run`` writes what a stage returns as
Parquet below ``spark.checkpoint.dir`` and reads it back as the next stage's documents.
All stages but the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.language import fit_language_model, identify_language
from wayfare.llm.minhash import near_duplicates
from wayfare.llm.packing import pack_documents
from wayfare.llm.secrets import redact
from wayfare.llm.shared import Scratch, scratches
from wayfare.llm.substring import cut_repeats
from wayfare.operators.indexing import number_rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _as_documents(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language cannot be told: no letter, or enough text and a
    narrow margin."""
    docs = docs.select(*COLUMNS)
    model = fit_language_model(docs.filter("doc_id IS NOT NULL"), "doc_id")
    return identify_language(docs, model, COLUMNS).filter("NOT rejected").select(*COLUMNS)


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with a long ``_key`` for each distinct (doc_id, text): the doc_id for its
    first text (by digest), and numbers above all doc_ids for its other texts and for
    texts without a doc_id. A table without such rows keeps its doc_ids as they are."""
    keyed = docs.withColumn("_digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    pairs = keyed.select("doc_id", "_digest").distinct()
    firsts = pairs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("_digest").alias("_first"))
    others = (pairs.join(firsts, "doc_id", "left").filter("_first IS NULL OR _digest <> _first")
              .select(F.col("doc_id").alias("_doc"), F.col("_digest").alias("_text_digest")))
    if others.isEmpty():
        return keyed.withColumn("_key", F.col("doc_id"))
    numbered, _ = number_rows(others, [F.col("_doc").asc_nulls_last(), F.col("_text_digest")], "_place")
    top = docs.agg(F.max("doc_id")).first()[0] or 0
    return (keyed.join(numbered, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_digest") == F.col("_text_digest")), "left")
            .withColumn("_key", F.coalesce(F.lit(max(top, 0) + 1) + F.col("_place"), F.col("doc_id"))))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five words, 0.8): the one with the
    smallest doc_id. A row goes only if an equal text or a confirmed link stays: rows that
    share a doc_id, or have none, are documents of their own if their texts differ. Of rows
    equal in doc_id and text the smallest (lang, source, n_chars) stays."""
    named = _named(docs.select(*COLUMNS))
    kept = (near_duplicates(named.select(F.col("_key").alias("doc_id"), "text")).filter("kept")
            .select(F.col("doc_id").alias("_kept")).distinct())
    rest = F.struct("lang", "source", "n_chars", "doc_id", "text")
    one = named.join(kept, F.col("_key") == F.col("_kept")).groupBy("_key").agg(F.min(rest).alias("d"))
    return one.select(*[F.col(f"d.{c}").alias(c) for c in COLUMNS])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document has; every document stays."""
    return _as_documents(cut_repeats(docs.select(*COLUMNS)))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks the secrets found in each text; every document stays."""
    return _as_documents(redact(docs.select(*COLUMNS)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their sequence and place."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", language), ("near_copies", near_copies), ("repeated_passages", repeated_passages),
          ("secrets", secrets), ("packing", packing)]

# Compression, banding, chunking and packing have no SQL counterpart: the stages are held
# against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages. What a stage wrote on its way, and
    the documents it read, are removed once its own output is written."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratches() as made:
            docs = scratch.write(stage(spark, docs, sf_dir), name)
        for other in made:
            other.keep_only()
        scratch.keep_only(docs)
    return docs
