"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept, and returns the
columns of ``documents``; the last returns the packed pieces. An empty table gives an empty result in
every stage, long texts are handled whole, and columns that a stage does not know stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemill.llm import mixing, ngram_join, packing, quality, substrings
from telemill.llm.words import kept


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject, unchanged.

    Null and empty texts are scored as empty; equal texts have equal scores, so copies and repeated rows
    stay or go together.
    """
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at 0.8: that with the smallest id.

    Null texts and texts without words are in no group and stay. Rows equal in id and text are one; of
    several texts under the smallest id, and in groups without ids, that with the smallest hash stays.
    """
    return ngram_join.without_near_duplicates(docs, size=5, percent=80)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that an earlier document has.

    Every row stays, also one that becomes empty; null texts become empty. Rows without id lose nothing.
    ``n_chars`` is the new length; all other columns stay, whatever their names.
    """
    own = {c: f"__own_{c}" for c in ("n_words", "n_removed") if c in docs.columns}
    left = substrings.remove_repeats(docs.withColumnsRenamed(own)).withColumn("n_chars", F.char_length("text").cast("long"))
    return left.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each document and round.

    Null is a source like others. Documents without words, null texts among them, give nothing; repeated
    rows count each. ``n_chars`` is the length of what was taken.
    """
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences.

    Repeated rows are packed each; texts without words have no piece.
    """
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: Compression, shingle components and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result stored and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
