"""The corpus pipeline: language ID, line dedup, near-dedup, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and read again as the next stage's
documents. All stages but the last keep the columns of the documents. Nulls, empty texts and empty tables pass through as the
stages' operators define.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumeworks.llm import language, lines, minhash, mixing, packing
from plumeworks.llm.common import free_names, importable, settle, table

#: A document whose language is named with less certainty than this is rejected, as is one without a letter.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts that are null or hold no letter go."""
    importable(spark)
    lang, score = free_names(docs.columns, "_lang_pred", "_lang_score")
    named = language.predict(docs, language.train(docs), lang_name=lang, score_name=score)
    return named.where((F.col(lang) != language.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that came before, in this or an earlier document; a document left without any text goes."""
    importable(spark)
    (gone,) = free_names(docs.columns, "_lines_removed")
    cut = lines.dedup_lines(docs, count_col=gone)
    cut = cut.where((F.col(gone) == 0) | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    importable(spark)
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: never, once or twice."""
    importable(spark)
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most 1024 tokens."""
    importable(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: The stages learn, sample and tokenize, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
