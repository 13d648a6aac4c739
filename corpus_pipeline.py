"""Corpus cleaning pipeline: documents through five of the operators in turn.

Every stage reads what its predecessor wrote, works on all of it and returns the columns
of ``documents`` (the last adds its encoding); ``n_chars`` follows the text. Rows whose
text a stage empties go; rows that came without text pass through the stages that only
cut texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfguard.llm import decontaminate as decontamination
from shelfguard.llm import line_dedup, near_dedup, pieces, quality
from shelfguard.llm.common import stage, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with their text cut to ``text``; those that lose all they had go."""
    rows = rows.withColumn("_cut", text)
    rows = rows.where(F.coalesce(~F.rlike("text", F.lit(r"\S")), F.lit(True)) | F.rlike("_cut", F.lit(r"\S")))
    rows = rows.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("_cut").cast("long")))
    return rows.withColumn("text", F.when(F.col("text").isNotNull(), F.col("_cut"))).select(*COLUMNS)


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    judged = quality.classify(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return judged.where("predicted = 1").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines that many documents share stay only in the largest doc_id."""
    out = line_dedup.line_dedup(docs.select(*COLUMNS))
    return _with_text(out, F.col("kept_text"))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, 0.8)."""
    return near_dedup.keep_one_of_each(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out."""
    found = decontamination.find_contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return _with_text(decontamination.remove_spans(found), F.col("clean_text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether they decode to it."""
    own = F.sha2(F.translate("text", pieces.MARK, " "), 256).alias("_own")
    out = pieces.sentencepiece_encode(docs.select(*COLUMNS, own), decoded="decoded")
    return out.select(*COLUMNS, F.size("ids").cast("long").alias("n_tokens"), "ids", (F.sha2("decoded", 256) == F.col("_own")).alias("round_trip"))


STAGES = [
    ("quality classifier", filter_quality),
    ("line dedup", dedup_lines),
    ("MinHash near-dedup", dedup_near),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding", encode),
]
#: SQL can't express the classifier, so the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "pipeline")
    return docs
