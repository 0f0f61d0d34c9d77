"""Corpus cleaning from end to end; every stage works on what its predecessor kept.

The stages reject toxic documents, drop exact copies, keep one document of each group of near copies,
cut benchmark passages out and encode what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import save, saved, ship, table
from cartwheel.llm.decontamination import decontaminate
from cartwheel.llm.exact_dedup import exact_dedup
from cartwheel.llm.near_dups import near_duplicates
from cartwheel.llm.pieces import encode
from cartwheel.llm.toxicity import THRESHOLD, fold_of, score, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic. Rows with crc32(doc_id) mod 4 = 2 are not learned from."""
    docs = docs.select(COLUMNS)
    model = train(docs, table(spark, sf_dir, "labels"), fold_of() != 2)
    return score(docs, model).where(F.col("score") < THRESHOLD).select(COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for white space."""
    path = save(docs.select(COLUMNS), "pipeline-exact-input")    # the stream and the locators need files of their own
    others = tuple(c for c in COLUMNS if c != "doc_id")
    return exact_dedup(spark, path, columns=others).where("kept").select(COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates (shingles of five words); rows without a doc_id stay."""
    docs = docs.select(COLUMNS)
    gone = near_duplicates(docs, words=5).where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark windows; those that had nothing else go."""
    out = decontaminate(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"), clean=True)
    hit = F.size("hit_spans") > 0
    return (out.where(~hit | (F.trim("clean_text") != ""))
            .withColumn("text", F.when(hit, F.col("clean_text")).otherwise(F.col("text")))
            .withColumn("n_chars", F.when(hit, F.length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(COLUMNS))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the best segmentation and the scores of the four best, for each document left."""
    out = encode(docs.select(COLUMNS))
    return out.select("doc_id", "lang", "source", "ids", F.col("n_best.score").alias("scores"))


STAGES = [("toxicity", toxicity), ("exact dedup", exact), ("MinHash near-dedup", near),
          ("benchmark decontamination", decontamination), ("SentencePiece encoding", sentencepiece)]
ORACLE_SQL = None   # dictionary compression and the piece lattice have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
