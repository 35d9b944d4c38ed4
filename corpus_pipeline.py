"""Corpus pipeline: toxicity, line dedup, n-gram Jaccard join, decontamination, encoding.

Each stage takes the documents that its predecessor kept and returns the columns of
``documents``; the last returns their piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import decontam, line_dedup, ngram_join, piece_lattice, toxicity
from shelfmark.llm.common import drop, settled, shared_dir
from shelfmark.ship import ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    model = toxicity.learn(docs, ship(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).filter("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go, and documents of which nothing else is left."""
    ship(spark)
    out = line_dedup.dedup_lines(docs).filter("n_deleted = 0 or n_deleted < n_lines")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    ship(spark)
    return ngram_join.keep_one(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids_hash and round_trip of what is left."""
    import public_tokenizers

    ship(spark)
    return piece_lattice.digests(piece_lattice.round_trips(docs, public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_leaked),
    ("SentencePiece encoding and decoding", encode),
]

#: The stages are models and iterative jobs that SQL can't express; the tests hold them
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again, and deleted once the next one's are."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark)
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = settled(stage(spark, docs, sf_dir), f"{folder}/stage{i}")
        if i:
            drop(spark, f"{folder}/stage{i - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
