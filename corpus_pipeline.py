"""A cleaning pipeline over the documents: each stage works on what the one before it kept."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidings.llm import decontamination, jaccard, pieces, quality_model, secrets  # noqa: E402
from tidings.llm.common import spare, stored, table  # noqa: E402
from tidings.session import own_folder  # noqa: E402

# near copies are those of op9: shingles of so many words, so much of them shared
NEAR_WORDS, NEAR_PERCENT = jaccard.WORDS, jaccard.PERCENT
# SQL cannot train the classifier or sample segmentations
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    mark = spare("quality_score", docs.columns)
    return quality_model.score(docs, model, mark).filter(F.col(mark) >= quality_model.CUT).drop(mark)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of every group of near copies by op9's contract."""
    return jaccard.one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return secrets.redact(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document."""
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("SentencePiece encoding and decoding", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    own_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
