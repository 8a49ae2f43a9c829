"""A corpus pipeline of four operators: language, near duplicates, source mix, token ids.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns the
documents that go on, with all columns, and the last one the encoded result. ``run`` applies them to
the documents table; between stages the documents are written to the shared folder and read again,
so that a lost executor costs one stage's work at most.

Documents without a language go; of each group of near copies (five-word shingles, Jaccard
similarity 0.8 or more, also by way of others) the one with the smallest id stays; each source is
then taken to its target number of words, so documents may come twice or not at all; what is left
is encoded, with decoded texts checked by their digests.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakehold.llm import language, mixing, ngram_rtree, piece_bpe
from lakehold.llm._base import table
from lakehold.llm.queries import PIECE_BPE, vocabulary
from lakehold.sources.scratch import materialise


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_rtree.first_of_each(docs, width=5, num=4, den=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(docs, vocabulary(PIECE_BPE))


STAGES = [("language", keep_languages), ("near_copies", drop_near_copies), ("mixture", mix_sources), ("pieces", encode_pieces)]

# the language model and the verified joins are beyond SQL; tests compare run() with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
