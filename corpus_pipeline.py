"""The corpus pipeline: quality rules, near duplicates, secrets, source mix, encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. Further
columns of documents may have any names and stay, except that the encoding replaces columns named
``ids`` or ``n_tokens``. Rows without an id are rows like others in all stages: in the mix, their
texts decide. Empty texts fail the quality rules.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stallmetrics.llm import bpe, jaccard_join, mixing, quality, secrets
from stallmetrics.llm.common import done, table, written
from stallmetrics.llm.queries import MIX, WORDS, topics_of


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned list rejects go."""
    return quality.keep_good(docs, quality.fit_rules(docs, table(spark, sf_dir, "labels")))


def keep_first_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    return jaccard_join.first_of_each(docs, jaccard_join.link_texts(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; every document stays."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn with the probabilities that bring the token shares to their targets."""
    return mixing.keep_drawn(docs, topics_of(table(spark, sf_dir, "embeddings")), MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text that is left, with its other columns."""
    return bpe.encode_texts(docs, public_tokenizers.path(WORDS))


STAGES = [("quality rules", keep_good), ("n-gram Jaccard join", keep_first_of_each), ("secret scans", redact_secrets),
          ("mixing sources", mix_sources), ("BPE encoding", encode)]

#: Learned lists, fitted weights and encodings are not SQL; the tests hold the rows and texts that each
#: stage keeps against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = []
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
        done(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
