"""A corpus made ready for training: five stages over ``documents``, each an operator of strataframe.llm.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with their columns; the last
returns where each piece of each document lies in the packed sequences. ``run`` writes every stage's
result to the shared folder and gives the next stage what it reads back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm import decontaminate, packing, queries, simhash, suffixes, toxicity
from strataframe.llm.common import noted, remove_tables, written
from strataframe.session import ship_package
from strataframe.sources.tables import load


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    ship_package(spark)
    score = "_".join(["score", *docs.columns])  # a name that no column has
    scored = toxicity.with_score(docs, queries.toxicity_model(spark, sf_dir, docs), out=score)
    return scored.where(F.col(f"`{score}`") < queries.TOXIC_SCORE).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: that of the smallest id. Rows of one id with
    different texts are documents of their own."""
    ship_package(spark)
    return simhash.keep_one(docs, rows_apart=True, width=3, radius=2, seed=42)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what documents of smaller ids already say in 50 bytes or more."""
    ship_package(spark)
    return suffixes.without_repeats(docs, length=50)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words in a row of a benchmark item."""
    ship_package(spark)
    return decontaminate.without_contaminated(docs, load(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of at most 4096 tokens."""
    ship_package(spark)
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_copies), ("suffix_array_dedup", cut_repeats),
          ("benchmark_decontamination", drop_contaminated), ("best_fit_packing", pack)]

#: Classifiers, fingerprints and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage wrote on its way, and what it read, goes once its result is written."""
    docs, read = load(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with noted() as tables:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        remove_tables(spark, [*read, *tables[:-1]])
        read = tables[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
