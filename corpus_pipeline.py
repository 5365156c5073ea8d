"""Documents from raw text to token ids: the stages of the corpus operators, one after the other.

A stage's output is written before the next stage begins.  So every stage first
removes what its predecessors left in the shared folder.

All stages take NULLs in any column, empty and very long texts, repeated rows
and extra columns, and give an empty table for an empty one; what becomes of
such rows is said with each operator.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import partial, wraps

from pyspark.sql import DataFrame, SparkSession

from shiftroll.llm import decontaminate, jaccard_join, language, mixing, token_store
from shiftroll.llm.queries import END_ID, TOKENIZER, table
from shiftroll.llm.ship import ship
from shiftroll.session import drop_scratch, materialise, scratch_tables

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Shingles of five words, similarity 0.8.
NEAR = jaccard_join.Rule(words=5, percent=80)


#: Intermediate tables of the stages so far, by application.
_left: dict[str, set[str]] = {}


def _stage(build: Stage, last: bool = False) -> Stage:
    @wraps(build)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        application = spark.sparkContext.applicationId
        files = docs.inputFiles()
        # a caller may not have written the documents yet
        old = {name for name in _left.pop(application, set()) if not any(name in f for f in files)}
        drop_scratch(spark, old)
        # Spark removes the shuffle files of plans that nothing refers to any more
        gc.collect()
        spark._jvm.System.gc()
        before = scratch_tables(spark)
        built = build(spark, docs, sf_dir)
        if not last:  # nobody knows when the last output has been read
            _left[application] = scratch_tables(spark) - before
        return built

    return run


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is none of those learned go."""
    return language.in_known_language(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays."""
    return jaccard_join.first_of_each(docs, NEAR)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


@partial(_stage, last=True)
def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, written and read back: doc_id, start, n_tokens, ids_crc32."""
    return token_store.encoded(docs, TOKENIZER, END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_output", token_output),
]

#: A language model's decisions are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = table(spark, sf_dir, "documents"), set()
    for _, stage in STAGES[:-1]:
        built = stage(spark, docs, sf_dir)
        before = scratch_tables(spark)
        docs = materialise(built)
        drop_scratch(spark, read)
        read = scratch_tables(spark) - before
    return STAGES[-1][1](spark, docs, sf_dir)
