"""Corpus pipeline: from raw documents to token shards in training order.

Each stage works on what the one before kept and returns the columns of
``documents``; the last one returns a row per token sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontaminate, mixing, near_dup, token_output, toxicity
from shelfwise.llm.common import Scratch, read, small_batches


# Scratch folders of stages whose results the next stage may still be reading, by session and input.
_USED: dict[tuple[str, str], list[Scratch]] = {}


def _scratch(spark: SparkSession, docs: DataFrame, sf_dir: str, what: str) -> Scratch:
    """A folder for this stage; those of earlier stages go.

    A stage's result is written before the next one reads it, so nothing needs
    its scratch tables any more; if ``docs`` still reads one, it stays.  One run
    per session and input at a time.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    files = docs.inputFiles() if key in _USED else []
    kept = []
    for old in _USED.pop(key, []):
        if any(f"/{old.name}/" in file for file in files):
            kept.append(old)
        else:
            old.clear()
    new = Scratch(spark, what)
    _USED[key] = [*kept, new]
    return new


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labels of its input, does not reject."""
    return toxicity.clean(docs, toxicity.fit_on_tables(small_batches(spark), docs, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dup.distinct_texts(docs, _scratch(small_batches(spark), docs, sf_dir, "near"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    items = read(small_batches(spark), sf_dir, "benchmark")
    return decontaminate.clean(docs, items, _scratch(spark, docs, sf_dir, "leaks"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix by source weight takes them."""
    return mixing.emit(docs, _scratch(spark, docs, sf_dir, "mix"))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix; one row per sequence."""
    _scratch(small_batches(spark), docs, sf_dir, "none")
    return token_output.materialise(docs, Scratch(spark, "tokens"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dup", drop_copies),
    ("decontaminate", drop_leaks),
    ("mix", mix_sources),
    ("token_shards", write_tokens),
]
#: Fitted weights, signatures and a tokenizer are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returns is written and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
