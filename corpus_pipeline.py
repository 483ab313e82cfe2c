"""From documents to packed training sequences: quality, line and near duplicates, mixture, packing.

Each stage takes all rows that the stage before kept, and its decisions take effect on the rows. ``run`` writes every
stage's result as Parquet to the shared folder and reads it again for the next.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quantloom.llm import divergence, mixing, odd_sketch, packing, winnow
from quantloom.sources.stage import drop_stages, stage_folder, written_stages

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
Step = Callable[[SparkSession, DataFrame, str], DataFrame]
# by application: the stage tables that the last step's result reads
_held: dict[str, list[str]] = {}


def _step(f: Step) -> Step:
    """A stage. Its ``docs`` are written, so what the stage before has put into the shared folder is no longer read."""

    @functools.wraps(f)
    def step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        drop_stages(spark, _held.pop(app, []))
        before = set(written_stages(spark))
        out = f(spark, docs, sf_dir)
        _held[app] = [p for p in written_stages(spark) if p not in before]
        return out

    return step


@_step
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the base rules and resemble their language; the others go."""
    return divergence.keep_good(docs, divergence.fit_references(docs))


@_step
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines of 50 words or more that occur earlier."""
    return winnow.dedup_lines(docs)


@_step
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return odd_sketch.keep_one_each(docs)


@_step
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture takes them."""
    return mixing.mix(docs, mixing.fit_mixture(docs))


@_step
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document in a sequence."""
    return packing.pack(docs, VOCABULARY)


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("mixture", mixture), ("pack", pack)]

# tilts are found by iteration and packing needs a tokenizer, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{stage_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, step in STAGES:
        step(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
