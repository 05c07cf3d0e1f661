"""A training corpus from raw documents: rules, line dedup, near-dedup, mixing, tokens.

Each stage takes the written result of the one before. A stage's own scratch
tables must outlive it until its result is written; the next stage then removes
them, so at any time the shared scratch folder holds those of one stage.
"""

from __future__ import annotations

import os
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402

from forgemeter.llm import bpe, line_crf, line_dedup, mixing, simhash  # noqa: E402
from forgemeter.llm.queries import RANKS  # noqa: E402
from forgemeter.llm.shipping import ship_package  # noqa: E402
from forgemeter.session import SCOPE, remove_path, scratch_path, scratch_root  # noqa: E402

# The local property that names a run, and the scratch folder of each run's last stage; stages that are called
# outside a run are one run of their application.
_RUN = "forgemeter.pipeline"
_LAST_SCOPE: dict[str, str] = {}


def _remove_last(spark: SparkSession) -> str:
    """Remove the scratch tables of this run's last stage; returns the run's name."""
    context = spark.sparkContext
    name = context.getLocalProperty(_RUN) or context.applicationId
    last = _LAST_SCOPE.pop(name, None)
    if last:
        remove_path(spark, f"{scratch_root(spark)}/forgemeter/{last}")
    return name


def _stage(work):
    """A stage whose scratch tables are in a folder of their own, removed by the next stage."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        context = spark.sparkContext
        name = _remove_last(spark)
        scope = f"stage-{uuid.uuid4().hex}"
        outer = context.getLocalProperty(SCOPE)
        context.setLocalProperty(SCOPE, scope)
        try:
            result = work(docs)
        finally:
            context.setLocalProperty(SCOPE, outer)
        _LAST_SCOPE[name] = scope
        return result

    return run


def _tokens(docs: DataFrame) -> DataFrame:
    """Per row of the mix: doc_id, n_tokens and the digests of its ids and of what they decode to."""
    return bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", _stage(line_crf.kept_documents)),
    ("line dedup", _stage(line_dedup.without_repeated_runs)),
    ("SimHash near-dedup", _stage(simhash.one_of_each)),
    ("mixing sources", _stage(mixing.mixed_documents)),
    ("byte-level BPE", _stage(_tokens)),
]

# The field's verdicts and the fingerprints have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet to the shared scratch folder and read again."""
    context = spark.sparkContext
    outer = context.getLocalProperty(_RUN)
    context.setLocalProperty(_RUN, f"run-{uuid.uuid4().hex}")
    try:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        before = None
        for name, stage in STAGES:
            out = scratch_path(spark, name.replace(" ", "-"))
            stage(spark, docs, sf_dir).write.parquet(out)
            docs = spark.read.parquet(out)
            if before:
                remove_path(spark, before)
            before = out
        _remove_last(spark)
    finally:
        context.setLocalProperty(_RUN, outer)
    return docs
