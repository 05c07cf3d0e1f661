"""The registered corpus queries: each operator on its whole table, in the columns of its contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.llm import ann, bpe, chat, collocations, html_blocks, line_crf, line_dedup, mixing, quality_model
from forgemeter.llm import simhash, token_counts, wavelet, whitening
from forgemeter.llm.shipping import ship_package
from forgemeter.session import scratch_path

QUERIES = {}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
QUERY_STEP = 20


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


@query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_read(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract_pages(_read(spark, sf_dir, "pages"))


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_runs(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def _spans(column: str) -> Column:
    spans = F.transform(column, lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string")))
    return F.concat_ws(",", spans).alias(column)


@query
def op7_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _read(spark, sf_dir, "conversations")
    pairs = chat.preference_pairs(conversations, chat.with_stale_reply(conversations))
    return pairs.select(
        "conv_id", "prompt_turns", "prompt", "chosen", "rejected", _spans("chosen_spans"), _spans("rejected_spans")
    )


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    wavelet.write_shards(_read(spark, sf_dir, "documents"), out, WORD_VOCABULARY, END_ID, as_text=False)
    return wavelet.read_documents(spark, out)


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality(_read(spark, sf_dir, "documents"))


@query
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"))


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), BYTE_VOCABULARY)
