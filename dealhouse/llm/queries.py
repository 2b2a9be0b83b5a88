"""The registered corpus queries: thin, each applies its operator to its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealhouse.llm import (
    byte_bpe, lz_fingerprint, merkle, mixing, pieces, pii, quality, simhash, spelling, tool_calls, toxicity, url_filter,
    url_oracle, warc)
from dealhouse.llm.common import materialize, table
from dealhouse.session import scratch_dir

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[fn.__name__] = fn
    return fn


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op1_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.edited_neighbours(table(spark, sf_dir, "documents"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


LLM_ORACLE["op8_quality_rules"] = quality.oracle_sql()


@query
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


LLM_ORACLE["op9_url_filters"] = url_oracle.oracle_sql(url_filter.RULES)


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    spans = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), spans.alias("toxic_spans"))


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = materialize(pii.find_candidates(table(spark, sf_dir, "documents")), "pii")
    return pii.report(found, pii.fit(found))


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"))


@query
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))


@query
def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.calls_and_results(table(spark, sf_dir, "conversations"))
    return tool_calls.link_tool_calls(calls, results, tool_calls.SCHEMAS)


LLM_ORACLE["op5_tool_calls"] = tool_calls.oracle_sql()


LLM_ORACLE["op7_warc"] = warc.oracle_sql()


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(table(spark, sf_dir, "documents")))
