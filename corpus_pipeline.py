"""Corpus pipeline over ``documents``: five stages, each written as Parquet and reread.

toxicity -> SimHash near-dedup -> PII -> mixing to target weights -> SentencePiece. Every
stage works on all that its predecessor kept, and its decisions take effect: toxic
documents go, one document of each near-duplicate group stays, personal data is masked
(n_chars follows), documents of under-weighted domains are repeated until the domains'
token totals match the target weights (nothing is left out), and the last stage gives each
row its piece ids.

No SQL expresses the trained stages, so there is no oracle; tests hold the stages against
brute force.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dealhouse.llm import mixing, pieces, pii, simhash, toxicity
from dealhouse.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.fit(pii.find_candidates(docs)))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mix, _ = mixing.fit(docs, "lang", mixing.WEIGHTS, at_least=1.0)
    return mixing.apply_mix(docs, mix)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(docs, keep=("doc_id", "lang", "source"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("personal_data", mask_personal_data),
          ("mixing", mix_domains), ("sentencepiece", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLE = {"pipeline": ORACLE_SQL}
