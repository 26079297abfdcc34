"""A corpus pipeline of training-data operators.

Toxic documents go, one document of each near-duplicate group stays, documents that hold
benchmark items go, sources are mixed to target weights, and the rest is written as
compressed token shards.  Every stage but the last returns the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize, stage_path
from churnpanel.llm.decontaminate import drop_contaminated
from churnpanel.llm.mixing import mix_sources, word_count
from churnpanel.llm.near_dedup import keep_one
from churnpanel.llm.queries import WEIGHTS, with_domain
from churnpanel.llm.token_shards import read_digests, write_shards
from churnpanel.llm.toxicity import score_toxicity

#: Share of the tokens that reach the mix which the budget asks for.
MIX_SHARE = 0.9

#: The last stage returns token offsets and checksums; texts have no SQL form here.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = score_toxicity(docs, labels)
    return scored.where("predicted = 0").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One epoch at most, so no document is repeated."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    tree = with_domain(docs.select("doc_id", "lang", "source", word_count("text").alias("tokens"), row))
    mixed = mix_sources(tree, ["domain", "lang", "source"], "tokens", F.floor(F.col("all_tokens") * MIX_SHARE),
                        WEIGHTS, epochs=1, seed=17)
    return mixed.select("row.*")


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "token-shards")
    write_shards(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_digests(spark, path)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_shards", token_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
