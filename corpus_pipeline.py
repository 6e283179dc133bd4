"""From raw documents to token ids: language, exact copies, near copies, benchmark leaks, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careerpanel.llm import bpe, decontam, exact_dedup, jaccard, langid
from careerpanel.llm.common import fold
from careerpanel.llm.queries import TOKENIZER, digests
from careerpanel.sources.staging import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a learned language is recognised; those without a letter or a text go."""
    model = langid.fit(docs.where(fold("doc_id", 3) != 1))
    carry = {f"_c{i}": F.col(c) for i, c in enumerate(docs.columns)}
    known = langid.predict(docs, model, carry=carry).where(F.col("lang_pred") != langid.UNKNOWN)
    return known.select(*(F.col(k).alias(c) for k, c in zip(carry, docs.columns, strict=True)))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents that share 0.8 of their runs of five words the one with the smallest id."""
    groups = jaccard.jaccard_components(docs, width=5, percent=80)
    stay = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_stay")).distinct()
    return docs.join(stay, F.col("doc_id").eqNullSafe(F.col("_stay")), "left_semi")


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = stage(decontam.contained_items(docs, items).select("doc_id").distinct(), "hits")
    return docs.join(hits.withColumnRenamed("doc_id", "_hit"), F.col("doc_id").eqNullSafe(F.col("_hit")), "left_anti")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each document left."""
    return digests(bpe.bpe_round_trip(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", leaks),
    ("BPE encoding and decoding", encoding),
]

#: Language filters and token ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
