"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread by the next.

Rows are documents. A stage's decisions are joined back to its rows by a hash of id and text (and language),
so that texts take part in one shuffle and rows without an id, or with the same id and other texts, are
judged one by one. Only near dedup drops repeated rows: those with the same id and the same text.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from llm.bpe_automaton import encode_decode
from llm.line_templates import MIN_DOCS, drop_recurring
from llm.lsh_forest import near_groups, row_key
from llm.perplexity_rules import quality_rules
from llm.shared import shared_path, shipped
from llm.template_decontamination import contaminated
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A line template in so many documents stays in the first of them only, as in operator 1.
BOILERPLATE_DOCS = MIN_DOCS


def _keyed(docs: DataFrame, key: Column) -> DataFrame:
    """(row_key, row): the rows of ``docs`` as structs, with their keys."""
    return docs.select(key.alias("row_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def _by_key(docs: DataFrame, key: Column, keys: DataFrame, how: str) -> DataFrame:
    """The keyed rows of ``docs`` whose key is (``left_semi``) or is not (``left_anti``) among ``keys (row_key)``."""
    return _keyed(docs, key).join(keys.distinct(), "row_key", how)


@shipped
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the perplexity bands keep."""
    key = F.xxhash64("doc_id", "text", "lang")
    kept = quality_rules(spark, docs.select(key.alias("row_key"), "text", "lang"), id_col="row_key").where("kept")
    return _by_key(docs, key, kept.select(F.col("doc_id").alias("row_key")), "left_semi").select("row.*")


@shipped
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of earlier documents; a document that loses every line it had goes.

    A whole copy loses every line, so it goes here. Each text without an id is a document of its own, before all
    that have an id.
    """
    no_id = F.lit(-(1 << 62)) - F.pmod(F.xxhash64("text"), F.lit(1 << 62))
    cut = drop_recurring(docs, min_docs=BOILERPLATE_DOCS, key=F.coalesce(F.col("doc_id").cast("long"), no_id))
    emptied = (F.col("n_dropped") > 0) & (F.trim(F.col("text"), F.lit(" \t\r\n")) == "")
    left = cut.where(~F.coalesce(emptied, F.lit(False)))
    own = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return left.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


@shipped
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id (a null id comes last)."""
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    first = near_groups(spark, docs).groupBy(F.col("set_id") == 0, "group").agg(F.min(rank).alias("first"))
    kept = _by_key(docs, row_key(F.col("doc_id"), F.col("text")), first.select("first.row_key"), "left_semi")
    return kept.dropDuplicates(["row_key"]).select("row.*")


@shipped
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    key = row_key(F.col("doc_id"), F.col("text"))
    hit = contaminated(docs.select(key.alias("row_key"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="row_key")
    return _by_key(docs, key, hit.select(F.col("doc_id").alias("row_key")), "left_anti").select("row.*")


@shipped
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian unsigned 32-bit), with a digest of the decoded text."""
    coded = encode_decode(spark, docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality), ("line dedup", line_dedup), ("near dedup", near_dedup), ("decontamination", decontaminate), ("bpe", encode)]

#: The perplexity model, the token automaton and the components are not SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order."""
    base = shared_path(spark, f"pipeline/{uuid.uuid4().hex}")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{base}/{k}")
            docs = spark.read.parquet(f"{base}/{k}")
    return docs
