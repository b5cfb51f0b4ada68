"""A training corpus from documents: filter, one of each group, redact, mix, pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verigrid.llm import jaccard, mixing, packing, quality, secrets
from verigrid.llm.common import only, passing_stages, stage
from verigrid.sinks.stage import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees fitted on the labels; rejected ones go.

    Null and empty texts have no word and go; an empty table stays empty; other columns are carried along.
    """
    trees = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return only(quality.judge(docs, trees).filter("kept"), *docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component stays.

    Null and blank texts stand alone and stay, as do rows without id; of rows with one id that whose
    text has the smallest hash stays. An empty table stays empty; other columns are carried along.
    """
    with passing_stages(spark):
        joined = materialize(jaccard.join(docs), "components")
    gone = joined.filter("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    repeated = joined.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").limit(1).count()
    if repeated:
        one = F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.sha2(F.coalesce("text", F.lit("")), 256))
        named = kept.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(one.alias("row")).select("row.*")
        kept = named.unionByName(kept.filter("doc_id IS NULL"))
    return only(kept, *docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with secrets replaced by a mark and ``n_chars`` brought up to date.

    Null and empty texts hold no secret; an empty table stays empty; other columns are carried along.
    """
    clean = secrets.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return only(clean, *docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those it does not take go.

    A null source is a source, the last one; null texts have size 0. Other columns are carried along.
    """
    return only(mixing.repeat(mixing.mix(docs)), *docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids; a copy of a document is packed like any other.

    Null and empty texts are the end id alone; an empty table gives no piece; other columns are ignored.
    """
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
    ("packing", packed),
]

#: Trees fitted on labels and tokenizers are beyond SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
