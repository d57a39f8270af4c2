"""From documents to packed sequences: toxicity, quality, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import mixing, packing, quality_rules, simhash, toxicity
from loamline.llm.scratch import materialize, unused


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated score stays below one half; the classifier is fitted to the labels of these docs.

    Defined results: null and empty texts have the score of a text without words and are judged by it; repeated rows
    are kept or go together; without labels of both kinds, or without rows, all that there are stay.
    """
    model, score = toxicity.fit(docs, _labels(spark, sf_dir)), unused(docs.columns, "_toxicity")
    return toxicity.with_toxicity(docs, model, score).where(F.col(score) < 0.5).select(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned decision list rejects.

    Defined results: null and empty texts fail the base rule and go; repeated rows are kept or go together; without
    labels of both kinds the base rule alone decides.
    """
    rules, verdict = quality_rules.learn_rules(docs, _labels(spark, sf_dir)), unused(docs.columns, "_quality")
    return quality_rules.judge(docs, rules, verdict).where(F.col(f"{verdict}.kept")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the row with the smallest doc_id, null ids last.

    Defined results: texts without words share fingerprint zero, so one of them stays; of rows that repeat a doc_id one
    stays; rows without a doc_id stay only if their group has no other.
    """
    print_, row, root, group = (unused(docs.columns, c) for c in ("_f", "_row", "_root", "_group"))
    marked = simhash.with_fingerprint(docs, print_).withColumn(row, F.monotonically_increasing_id())
    marked = materialize(marked, "marked")  # the row numbers are fixed from here
    grouped = simhash.with_components(marked.select("doc_id", row, print_), print_, group, key=root)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row))
    kept = grouped.groupBy(root).agg(first.alias("x")).select(F.col(f"x.{row}").alias(row))
    return marked.join(kept, row, "left_semi").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes: none, one or more rows.

    Defined results: texts without words take nothing and go; null sources are a source of their own; repeated rows are
    mixed each by itself.
    """
    into, copy = unused(docs.columns, "_mix"), unused(docs.columns, "_copy")
    mixed = mixing.with_mix(docs, into)
    return mixed.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), F.col(f"{into}.copies").cast("int"))).alias(copy)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of up to 2048 tokens with their sequence and offset.

    Defined results: a null text counts as empty (its end id only); repeated rows are packed each by itself.
    """
    cut = materialize(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")), "pieces")
    return packing.pack(cut).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the learned list; the tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
