"""One query per operator: each applies it to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import lexical, license_scan, lm_scoring, media, mixing, packing, quality_rules, simhash, suffix_dedup, token_store, toxicity, warc, whitening
from loamline.llm.components import components
from loamline.llm.scratch import materialize

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.learn_rules(docs, table(spark, sf_dir, "labels"))
    out = quality_rules.judge(docs.select("doc_id", "text"), rules, "q")
    return out.select("doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words", "q.base_failed", "q.kept", "q.rule")


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.with_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), "x")
    joined = lambda c: F.array_join(F.array_sort(F.col(c)), ",")
    return out.select("doc_id", "x.n_words", "x.n_base", "x.first_word", "x.last_word", joined("x.base_labels").alias("base_labels"), joined("x.labels").alias("labels"), "x.score")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.assemble(warc.archive(table(spark, sf_dir, "pages")))
    key = lambda x: F.expr(f"try_cast(split_part({x}, ':', 3) AS bigint)")
    stored = F.expr("try_cast(element_at(metadata[0].fields, 'capture-key') AS bigint)")
    return captures.select(stored.alias("page_id"), "response.payload_bytes", "response.payload_digest", "response.record_type", key("response.refers_to").alias("refers_to"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.with_mix(table(spark, sf_dir, "documents"), "x", keep=["doc_id"])
    return out.select("doc_id", "x.size", "x.source_size", "x.target", "x.taken")


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edited copies of every picture whose id is divisible by 20, searched among all pictures.

    The tables hold no images: each embedding is drawn as tiles, equal embeddings as equal pictures.
    """
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("embedding").alias("v"))
    return copies_found(materialize(media.drawn(vectors), "images"))


def copies_found(images: DataFrame) -> DataFrame:
    """One row per picture: its class of equal pixels, the class of copies it belongs to, and what the search says of it.

    An edited copy of every picture whose id is divisible by 20 is searched among all pictures. first_id, class_size: the
    first picture with the same pixels and how many have them. copies_id: the smallest image_id that findings lead to
    from here, itself included. near_id, near_classes: the smallest image_id of the picture's group of near copies and how many classes are in it.
    A copy that finds a picture of a group has found the group. found: the classes in the groups that the picture's copy finds, its own included (NULL if it was not
    asked for). finders: the asked classes whose copies find its group; finder_id and what follows are of the one with the most inliers of those
    compared with the picture itself, the smallest id of ties (of those that find its group, without the rest, if none of them matched).
    A null picture finds nothing and is found by nothing; flat pictures have no corners, but their exact copies still share first_id.
    """
    images = materialize(images.withColumns({"picture": F.monotonically_increasing_id(), "image_class": media.class_of()}), "pictures")
    groups = materialize(media.classes(images), "classes")
    described = materialize(media.describe(images.join(groups.select("picture"), "picture", "left_semi")), "corners")
    first = groups.select("image_class", F.col("image_id").alias("first_id"), F.col("picture").alias("first"), F.col("members").alias("class_size"))
    members = materialize(images.select("image_id", "image_class").join(first, "image_class").drop("image_class"), "members")
    asked = members.where("image_id % 20 = 0").select("first").distinct()
    copies = media.edited(images.join(asked.withColumnRenamed("first", "picture"), "picture", "left_semi"))
    met, near = media.searched(materialize(media.describe(copies), "queries"), described)
    met = materialize(met, "met")
    # query_id and match_id number pictures; a class of copies is named by its smallest image_id
    ids = groups.select("picture", "image_id")
    near = near.join(ids, "picture").select("picture", F.col("first").alias("head"), F.col("size").alias("near_classes"), "image_id")
    near_ids = near.groupBy("head").agg(F.min("image_id").alias("near_id"))
    met = met.join(near.select(F.col("picture").alias("match_id"), "head", "near_classes"), "match_id")
    met = materialize(met.join(ids.select(F.col("picture").alias("query_id"), F.coalesce("image_id", F.lit(-1)).alias("finder_id")), "query_id"), "named")
    of_group = met.groupBy("query_id", "head").agg(F.max("inliers").alias("inliers"), F.first("near_classes").alias("near_classes"), F.first("finder_id").alias("finder_id"))
    of_group = materialize(of_group, "groups found")
    links = of_group.select("query_id", "head").unionByName(near.join(of_group.select("head").distinct(), "head").select(F.col("picture").alias("query_id"), "head"))
    roots = components(links, "query_id", "head")
    lowest = roots.join(ids.withColumnRenamed("picture", "node"), "node").groupBy("root").agg(F.min("image_id").alias("copies_id"))
    named = roots.join(lowest, "root").select(F.col("node").alias("first"), "copies_id")
    found = of_group.groupBy(F.col("query_id").alias("first")).agg(F.sum("near_classes").alias("found"))
    first = F.struct("inliers", -F.col("finder_id"), -F.col("query_id"))
    best = met.groupBy(F.col("match_id").alias("first")).agg(F.max_by(F.struct("finder_id", "inliers", "turn", "scale", "dx", "dy"), first).alias("b"))
    by_group = of_group.groupBy("head").agg(F.count("*").alias("finders"), F.max_by("finder_id", first).alias("group_finder"))
    per = near.join(near_ids, "head").join(by_group, "head", "left").select(F.col("picture").alias("first"), "near_id", "near_classes", "finders", "group_finder")
    per = groups.select(F.col("picture").alias("first")).join(per, "first", "left").join(best, "first", "left").join(named, "first", "left").join(found, "first", "left")
    out = members.join(materialize(per, "per class"), "first")
    mine = F.when(F.col("image_id") % 20 == 0, F.coalesce("found", F.lit(0)))
    return out.select(
        "image_id", "first_id", "class_size", F.coalesce("near_id", "first_id").alias("near_id"), F.coalesce("near_classes", F.lit(1)).alias("near_classes"), F.coalesce("copies_id", "first_id").alias("copies_id"),
        mine.alias("found"), F.coalesce("finders", F.lit(0)).alias("finders"), F.coalesce("b.finder_id", "group_finder").alias("finder_id"), "b.inliers", "b.turn", "b.scale", "b.dx", "b.dy",
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_scoring.scored(docs, remainder() == 1, public_tokenizers.path("piece_bpe_32k.model"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.with_fingerprint(table(spark, sf_dir, "documents").select("doc_id", "text"), "f")
    marked = materialize(marked.select("doc_id", "f"), "fingerprints")
    out = simhash.with_components(marked, "f", "component_id")
    return out.select("doc_id", F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), "component_id")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_store.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return token_store.read_token_files(manifest, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs.where(remainder() != 0), labels)
    if model.out is None:
        out = toxicity.with_toxicity(docs, model, "score")
    else:  # each text is read once; the thresholds come from all labelled rows that may be learned from
        told = materialize(toxicity.with_logit(docs, model, "x").select("doc_id", "x.logit", "x.language"), "logits")
        shift = toxicity.thresholds(told.where(remainder() != 0), labels)
        out = told.withColumn("score", toxicity.calibrated(F.col("logit"), F.col("language"), shift))
    return out.select("doc_id", (remainder() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = materialize(packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)), "pieces")
    return packing.pack(cut).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"), "x")
    return out.select("doc_id", "x.n_bytes", "x.n_removed", "x.n_spans", F.sha2("x.kept", 256).alias("kept_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.integers(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", "x").select("vec_id", "x")
    model = whitening.fit(rows, "x")
    out = whitening.whitened(rows, "x", model, "w").select("vec_id", "w.deviation", F.posexplode("w.whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values]) if model else F.array(F.lit(0.0))
    explained = F.get(shares, "at").alias("explained")
    n, error = (model.n, model.identity_error) if model else (0, 0.0)
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained, F.lit(error).alias("identity_error"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_quality_rules, op2_license_scans, op3_warc, op4_mixing, op5_media, op6_lm_scoring, op7_simhash, op8_token_files, op9_toxicity, op10_packing, op11_suffix_dedup, op12_lexical_search, op13_whitening]
    return {f.__name__: f for f in found}


#: Only the archive's digest columns can be told in SQL; the other operators are held against brute force.
OP3_SQL = """WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
    t AS (SELECT d, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest, CASE WHEN page_id <> top THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM p LEFT JOIN t ON p.d = t.d AND n >= 1000"""


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": OP3_SQL}
