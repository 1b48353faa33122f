"""One query for each operator of this package, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardbrook.llm import (
    bpe,
    clusters,
    html_extract,
    langid,
    licenses,
    manifest,
    packing,
    quality,
    rules,
    secrets,
    sharding,
    simhash,
    topk,
)
from shardbrook.llm.common import table, whole_text
from shardbrook.storage import store


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ranking = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, ranking)


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.learn(pages))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


def op8_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_products(vectors, vectors.where("id % 50 = 0"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), repository_col=None)
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        "spans",
        "n_live",
        "n_copied",
    )


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.crc32(whole_text().cast("binary")).alias("text_crc32")
    )
    return sharding.shard_documents(docs, keep=("text_crc32",)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = clusters.whole_vectors(table(spark, sf_dir, "embeddings"))
    found, centroids = clusters.cluster(vectors)
    found = store(found, "clusters")
    told = spark.createDataFrame(
        [(i, clusters.digest(c)) for i, c in enumerate(centroids)],
        "cluster int, centroid_sha256 string",
    )
    # A row for each centroid.
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = sums.join(told, "cluster").withColumn(
        "inertia", found.agg(F.sum("distance")).scalar()
    )
    return found.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found_chars = F.col("n_chars") + F.when(tampered, 1).otherwise(0)
    found = manifest.leaf(
        F.col("doc_id"), F.col("source"), F.col("lang"), found_chars, F.col("text")
    )
    listed = manifest.manifest(docs.withColumn("found", found), keep=("found",))
    folded = manifest.folded(F.col("found"), F.col("path"))
    return listed.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        manifest.digest(manifest.siblings(F.col("path"))).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_license_scan": op2_license_scan,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_ranking": op4_quality_ranking,
    "op5_html_extract": op5_html_extract,
    "op6_quality_rules": op6_quality_rules,
    "op7_language_id": op7_language_id,
    "op8_top_products": op8_top_products,
    "op9_simhash": op9_simhash,
    "op10_secret_scan": op10_secret_scan,
    "op11_sharding": op11_sharding,
    "op12_centroids": op12_centroids,
    "op13_merkle_manifest": op13_merkle_manifest,
}
