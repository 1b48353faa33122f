"""A corpus pipeline: from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardbrook.llm import packing, quality, rules, secrets, simhash
from shardbrook.llm.common import table, whole_text
from shardbrook.storage import shared_dir


def _boxed(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns a stage works on, and the whole row beside them under one name."""
    return docs.select(*needed, F.struct(*docs.columns).alias("_row_kept"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or are unlike trusted text.

    Null and empty texts fail.  Every row is judged by its own text, repeated or not.
    """
    judged = rules.judge(_boxed(docs, "doc_id", "text"), keep=("_row_kept",))
    return judged.where("kept").select("_row_kept.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the pairwise ranking puts below its threshold.

    The ranking is learned from the labelled documents of the raw table.  Null and
    empty texts get a score like any other; equal texts get equal ones.
    """
    ranking = quality.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = quality.score_documents(
        _boxed(docs, "doc_id", "text"), ranking, keep=("_row_kept",)
    )
    return scored.where("predicted = 1").select("_row_kept.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group; one row if it is repeated.

    Groups hang together by SimHash fingerprints of three-word shingles at three or
    fewer differing bits.  Null and empty texts have one fingerprint and are one group.
    Rows with a null id come after all others; rows alike in id and text are one row.
    """
    # Sixteen digits that sort like the id, negative ones first.
    ordered = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    name = F.concat(
        F.coalesce(ordered, F.lit("~")), F.lit(":"), F.md5(whole_text().cast("binary"))
    )
    found = simhash.near_duplicates(docs.select(name.alias("_name"), "text"), id_col="_name")
    first = found.where("_name = component_id").select("_name").distinct()
    return (
        docs.select(name.alias("_name"), F.struct(*docs.columns).alias("_row_kept"))
        .join(first, "_name", "left_semi")
        .dropDuplicates(["_name"])
        .select("_row_kept.*")
    )


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; ``n_chars`` follows the text.

    All rows stay, in any number of copies; a null or empty text holds no secret.
    """
    found = secrets.find_secrets(
        _boxed(docs, "doc_id", "text", "source"), repository_col=None, keep=("_row_kept",)
    )
    row = F.col("_row_kept")
    text = F.when(
        F.size("places") > 0, secrets.masked(row["text"], F.col("places"))
    ).otherwise(row["text"])
    changed = {
        "text": text,
        "n_chars": F.when(F.size("places") > 0, F.length(text).cast("long")).otherwise(
            row["n_chars"]
        ),
    }
    return found.select(*(changed.get(c, row[c]).alias(c) for c in docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of at most 2048 tokens.

    A null or empty text is one piece of one token; repeated rows each get a place.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", near_duplicates),
    ("secret scan", secret_scan),
    ("best-fit packing", best_fit_packing),
]

# Hashes of shingles and n-grams, and the tokenizer, cannot be said in DuckDB SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
