"""The corpus pipeline: quality rules, toxicity, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last
return the columns of ``documents``; what they decide is carried out: rejected documents go, lines
above the limit and secrets go from the text (with n_chars brought up to date).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailwake.llm import packing, quality, secrets, simhash, toxicity
from tailwake.llm.common import documents, row_key, ship
from tailwake.sources.workspace import materialize, new_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _rewritten(docs: DataFrame) -> DataFrame:
    """``docs`` with column ``now`` as the text, and n_chars counted again where it changed."""
    same = F.col("now").eqNullSafe(F.col("text"))
    return docs.select(
        "doc_id",
        F.when(same, F.col("text")).otherwise(F.col("now")).alias("text"),
        "lang",
        "source",
        F.when(same, F.col("n_chars")).otherwise(F.length("now").cast("long")).alias("n_chars"),
    )


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines above the limit."""
    ship(spark)
    docs = _columns(docs)
    judged = quality.judge_documents(docs).where("kept").select("key", "host", "removed")
    # Written, so that the join has two plain sides and rows that repeat many times can be split.
    kept = materialize(judged.dropDuplicates(["key", "host"]), "kept")
    named = docs.withColumn("key", row_key(F.col("doc_id"), F.col("text"))).withColumn(
        "host", F.coalesce("source", F.lit(""))
    )
    joined = named.join(kept, ["key", "host"])
    return _rewritten(joined.withColumn("now", quality.without_lines(F.col("text"), F.col("removed"))))


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    ship(spark)
    docs = _columns(docs)
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels"))
    found = toxicity.toxicity(F.col("text"), model, spark)
    return docs.withColumn("found", found).where("found.score < 0.5").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    ship(spark)
    docs = _columns(docs).withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    groups = simhash.near_duplicates(docs, key=F.col("key"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    stays = groups.groupBy("root").agg(F.min(order).alias("first")).select("first.key")
    # Rows that repeat id and text are one document too: the one with the smallest other columns.
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    row = F.struct(*[F.struct(F.col(c).isNull(), c).alias(c) for c in rest], "doc_id", "text")
    first = docs.join(stays, "key", "left_semi").groupBy("key").agg(F.min(row).alias("row"))
    return first.select("row.doc_id", "row.text", *[F.col("row")[c][c].alias(c) for c in rest]).select(*COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a mark."""
    scanned = secrets.scan_secrets(_columns(docs))
    clean = scanned.withColumn("now", secrets.redact(scanned)).select("row.*", "now")
    return _rewritten(clean.withColumn("now", F.when(F.col("text").isNotNull(), F.col("now"))))


def packing_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of token ids."""
    ship(spark)
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.digest(packing.pack_documents(_columns(docs), tokenizer))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_documents),
    ("simhash near-dedup", near_duplicates),
    ("secret scans", secret_scans),
    ("packing", packing_windows),
]

#: SQL can express neither the toxicity model nor fingerprints, components and tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage but the last is written to the shared folder."""
    sf_dir = str(sf_dir)
    folder = new_folder(spark, "corpus")
    docs = documents(spark, sf_dir)
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            path = f"{folder}/{place}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
