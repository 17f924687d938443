"""What the text operators share."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver found it."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join(p for p in [root, *paths] if p)
    return spark


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def row_key(doc_id: Column, text: Column) -> Column:
    """Names a row by its content, so that it is the same in every run and after every loss of an
    executor. Rows that repeat id and text share it."""
    return F.md5(
        F.concat(
            F.coalesce(doc_id.cast("string"), F.lit("null")),
            F.when(text.isNull(), F.lit("-")).otherwise(F.lit("+")),
            F.coalesce(text, F.lit("")),
        ).cast("binary")
    )


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(name).to_pylist()


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
