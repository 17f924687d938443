"""Session settings the plans are written for. All can be set on a running session."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime plans: small partitions are joined, skewed join partitions split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods over 8,000 bytes. Wide projections that would generate
    # one are planned without fused code instead, which is several times faster than running
    # the fused method interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
