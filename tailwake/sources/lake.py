"""Lake tables: read, append, replace by partition, summarise."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tailwake.sources import files


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def append_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    df.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def replace_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    only_present: bool = False,
    fmt: str = "parquet",
) -> int:
    """Overwrite a table (data and schema) and return the number of rows written.

    Rows are counted while they are written, so the plan runs once. With ``only_present`` just
    the partitions that occur in ``df`` are replaced. ``rebalance`` gives evenly filled files:
    adaptive execution splits big partitions and joins small ones.
    """
    written = Observation()
    rows = df.observe(written, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        rows = rows.hint("rebalance", partition_by)
    writer = rows.write.format(fmt).mode("overwrite")
    if partition_by:
        mode = "dynamic" if only_present else "static"
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", mode)
    if fmt == "delta" and not only_present:
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)
    return written.get["rows"]


def replace_days(
    df: DataFrame,
    path: str,
    partition_by: str,
    since: date | None,
    until: date | None,
    fmt: str = "parquet",
) -> int:
    """Replace the days from ``since`` up to ``until`` (exclusive; ``None``: open) of a table that is
    partitioned by date, and return the number of rows written. ``df`` holds all rows of those days
    and no others. Days that ``df`` does not have become empty; days outside the range stay.

    Delta replaces the range in one transaction. Other formats overwrite the days that ``df`` has
    and then drop the others of the range; a refresh that was interrupted is simply run again.
    """
    written = Observation()
    rows = df.observe(
        written, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col(partition_by).cast("string")).alias("days")
    ).hint("rebalance", partition_by)
    writer = rows.write.format(fmt).mode("overwrite").partitionBy(partition_by)
    if fmt == "delta":
        bounds = [
            f"{partition_by} {sign} DATE '{day}'"
            for sign, day in ((">=", since), ("<", until))
            if day is not None
        ]
        writer.option("replaceWhere", " AND ".join(bounds)).save(path)
        return written.get["rows"]
    writer.option("partitionOverwriteMode", "dynamic").save(path)
    kept = {f"{partition_by}={day}" for day in written.get["days"]}
    for name in files.names(df.sparkSession, path):
        column, _, day = name.partition("=")
        if column != partition_by or name in kept or day == "__HIVE_DEFAULT_PARTITION__":
            continue
        if (since is None or day >= since.isoformat()) and (until is None or day < until.isoformat()):
            files.remove(df.sparkSession, f"{path}/{name}")
    return written.get["rows"]


def table_or_none(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or ``None`` where there is none yet."""
    try:
        return read_table(spark, path, fmt)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
