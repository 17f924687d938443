"""Where jobs keep checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from tailwake.sources import files

SETTING = "spark.checkpoint.dir"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tailwake-")


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local folder is made only where the setting is missing on a local master; on a cluster a
    machine-local folder would not be seen by the executors, so that is an error.
    """
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    return _local_root()


_made: list[str] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a fresh folder below the shared root."""
    path = f"{shared_root(spark)}/tailwake/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Remove all folders that this process has asked for. For the end of a job: DataFrames that
    start from them can't be read afterwards."""
    while _made:
        files.remove(spark, _made.pop())


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back: later steps start from the files,
    which outlive a lost executor, and not from the plan behind them."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
