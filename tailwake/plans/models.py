"""Versions of the models, named by a pointer, so that a running stream takes over a retrained one.

A version is written whole under its own folder and then named by a small file. Readers take the newest
name, so they never see half a model; a version stays for those that still use it. ``ScoredSilver`` asks
for the newest version with every micro-batch, and its rows say which version scored them.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailwake.plans import silver, training
from tailwake.sources import files
from tailwake.sources.runs import RunStore

VERSION = "model_version"
NO_VERSION = 0  # rules, before the first model


class ModelStore:
    """Numbered versions of the delay and cluster models below one folder."""

    def __init__(self, base: str):
        self.base = base
        self._loaded: tuple[int, tuple] = (NO_VERSION, (None, None))

    def versions(self, spark: SparkSession) -> list[int]:
        return sorted(map(int, files.names(spark, f"{self.base}/published")))

    def publish(
        self, spark: SparkSession, delay_model: PipelineModel, cluster_model: PipelineModel
    ) -> int:
        """Store both models as the next version. Of two trainers that publish at once the second
        fails, and may publish again."""
        folder = f"{self.base}/versions/{uuid.uuid4().hex}"
        training.save_models(folder, delay_model, cluster_model)
        version = max(self.versions(spark), default=NO_VERSION) + 1
        files.write_text(spark, f"{self.base}/published/{version:08d}", folder)
        return version

    def newest(self, spark: SparkSession) -> tuple[int, PipelineModel | None, PipelineModel | None]:
        """Number and models of the newest version; loaded once per version. Without one, or if it
        can't be read, the rules apply."""
        version = max(self.versions(spark), default=NO_VERSION)
        if version != self._loaded[0]:
            folder = files.read_text(spark, f"{self.base}/published/{version:08d}")
            self._loaded = (version, training.load_models(spark, folder))
        return version, *self._loaded[1]


class ScoredSilver:
    """Silver as runs (``sources.runs``), scored batch by batch; ``update`` is the ``foreachBatch``
    function over parsed reports. Runs of a level are merged, so files grow as the table does."""

    TABLE = "silver"

    def __init__(self, base: str, models: ModelStore):
        self.store, self.models = RunStore(base), models

    def update(self, parsed: DataFrame, batch_id: int) -> None:
        spark = parsed.sparkSession
        start, pointer = self.store.start(spark, batch_id, lambda: 0)
        version, delay_model, cluster_model = self.models.newest(spark)
        enriched = silver.enrich(parsed, delay_model=delay_model, cluster_model=cluster_model)
        rows = silver.stored(enriched).withColumn(VERSION, F.lit(version).cast("int"))
        run = self.store.write(rows, self.TABLE, pointer.place, pointer.place)
        runs = self.store.merged(
            spark,
            self.TABLE,
            [*(start.runs[self.TABLE] if start else []), run],
            lambda merging: merging.hint("rebalance"),
            1 << 60,
            pointer.place,
        )
        self.store.publish(spark, replace(pointer, runs={self.TABLE: runs}))

    def read(self, spark: SparkSession) -> DataFrame | None:
        newest = self.store.newest(spark)
        return None if newest is None else self.store.read(spark, self.TABLE, newest.runs[self.TABLE])
