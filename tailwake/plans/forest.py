"""The delay forest as a table of nodes, and its prediction as a column of built-in functions.

``node_table`` has a row per node: tree, node, feature, threshold, left, right, value; a leaf has no
children. It is what a fitted forest says, in a form that any engine can join, store or walk. A table of
``TREES`` trees of depth ``DEPTH`` has at most TREES * 2^(DEPTH + 1) rows, so ``Forest`` holds it as
arrays, which travel inside the plan; ``predicted`` walks them with higher-order functions, one step per
level and tree, without a UDF, and gives the same number as the model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tailwake.plans import training
from tailwake.sources.workspace import new_folder

NODE_COLUMNS = ("tree", "node", "feature", "threshold", "left", "right", "value")


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The nodes of the forest that ends a fitted delay pipeline."""
    path = new_folder(spark, "forest")
    model.stages[-1].write().overwrite().save(path)
    node = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["prediction"].alias("value"),
    )


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees in one array per column; children are places in these arrays."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    @classmethod
    def of(cls, nodes: DataFrame) -> Forest:
        """From a node table, whatever the order of its rows or the numbers of its nodes."""
        table = nodes.select(*NODE_COLUMNS).orderBy("tree", "node").toPandas()
        place = {key: at for at, key in enumerate(zip(table["tree"], table["node"], strict=True))}

        def child(side: str) -> np.ndarray:
            pairs = zip(table["tree"], table[side], strict=True)
            return np.array([place.get(key, -1) for key in pairs], np.int32)

        left, right = child("left"), child("right")
        roots = np.flatnonzero(~np.isin(np.arange(len(table)), np.r_[left, right])).astype(np.int32)
        depth, level = 0, roots
        while (level := np.r_[left[level], right[level]])[level >= 0].size:
            level = level[level >= 0]
            depth += 1
        return cls(
            roots,
            table["feature"].to_numpy(np.int32),
            table["threshold"].fillna(0.0).to_numpy(np.float64),
            left,
            right,
            table["value"].to_numpy(np.float64),
            depth,
        )


def predicted(forest: Forest, features: Column) -> Column:
    """Mean over the trees of the leaf that ``features``, an array of doubles, leads to."""
    # A leaf leads to itself, whatever the row, so a step is one comparison.
    own = np.arange(len(forest.value), dtype=np.int32)
    leaf = forest.left < 0
    feature, threshold, left, right, value = (
        F.lit(array)
        for array in (
            forest.feature, forest.threshold, np.where(leaf, own, forest.left),
            np.where(leaf, own, forest.right), forest.value,
        )
    )
    levels = F.lit(np.arange(max(forest.depth, 1), dtype=np.int32))

    def total(row: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            down = F.get(row, F.get(feature, node)) <= F.get(threshold, node)
            return F.when(down, F.get(left, node)).otherwise(F.get(right, node))

        def reached(root: Column) -> Column:
            return F.get(value, F.aggregate(levels, root, step))

        return F.aggregate(F.lit(forest.roots), F.lit(0.0), lambda so_far, root: so_far + reached(root))

    # A step would work out an expression given as ``features`` anew, trees x levels times a row: as the
    # one entry of an array it is worked out once and the steps see its value.
    once = F.get(F.transform(F.array(features), total), F.lit(0))
    return once / F.lit(float(len(forest.roots)))


def prepared(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with ``features``, the array that the forest of a delay pipeline looks at."""
    for stage in model.stages[:-1]:
        rows = stage.transform(rows)
    return rows.withColumn("features", vector_to_array("features"))


def predict(model: PipelineModel, rows: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """``training.predict_delay`` by walking the node table."""
    forest = Forest.of(node_table(rows.sparkSession, model) if nodes is None else nodes)
    scored = prepared(model, training.without_blanks(rows))
    return scored.withColumn("prediction", predicted(forest, F.col("features")))
