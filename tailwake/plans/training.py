"""Delay forest and spatial clusters: training, evaluation, storage, inference."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tailwake.functions import flight
from tailwake.operators.reports import add_delay

# --- fixed values: what the models look at, and their parameters ---
CATEGORIES = ("aircraft_model", "airline_icao")
NUMERIC = (
    "weather_score", "traffic_density", "distance_km", "route_deviation",
    "precipitation_mm", "wind_knots", "visibility_m", "weather_code",
    "altitude_ft", "speed_kn", "heading_deg", "flight_phase", "speed_altitude_ratio",
    "is_raining", "is_high_wind", "is_low_visibility", "is_bad_weather", "is_slow",
    "hour_utc", "day_of_week", "is_peak_hour", "is_weekend",
)
PLACE = ("latitude", "longitude", "altitude_ft")
LABEL = "delay_minutes"
TREES, DEPTH, CLUSTERS, SEED = 100, 8, 8, 42
NO_CLUSTER = -1
#: Partitions of the training rows; models that are to be equal need the same number.
PARTITIONS = 32


def scaled(inputs, name: str) -> list:
    """Assembler (rows with nulls are skipped) and scaler to zero mean and unit deviation."""
    raw = f"{name}_raw"
    return [
        VectorAssembler(inputCols=list(inputs), outputCol=raw, handleInvalid="skip"),
        StandardScaler(inputCol=raw, outputCol=name, withMean=True, withStd=True),
    ]


def delay_pipeline(
    trees: int = TREES, depth: int = DEPTH, seed: int = SEED, keep_nodes: bool = False
) -> Pipeline:
    """Unseen categories at inference time go to a bucket of their own. With ``keep_nodes`` the forest
    keeps the node of each row and tree from level to level instead of looking it up from the root; the
    model is the same."""
    indexed = [f"{c}_idx" for c in CATEGORIES]
    encoded = [f"{c}_ohe" for c in CATEGORIES]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=list(CATEGORIES), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
            *scaled([*NUMERIC, *encoded], "features"),
            RandomForestRegressor(
                featuresCol="features", labelCol=LABEL, numTrees=trees, maxDepth=depth, seed=seed,
                cacheNodeIds=keep_nodes,
            ),
        ]
    )


def cluster_pipeline(k: int = CLUSTERS, seed: int = SEED) -> Pipeline:
    return Pipeline(
        stages=[
            *scaled(PLACE, "cluster_features"),
            KMeans(
                featuresCol="cluster_features", predictionCol="spatial_cluster", k=k, seed=seed
            ),
        ]
    )


def bucket(*key: str) -> Column:
    """0 to 99 by the first 32 bits of the MD5 of the key, which any SQL engine can repeat."""
    digest = F.md5(F.concat_ws("|", *key).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(100)).cast("int")


def split(rows: DataFrame, *key: str, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same whatever the partitioning, and after
    a lost executor."""
    return rows.filter(bucket(*key) < train_percent), rows.filter(bucket(*key) >= train_percent)


def laid_out(rows: DataFrame, *key: str, partitions: int = PARTITIONS) -> DataFrame:
    """Training rows in a fixed layout. Forests and k-means draw their samples by partition and
    order, so a model only depends on the rows and the seed if those do."""
    return rows.repartition(partitions, *key).sortWithinPartitions(*key)


def without_blanks(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in CATEGORIES})


@contextmanager
def kept(rows: DataFrame, *columns: str) -> Iterator[DataFrame]:
    """Some columns of training rows, derived and laid out once for all passes over them. They are kept
    on disk: memory is for what the forest holds of each row."""
    once = rows.select(*dict.fromkeys(columns)).persist(StorageLevel.DISK_ONLY)
    try:
        yield once
    finally:
        once.unpersist()


def nodes_fit(rows: DataFrame, trees: int) -> bool:
    """Whether memory holds the node of each row and tree. Spark keeps three states of them, beside the
    weights and bins of the rows; read back from disk they take as long as looking the nodes up."""
    a_row = 4 * 4 * trees + 512
    status = rows.sparkSession.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    free = 0
    while status.hasNext():
        free += status.next()._2()
    return rows.count() * a_row < free


def _fitted(rows: DataFrame, trees: int, depth: int, seed: int = SEED) -> PipelineModel:
    return delay_pipeline(trees, depth, seed, nodes_fit(rows, trees)).fit(rows)


def fit_delay(
    rows: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED
) -> PipelineModel:
    """Delay model from featured, labelled rows. Blank categories are not learnt: they share the
    bucket of unseen ones, at training and at inference."""
    with kept(without_blanks(rows), *CATEGORIES, *NUMERIC, LABEL) as once:
        return _fitted(once, trees, depth, seed)


def train(
    rows: DataFrame, trees: int = TREES, depth: int = DEPTH, k: int = CLUSTERS
) -> tuple[PipelineModel, PipelineModel]:
    """Both models from featured, labelled rows."""
    with kept(without_blanks(rows), *CATEGORIES, *NUMERIC, LABEL, *PLACE) as once:
        return _fitted(once, trees, depth), cluster_pipeline(k).fit(once)


def save_models(path: str, delay_model: PipelineModel, cluster_model: PipelineModel) -> None:
    delay_model.write().overwrite().save(f"{path}/delay")
    cluster_model.write().overwrite().save(f"{path}/clusters")


def load_models(spark: SparkSession, path: str) -> tuple[PipelineModel | None, PipelineModel | None]:
    """The stored models; ``None`` for one that is missing or unreadable (rules apply then)."""

    def load(name: str) -> PipelineModel | None:
        try:
            return PipelineModel.load(f"{path}/{name}")
        except Exception as reason:  # any failure means: no model
            print(f"no model at {path}/{name}, using the fallback ({type(reason).__name__})")
            return None

    return load("delay"), load("clusters")


def apply_models(
    featured: DataFrame, delay_model=None, cluster_model=None, delay: Column | None = None
) -> DataFrame:
    """Delay, its category and the spatial cluster, from models or fallbacks."""
    rows = featured
    if delay is None and delay_model is not None:
        rows = delay_model.transform(rows)
        delay = F.round("prediction", 1)
    rows = add_delay(rows, delay)
    if cluster_model is None:
        return rows.withColumn("spatial_cluster", F.lit(NO_CLUSTER))
    return cluster_model.transform(rows).drop("cluster_features_raw", "cluster_features")


def predict_delay(delay_model: PipelineModel, featured: DataFrame) -> DataFrame:
    """Rows with ``prediction`` and the category of the prediction."""
    return delay_model.transform(featured).withColumn(
        "pred_category", flight.delay_category(F.col("prediction"))
    )
