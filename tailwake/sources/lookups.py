"""The fixed lookup tables as DataFrames.

Each is a constant of this package (at most 104 rows), so a broadcast of it does not grow with
the data.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailwake import constants as K


def _table(spark: SparkSession, rows, columns: str) -> DataFrame:
    """A small Arrow table, which Spark keeps as a local relation in the plan."""
    names = columns.split()
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, zip(*rows))))))


def airline_names(spark: SparkSession) -> DataFrame:
    return _table(spark, K.AIRLINE_NAMES.items(), "airline_icao airline_name")


def airports(spark: SparkSession) -> DataFrame:
    return _table(spark, K.AIRPORTS, "iata icao name country lat lon")


def capacities(spark: SparkSession) -> DataFrame:
    seats = _table(spark, K.AIRCRAFT_CAPACITY.items(), "aircraft_model capacity")
    return seats.withColumn("capacity", F.col("capacity").cast("int"))
