"""State document source (S11): a GeoJSON-like feature collection.

Only the fields the reports use are declared; the reader is given the
schema, so no inference pass runs.  A multi-line document is one record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

GEO_SCHEMA = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("properties", T.StructType([T.StructField("name", T.StringType())])),
    ]))),
])


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", "true").schema(GEO_SCHEMA).json(path)
