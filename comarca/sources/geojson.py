"""Feature collections as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

#: What is read of a feature.
SCHEMA = "type string, features array<struct<type string, id string, properties map<string,string>, geometry string>>"


def read_features(spark: SparkSession, path, codes: Mapping[str, int], iso_key: str = "shapeISO", code_key: str = "DPTO") -> DataFrame:
    """(id, properties, geometry): known ISO codes set the padded region code as id and property."""
    table = F.create_map(*(F.lit(x) for iso, code in codes.items() for x in (iso, f"{code:02d}")))
    feature = spark.read.schema(SCHEMA).json(path, multiLine=True).select(F.explode("features").alias("f"))
    code = F.try_element_at(table, F.coalesce(F.try_element_at("f.properties", F.lit(iso_key)), F.lit("")))
    added = F.when(code.isNotNull(), F.map_concat(F.map_filter("f.properties", lambda k, _: k != code_key), F.create_map(F.lit(code_key), code))).otherwise(F.col("f.properties"))
    return feature.select(F.coalesce(code, "f.id").alias("id"), added.alias("properties"), F.col("f.geometry").alias("geometry"))


def join_rows(features: DataFrame, rows: DataFrame, code_col: str = "dep_str") -> DataFrame:
    """Every feature with the row of its code, if there is one."""
    return features.join(rows, features["id"] == rows[code_col], "left")
