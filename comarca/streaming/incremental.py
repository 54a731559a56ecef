"""File streams that run to the end of what is there and stop.

The checkpoint takes the place of a look whether an output exists: a file is
ingested once, whenever it arrives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from comarca.operators.latest import latest_per


def ingest_available(spark: SparkSession, folder: str, schema: T.StructType, out: str, checkpoint: str, file_format: str = "parquet", partition_by: Sequence[str] = ()) -> int:
    """Append what is new under ``folder`` to ``out``; gives the rows of this run."""
    stream = spark.readStream.schema(schema).format(file_format).load(folder)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).outputMode("append")
    query = (writer.partitionBy(*partition_by) if partition_by else writer).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def upsert_latest(current: DataFrame | None, arrived: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Latest row of each key over what was stored and what arrived; ties by content."""
    every = arrived if current is None else current.unionByName(arrived, allowMissingColumns=True)
    rest = [c for c in every.columns if c not in keys]
    return latest_per(every, keys, order, None, [F.struct(*(F.col(c).cast("string") for c in sorted(rest)))])
