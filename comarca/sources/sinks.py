"""Writers: Parquet, tables, views, delimited text, and skipping what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def write_parquet(df: DataFrame, path, partition_by: list[str] | None = None) -> None:
    """Overwrite with zstd files; of a partitioned set only the partitions at hand."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_counted(df: DataFrame, path) -> int:
    """Write and give the number of rows, counted on the way."""
    seen = Observation()
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]


def save_table(df: DataFrame, name: str) -> None:
    """Replace a managed table."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def save_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def write_csv(df: DataFrame, path, sep: str = ",") -> None:
    """Delimited text with a header; one file for each partition."""
    df.write.mode("overwrite").csv(path, header=True, sep=sep)


def csv_with_bom(df: DataFrame) -> bytes:
    """A small display table as CSV bytes that spreadsheets open as UTF-8."""
    return df.toPandas().to_csv(index=False).encode("utf-8-sig")


def unprocessed(stamps: DataFrame, done: DataFrame, key: str = "stamp") -> DataFrame:
    """Stamps that no earlier run has finished."""
    return stamps.join(done.select(key).distinct(), key, "left_anti")


def done_stamps(spark: SparkSession, path, key: str = "stamp") -> DataFrame:
    """Stamps recorded by earlier runs; none where nothing was."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path).select(key)
    except AnalysisException:
        return spark.createDataFrame([], f"{key} string")


def record_stamps(stamps: DataFrame, path) -> None:
    stamps.write.mode("append").parquet(path)
