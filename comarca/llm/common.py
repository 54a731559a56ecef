"""Helpers shared by the operators: durable intermediates, sources, words."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bits of a sieve: 2,048 bitmaps of 4 KiB (8 MiB), whatever the data.
SIEVE_BITS = 1 << 26

#: A word is a maximal run of anything but these six characters.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder (any path Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where a local session names none (tests on one machine), a temporary folder
    is made and set, so later calls agree with this one; on a cluster that is
    an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="comarca-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a place that survives lost executors, and keeps
    several readers from computing ``df`` again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a frame made by :func:`durable`."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sieve_mark(rows: DataFrame, key: str, among: DataFrame, flag: str = "_may") -> DataFrame:
    """``rows`` with ``flag``, false only where ``among``, which is stored, surely lacks the ``key`` (long).

    The keys of ``among`` are folded into a bitmap of ``SIEVE_BITS`` bits, which
    is broadcast: its size is bounded by that number, not by the data.  The more
    keys, the more other rows are marked; a join after it gives the exact
    result, and moves fewer rows.  A null key is never marked.
    """
    place = F.pmod(F.col(key), F.lit(SIEVE_BITS)) + 1
    places = among.select(place.alias("_place")).withColumn("_bucket", F.bitmap_bucket_number("_place")).repartition("_bucket")
    bits = places.groupBy("_bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    at = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0, F.lit(False))
    placed = rows.withColumn("_place", place).withColumn("_bucket", F.bitmap_bucket_number("_place"))
    return placed.join(F.broadcast(bits), "_bucket", "left").withColumn(flag, hit).select(*rows.columns, flag)


def sieve(rows: DataFrame, key: str, among: DataFrame) -> DataFrame:
    """``rows`` but for those whose ``key`` is surely not in ``among``; see :func:`sieve_mark`."""
    return sieve_mark(rows, key, among).where("_may").drop("_may")


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower_ascii_text(text: Column) -> Column:
    """A-Z of a long text to a-z; the same as :func:`lower_ascii`, faster.

    Where every character is below U+00C0 or from U+00DF to U+00FF, lower case
    changes A-Z only and the plain function will do.
    """
    return F.when(text.rlike(r"[^\x00-\u00BF\u00DF-\u00FF]"), lower_ascii(text)).otherwise(F.lower(text))
