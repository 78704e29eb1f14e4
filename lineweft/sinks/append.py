"""Appending only what a target does not have yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.session import cut_lineage


def new_rows(batch: DataFrame, existing: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct rows of ``batch`` that ``existing`` does not hold; nulls count as equal."""
    columns = columns or batch.columns
    fresh = batch.select(*columns).distinct().alias("n")
    known = existing.select(*columns).alias("e")
    same = [F.col(f"n.`{c}`").eqNullSafe(F.col(f"e.`{c}`")) for c in columns]
    return fresh.join(known, same, "left_anti").select(*columns)


def append_new(batch: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Append the new rows of ``batch`` to the Parquet table at ``path``; running it again appends none."""
    columns = columns or batch.columns
    try:
        existing = batch.sparkSession.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        batch.select(*columns).distinct().write.mode("append").parquet(path)
        return
    new_rows(batch, existing, columns).write.mode("append").parquet(path)


_BUCKET = "_bucket"


def _bucketed(df: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(buckets)).cast("int"))


def append_hashed(batch: DataFrame, path: str, columns: list[str] | None = None, buckets: int = 256) -> DataFrame:
    """Append the new rows of ``batch`` to a table laid out by a hash of its rows; returns the rows appended.

    The table at ``path`` is partitioned by the hash, so an append reads only the partitions
    that rows of the batch could be in, and the others not at all. The batch is made distinct and
    written once first; the hashes it has, at most ``buckets`` numbers, are all that reaches
    the driver. All appends to a table have to name the same columns and buckets. Running one again appends none.
    """
    columns = columns or batch.columns
    spark = batch.sparkSession
    fresh = cut_lineage(_bucketed(batch.select(*columns).distinct(), columns, buckets))
    try:
        existing = spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        added = fresh
    else:
        added = cut_lineage(new_rows(fresh, touched(existing, fresh), [*columns, _BUCKET]))
    # A partition's rows go to few files, however many tasks found them.
    added.repartition(_BUCKET).write.mode("append").partitionBy(_BUCKET).parquet(path)
    return added.drop(_BUCKET)


def touched(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """The partitions of a hashed table that rows of ``fresh`` could be in."""
    hashes = [row[0] for row in fresh.select(_BUCKET).distinct().collect()]
    return existing.where(F.col(_BUCKET).isin(hashes))


def read_hashed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that ``append_hashed`` wrote."""
    return spark.read.parquet(path).drop(_BUCKET)
