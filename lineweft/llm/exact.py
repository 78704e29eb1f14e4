"""Exact dedup by skew-safe combining: locally, then per salt, then over the salts.

Texts meet under a SHA-256 digest and are compared whole at every stage, since the full
text is part of each grouping key. A group of copies first shrinks to one row per task, then
to one row per salt, then to one row: no task ever holds a group. Documents get their answer
by a join on digest and salt, the few repeated texts standing under every salt; should two
different texts ever share a digest, the job stops with an error instead of merging them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def winners(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    salts: int = 16,
    digest: Callable[[Column], Column] = lambda content: F.unhex(F.sha2(content, 256)),
) -> DataFrame:
    """(digest, keep_id, group_size) of every text that occurs more than once."""
    content = F.coalesce(F.col(text), F.lit(""))
    salted = docs.select(
        F.col(id).alias("id"),
        content.alias("content"),
        digest(content).alias("digest"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"),
    )
    by_salt = salted.groupBy("digest", "content", "salt").agg(F.max("id").alias("id"), F.count("*").alias("n"))
    by_text = by_salt.groupBy("digest", "content").agg(F.max("id").alias("id"), F.sum("n").alias("n"))
    by_digest = by_text.groupBy("digest").agg(
        F.max("id").alias("keep_id"), F.sum("n").alias("group_size"), F.count("*").alias("texts")
    )
    clash = F.raise_error(F.concat(F.lit("two texts share the digest "), F.hex(F.col("digest").cast("binary"))))
    return by_digest.where("group_size > 1").select(
        "digest", F.when(F.col("texts") > 1, clash.cast("bigint")).otherwise(F.col("keep_id")).alias("keep_id"), "group_size"
    )


def mark_copies(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    salts: int = 16,
    digest: Callable[[Column], Column] = lambda content: F.unhex(F.sha2(content, 256)),
) -> DataFrame:
    """One row per document: which copy of its text stays, and how many there are.

    Null texts count as empty. The largest id stays; a null id ranks below every other, and
    a group of null ids only keeps all its rows, as rows that share the largest id all do.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    salt = F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt")
    keys = docs.select(F.col(id).alias("doc_id"), digest(content).alias("digest"), salt)
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    joined = keys.join(winners(docs, text, id, salts, digest).select("*", every_salt), ["digest", "salt"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, text: str = "text", id: str = "doc_id", salts: int = 16) -> DataFrame:
    """One whole row per text, the one ``mark_copies`` keeps, in the same stages and without a join.

    Of rows that share text and largest id, the one with the largest other columns stays, so
    those have to be of types that can be compared.
    """
    rest = [c for c in docs.columns if c != text]
    rank = [F.col(id).isNotNull().alias("known"), F.col(id).alias("first")]
    row = F.struct(*rank, F.struct(*rest).alias("rest"), F.col(text).isNotNull().alias("has_text"))
    content = F.coalesce(F.col(text), F.lit(""))
    salted = docs.select(
        content.alias("content"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"),
        row.alias("row"),
    )
    by_salt = salted.groupBy("digest", "content", "salt").agg(F.max("row").alias("row"))
    by_text = by_salt.groupBy("digest", "content").agg(F.max("row").alias("row"))
    columns = [
        F.when(F.col("row.has_text"), F.col("content")).alias(c) if c == text else F.col("row.rest").getField(c).alias(c)
        for c in docs.columns
    ]
    return by_text.select(*columns)
