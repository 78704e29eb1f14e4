"""Turning in-row arrays into rows, and the shared shape of links and assets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINK_TYPE = "array<struct<source:string,target:string,association:string>>"
ASSET_TYPE = (
    "array<struct<class:string,external_id:string,name:string,reference:string,assignable:string,"
    "attrs:array<struct<key:string,value:string>>>>"
)


def explode_rows(df: DataFrame, array: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per struct of ``array``.

    The outer form keeps the optimiser from inferring ``size(array) > 0`` on the
    computed array, which would evaluate the whole expression a second time.
    """
    exploded = df.select(*keep, F.explode_outer(array).alias("_item"))
    return exploded.where(F.col("_item").isNotNull()).select(*keep, "_item.*")


def parse_once(df: DataFrame, expression: Column, name: str) -> DataFrame:
    """Adds ``name``, evaluated once per row however often it is used or filtered on.

    Filters move below projections and take a copy of the expression with them; they do
    not move below a generator, so a one-element explode keeps a costly parse single.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), 0)


def link(source: Column, target: Column, association: str) -> Column:
    return F.struct(source.alias("source"), target.alias("target"), F.lit(association).alias("association"))


def asset(
    cls: str | Column, external_id: Column, name: Column, reference: str, assignable: str, **attrs: Column
) -> Column:
    pairs = [F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in attrs.items()]
    return F.struct(
        (F.lit(cls) if isinstance(cls, str) else cls).alias("class"),
        external_id.alias("external_id"),
        name.alias("name"),
        F.lit(reference).alias("reference"),
        F.lit(assignable).alias("assignable"),
        (F.array(*pairs) if pairs else F.array().cast("array<struct<key:string,value:string>>")).alias("attrs"),
    )


def flat_map(array: Column, function) -> Column:
    return F.flatten(F.transform(array, function))


def no_nulls(array: Column, type_ddl: str) -> Column:
    return F.coalesce(array, F.array().cast(type_ddl))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
