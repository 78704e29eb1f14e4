"""Calculation-view documents (XML)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.functions.rows import parse_once
from lineweft.sources.files import read_whole_texts

_MEASURES = "struct<measure:array<struct<_id:string>>>"
VIEW_DDL = (
    "_id string,_package string,_dataCategory string,_defaultClient string,"
    "descriptions struct<_defaultDescription:string>,"
    "dataSources struct<DataSource:array<struct<_id:string,resourceUri:string>>>,"
    "calculationViews struct<calculationView:array<struct<"
    "`_xsi:type`:string,_id:string,_joinType:string,filter:string,input:array<struct<_node:string>>,"
    "viewAttributes:struct<viewAttribute:array<struct<_id:string,_datatype:string>>>,"
    "calculatedViewAttributes:struct<calculatedViewAttribute:"
    "array<struct<_id:string,keyMapping:struct<_columnName:string>>>>,"
    "definition:string>>>,"
    "logicalModel struct<attributes:struct<attribute:array<struct<_id:string>>>,"
    f"baseMeasures:{_MEASURES},calculatedMeasures:{_MEASURES},restrictedMeasures:{_MEASURES}>,"
    "_corrupt string"
)


def read_calcviews(spark: SparkSession, path: str) -> DataFrame:
    """(file, xml): one row per ``*.hdbcalculationview`` document."""
    return read_whole_texts(spark, path, "*.hdbcalculationview").withColumnRenamed("text", "xml")


def parse_calcviews(documents: DataFrame) -> DataFrame:
    """(file, doc, is_valid): a document that is no XML keeps its row with a null ``doc``."""
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    parsed = parse_once(documents.select("file", "xml"), F.from_xml("xml", VIEW_DDL, options), "_parsed")
    valid = F.col("_parsed._corrupt").isNull() & F.col("_parsed").isNotNull()
    return parsed.select("file", F.when(valid, F.col("_parsed")).alias("doc"), valid.alias("is_valid"))
