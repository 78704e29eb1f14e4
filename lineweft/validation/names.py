"""Name and id functions over columns of the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.adapters.tables import table
from lineweft.functions import names as N


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part", "p_partkey", "p_name", "p_size")


def normalize_path(spark: SparkSession, folder: str) -> DataFrame:
    z, name = F.col("p_size"), F.col("p_name")
    path = (
        F.when(z % 3 == 0, _text("dbfs:/mnt/", name, "/dbfs:/x"))
        .when(z % 3 == 1, _text("/mnt/dbfs:/", name))
        .otherwise(_text("s3://b/", name))
    )
    return _parts(spark, folder).select("p_partkey", N.normalize_path(path).alias("path"))


def strip_quotes(spark: SparkSession, folder: str) -> DataFrame:
    z, name = F.col("p_size"), F.col("p_name")
    raw = (
        F.when(z % 4 == 0, _text("`\"'", name, "'\"`"))
        .when(z % 4 == 1, _text("'`", name, "`'"))
        .when(z % 4 == 2, _text('""', name, "``"))
        .otherwise(name)
    )
    return _parts(spark, folder).select("p_partkey", N.strip_quotes(raw).alias("name"))


def escape_resource(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier", "s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey")
    raw = (
        F.when(k % 5 == 0, F.lit(None).cast("string"))
        .when(k % 5 == 1, F.lit(""))
        .otherwise(_text("jdbc:my-sql://host.", F.col("s_nationkey"), ":33\\", F.col("s_name"), " x"))
    )
    return suppliers.select("s_suppkey", N.escape_resource(raw).alias("resource"))


def dataset_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    p, s, n = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    namespace = F.when(s % 3 == 0, F.lit("")).otherwise(_text("ns-", s % 10))
    name = (
        F.when(n == 1, _text("a.b", p % 9, ".t", p))
        .when(n == 2, _text("/p.q/r/t", p))
        .when(n == 3, _text("bare", p))
        .when(n == 4, F.lit(""))
        .when(n == 5, _text("x/", p, ".csv"))
        .otherwise(_text("s.t", p))
    )
    source, leaf = N.split_container(name)
    return lines.select(
        N.dataset_key(namespace, name).alias("key"), source.alias("source"), leaf.alias("table")
    ).distinct()


def split_dataset_name(spark: SparkSession, folder: str) -> DataFrame:
    z, k = F.col("p_size"), F.col("p_partkey")
    name = (
        F.when(z % 6 == 0, _text("cat.sch.`t", k, "`"))
        .when(z % 6 == 1, _text('"sch".t', k))
        .when(z % 6 == 2, _text("/mnt//foo/t", k, "/"))
        .when(z % 6 == 3, _text("/t", k))
        .when(z % 6 == 4, _text("  'bare'", k))
        .otherwise(F.lit(" "))
    )
    db, leaf = N.split_dataset_name(name)
    return _parts(spark, folder).select("p_partkey", db.alias("db"), leaf.alias("table"))


def comparable_name(spark: SparkSession, folder: str) -> DataFrame:
    name = _text("Col-", F.col("p_name"), "_#", F.col("p_size"), ".É")
    return _parts(spark, folder).select("p_partkey", N.comparable(name).alias("name"))


def normalize_field(spark: SparkSession, folder: str) -> DataFrame:
    z = F.col("p_size")
    name = (
        F.when(z % 4 == 0, F.lit("Time_Stamp"))
        .when(z % 4 == 1, F.lit("timeStamp"))
        .when(z % 4 == 2, F.lit("event timestamp"))
        .otherwise(F.col("p_name"))
    )
    return _parts(spark, folder).select("p_partkey", N.normalize_field(name).alias("field"))


def column_match(spark: SparkSession, folder: str) -> DataFrame:
    z = F.col("p_size")
    target = F.when(z % 5 == 0, F.lit("loadDateTime")).when(z % 5 == 1, _text("Total ", z)).otherwise(F.col("p_name"))
    source = (
        F.when(z % 3 == 0, F.lit("src.event_timestamp")).when(z % 3 == 1, _text("a.b.total_", z)).otherwise(F.col("p_name"))
    )
    return _parts(spark, folder).select("p_partkey", N.is_column_match(target, source).alias("matches"))


def id_parts(spark: SparkSession, folder: str) -> DataFrame:
    identifier = _text("res", F.col("p_size"), ".src.x/", F.col("p_name"), "/c", F.col("p_partkey"))
    return _parts(spark, folder).select(
        "p_partkey",
        N.parent_id(identifier).alias("parent"),
        N.leaf_name(identifier).alias("leaf"),
        N.resource_of(identifier).alias("resource"),
    )


def sanitize_ids(spark: SparkSession, folder: str) -> DataFrame:
    z = F.col("p_size")
    value = F.when(z % 7 == 0, F.lit("--//")).otherwise(_text("/", F.col("p_name"), "..sql/", z, "#"))
    return _parts(spark, folder).select("p_partkey", N.sanitize_upper(value).alias("id"))


def transform_id(spark: SparkSession, folder: str) -> DataFrame:
    z = F.col("p_size")
    identifier = (
        F.when(z % 4 == 0, F.lit("$resource"))
        .when(z % 4 == 1, _text("res", z))
        .when(z % 4 == 2, _text("res/", z))
        .otherwise(_text("res/a/", F.col("p_name"), "/", z))
    )
    return _parts(spark, folder).select(
        "p_partkey", N.transform_id(identifier).alias("id"), N.transform_name(identifier).alias("name")
    )


def report_uid(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer", "c_custkey", "c_name", "c_mktsegment")
    name = _text("_", F.col("c_mktsegment"), " report: ", F.col("c_name"), "-")
    return customers.select("c_custkey", N.report_sid(name).alias("sid"), N.report_uid(name).alias("uid"))


def field_types(spark: SparkSession, folder: str) -> DataFrame:
    z = F.col("p_size")
    kind = F.get(
        F.array(*[F.lit(x) for x in ("Column", "Measure", "Aggregation", "CountRows", "HierarchyLevel")]),
        (z % 6).cast("int"),
    )
    return _parts(spark, folder).select("p_partkey", N.classify_field_type(kind).alias("field_type"))


def node_types(spark: SparkSession, folder: str) -> DataFrame:
    z = F.col("p_size").cast("int")
    xsi = F.get(
        F.array(
            *[F.lit(x) for x in ("Calculation:JoinView", "ProjectionView", "a:b:UnionView", "Calculation:SqlScriptView", "")]
        ),
        z % 5,
    )
    raw = F.get(F.array(*[F.lit(x) for x in ("leftOuter", "INNER", "FullOuter", "other")]), z % 5)
    return _parts(spark, folder).select(
        "p_partkey", N.node_type(xsi).alias("node_type"), N.join_type(raw).alias("join_type")
    )


def split_uris(spark: SparkSession, folder: str) -> DataFrame:
    z = F.col("p_size")
    uri = (
        F.when(z % 4 == 0, _text("  SCH/", F.col("p_name"), "/more "))
        .when(z % 4 == 1, F.lit("ALONE"))
        .when(z % 4 == 2, F.lit(None).cast("string"))
        .otherwise(_text("/", F.col("p_name")))
    )
    schema, leaf = N.split_uri(uri)
    return _parts(spark, folder).select("p_partkey", schema.alias("schema"), leaf.alias("table"))


QUERIES = {
    "normalize_path": normalize_path,
    "strip_quotes": strip_quotes,
    "escape_resource": escape_resource,
    "dataset_key": dataset_key,
    "split_dataset_name": split_dataset_name,
    "comparable_name": comparable_name,
    "normalize_field": normalize_field,
    "column_match": column_match,
    "id_parts": id_parts,
    "sanitize_ids": sanitize_ids,
    "transform_id": transform_id,
    "report_uid": report_uid,
    "field_types": field_types,
    "node_types": node_types,
    "split_uris": split_uris,
}

ORACLE = {
    "normalize_path": """SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN '/dbfs/mnt/' || p_name || '/dbfs:/x'
  WHEN 1 THEN '/mnt/dbfs:/' || p_name ELSE 's3://b/' || p_name END AS path FROM part""",
    "strip_quotes": """SELECT p_partkey, CASE p_size % 4 WHEN 1 THEN '`' || p_name || '`' WHEN 2 THEN p_name
  ELSE p_name END AS name FROM part""",
    "escape_resource": """SELECT s_suppkey, CASE WHEN s_suppkey % 5 IN (0, 1) THEN 'dft_src'
  ELSE 'jdbc_my_sql___host_' || s_nationkey || '_33_' || s_name || '_x' END AS resource FROM supplier""",
    "dataset_key": """WITH x AS (SELECT CASE WHEN l_suppkey % 3 = 0 THEN 'dft_src' ELSE 'ns_' || (l_suppkey % 10) END AS r,
  CASE l_linenumber WHEN 1 THEN 'a.b' || (l_partkey % 9) WHEN 2 THEN '/p.q/r' WHEN 3 THEN '_default' WHEN 4 THEN '_default'
    WHEN 5 THEN 'x' ELSE 's' END AS source,
  CASE l_linenumber WHEN 3 THEN 'bare' || l_partkey WHEN 4 THEN '_unknown' WHEN 5 THEN l_partkey || '.csv'
    ELSE 't' || l_partkey END AS tbl FROM lineitem)
SELECT DISTINCT r || '.' || source || '/' || tbl AS key, source, tbl AS "table" FROM x""",
    "split_dataset_name": """SELECT p_partkey,
  CASE p_size % 6 WHEN 0 THEN 'sch' WHEN 1 THEN 'sch' WHEN 2 THEN 'foo' WHEN 3 THEN '_path' ELSE '_default' END AS db,
  CASE p_size % 6 WHEN 4 THEN 'bare''' || p_partkey WHEN 5 THEN '_unknown' ELSE 't' || p_partkey END AS "table" FROM part""",
    "comparable_name": """SELECT p_partkey, 'col' || replace(lower(p_name), ' ', '') || p_size || 'é' AS name FROM part""",
    "normalize_field": """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'timestamp' WHEN 1 THEN 'timestamp'
  WHEN 2 THEN 'event timestamp' ELSE p_name END AS field FROM part""",
    "column_match": """SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN p_size % 3 = 0
  WHEN p_size % 5 = 1 THEN p_size % 3 = 1 ELSE p_size % 3 = 2 END AS matches FROM part""",
    "id_parts": """SELECT p_partkey, 'res' || p_size || '.src.x/' || p_name AS parent, 'c' || p_partkey AS leaf,
  'res' || p_size AS resource FROM part""",
    "sanitize_ids": """SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'UNNAMED'
  ELSE upper(replace(p_name, ' ', '_')) || '_SQL_' || p_size END AS id FROM part""",
    "transform_id": """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '$resource' WHEN 1 THEN 'res' || p_size
    WHEN 2 THEN 'res/' || p_size ELSE 'res/a_' || p_name || '_' || p_size END AS id,
  CASE p_size % 4 WHEN 0 THEN '$resource' WHEN 1 THEN 'res' || p_size WHEN 2 THEN 'res.' || p_size
    ELSE 'res.a.' || p_name || '.' || p_size END AS name FROM part""",
    "report_uid": """WITH x AS (SELECT c_custkey, '_' || c_mktsegment || ' report: ' || c_name || '-' AS n,
  c_mktsegment || '_report__' || replace(c_name, '#', '_') AS sid FROM customer)
SELECT c_custkey, sid, sid || '_' || left(md5(n), 8) AS uid FROM x""",
    "field_types": """SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'Source Column' WHEN 1 THEN 'Measure' WHEN 2 THEN 'Measure'
  WHEN 3 THEN 'Measure' ELSE 'Calculated Column' END AS field_type FROM part""",
    "node_types": """SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'JOIN' WHEN 1 THEN 'PROJECTION' WHEN 2 THEN 'UNION'
    ELSE 'SCRIPT_BASED' END AS node_type,
  CASE p_size % 5 WHEN 0 THEN 'LEFT_OUTER' WHEN 1 THEN 'INNER' WHEN 2 THEN 'FULL_OUTER' ELSE '' END AS join_type FROM part""",
    "split_uris": """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'SCH' WHEN 1 THEN 'ALONE' ELSE '' END AS schema,
  CASE p_size % 4 WHEN 0 THEN p_name || '/more' WHEN 3 THEN p_name ELSE '' END AS "table" FROM part""",
}
