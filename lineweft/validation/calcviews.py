"""Calculation views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.adapters.calcviews import calcview_docs
from lineweft.operators import calcviews as H
from lineweft.sources.calcviews import parse_calcviews


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return parse_calcviews(calcview_docs(spark, folder))


def _views(spark: SparkSession, folder: str) -> DataFrame:
    return H.derive(_parsed(spark, folder))


def _of_views(operator):
    return lambda spark, folder: operator(_views(spark, folder))


def views_scan(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.col("doc")
    return _parsed(spark, folder).select(
        "file",
        "is_valid",
        F.size(doc["calculationViews"]["calculationView"]).cast("bigint").alias("nodes"),
        F.size(doc["logicalModel"]["attributes"]["attribute"]).cast("bigint").alias("attributes"),
    )


def cte_names(spark: SparkSession, folder: str) -> DataFrame:
    return H.view_ctes(_views(spark, folder)).select("file", "view_id", "cte", "pos")


def cte_bodies(spark: SparkSession, folder: str) -> DataFrame:
    ctes = H.view_ctes(_views(spark, folder))
    return ctes.select("file", "cte", F.regexp_replace("body", r"\s+", " ").alias("body"))


def _flat(assets: DataFrame, *keys: str) -> DataFrame:
    value = lambda key: F.get(F.filter("attrs", lambda a: a["key"] == key), 0)["value"]
    return assets.select(
        "class", "external_id", "name", "reference", "assignable", *[value(k).alias(k.split(".")[-1]) for k in keys]
    )


_PKG = "custom.sap.hana.calscript.v7"
_MODEL = "custom.sap.hana.calcscript.v3"


def view_assets(spark: SparkSession, folder: str) -> DataFrame:
    flat = _flat(
        H.view_assets(_views(spark, folder)),
        f"{_PKG}.packagePath",
        f"{_PKG}.calcViewType",
        f"{_PKG}.keyAttribute",
        f"{_PKG}.columnDataType",
        f"{_PKG}.scriptType",
        "core.parent",
    )
    return flat


def package_assets(spark: SparkSession, folder: str) -> DataFrame:
    views = H.dedupe_views(_views(spark, folder))
    return _flat(
        H.package_assets(views),
        "core.description",
        f"{_MODEL}.sourceSchema",
        f"{_MODEL}.joinType",
        f"{_MODEL}.complexityScore",
    )


def package_links(spark: SparkSession, folder: str) -> DataFrame:
    return H.package_links(H.dedupe_views(_views(spark, folder)), "calculation_views")


def dedupe_views(spark: SparkSession, folder: str) -> DataFrame:
    return H.dedupe_views(_views(spark, folder)).select("file", "view_id")


QUERIES = {
    "views_scan": views_scan,
    "view_headers": lambda spark, folder: H.view_headers(_parsed(spark, folder)),
    "view_sources": _of_views(H.view_sources),
    "view_nodes": _of_views(H.view_nodes),
    "node_inputs": _of_views(H.node_inputs),
    "sql_table_refs": _of_views(H.sql_table_refs),
    "cte_names": cte_names,
    "cte_bodies": cte_bodies,
    "cte_deps": _of_views(H.cte_dependencies),
    "view_tables": _of_views(H.view_tables),
    "table_columns": _of_views(H.view_table_columns),
    "view_fields": _of_views(H.view_fields),
    "field_passthrough": _of_views(H.field_passthrough),
    "view_reference_assets": lambda spark, folder: _flat(H.view_reference_assets(_views(spark, folder))),
    "view_assets": view_assets,
    "view_dataset_flow": _of_views(H.view_dataset_flow),
    "view_column_flow": _of_views(H.view_column_flow),
    "view_hierarchy_links": _of_views(H.view_hierarchy_links),
    "view_links": _of_views(H.view_links),
    "view_stats": _of_views(H.view_stats),
    "dedupe_views": dedupe_views,
    "block_complexity": lambda spark, folder: H.block_complexity(H.dedupe_views(_views(spark, folder))),
    "package_assets": package_assets,
    "package_links": package_links,
}

MODEL = """
WITH v AS (
  SELECT c_custkey AS k, c_mktsegment AS seg, c_name, 'v_' || c_custkey || '.hdbcalculationview' AS file,
    CASE WHEN c_custkey % 17 = 0 THEN 'v_' || c_custkey
      ELSE 'CV_' || (c_custkey - CASE WHEN c_custkey % 10 = 9 THEN 1 ELSE 0 END) END AS view_id,
    'S_' || (c_nationkey % 4) AS s, 'R_' || (c_nationkey % 3) AS r,
    'T' || (c_custkey % 13) AS t, 'U' || (c_custkey % 7) AS u, 'pkg.sub/V' || (c_custkey % 5) AS w
  FROM customer),
hd AS (SELECT *, CASE WHEN k % 4 = 0 THEN 'pkg.' || lower(seg) ELSE '' END AS package,
    CASE WHEN seg = 'BUILDING' THEN 'CUBE' ELSE 'DIMENSION' END AS view_type,
    CASE WHEN k % 5 = 0 THEN '$$client$$' ELSE '' END AS client,
    CASE WHEN k % 3 <> 0 THEN 'View of ' || c_name ELSE '' END AS description FROM v),
sh(seg, pos, id, kind, declared) AS (VALUES
  ('BUILDING', 0, NULL, 'st', false), ('BUILDING', 1, NULL, 'sw', false), ('BUILDING', 2, NULL, 'ru', false),
  ('MACHINERY', 0, 'DS_1', 'zw', true), ('MACHINERY', 1, NULL, 'st', false), ('MACHINERY', 2, NULL, 'ru', false),
  ('AUTOMOBILE', 0, 'DS_A', 'st', true), ('AUTOMOBILE', 1, 'DS_B', 'ru', true),
  ('HOUSEHOLD', 0, NULL, 'st', false),
  ('FURNITURE', 0, 'DS_A', 'st', true), ('FURNITURE', 1, NULL, 'ru', false)),
sx AS (SELECT v.*, sh.pos, sh.declared, sh.kind,
    CASE kind WHEN 'st' THEN s WHEN 'sw' THEN s WHEN 'ru' THEN r ELSE 'Z' END AS schema,
    CASE kind WHEN 'st' THEN t WHEN 'sw' THEN w WHEN 'ru' THEN u ELSE w END AS tbl, sh.id AS did
  FROM v JOIN sh USING (seg)),
src AS (SELECT *, coalesce(did, tbl) AS id, 'REF_HANA_' || schema || '_DS/' || tbl AS ds FROM sx),
nd(seg, pos, node_id, node_type, filter, calc, input) AS (VALUES
  ('BUILDING', 0, 'Script_View', 'SCRIPT_BASED', '', '', NULL), ('MACHINERY', 0, 'Script_View', 'SCRIPT_BASED', '', '', NULL),
  ('HOUSEHOLD', 0, 'Script_View', 'SCRIPT_BASED', '', '', NULL),
  ('AUTOMOBILE', 0, 'Projection_1', 'PROJECTION', 'KEY_F = ''A''', 'CALC_1 = X2; CALC_2 = ', 'DS_A'),
  ('AUTOMOBILE', 1, 'Join_1', 'JOIN', '', '', 'DS_B'), ('AUTOMOBILE', 2, 'Aggregation_1', 'AGGREGATION', '', '', NULL),
  ('FURNITURE', 0, 'Projection_1', 'PROJECTION', 'KEY_F = ''A''', 'CALC_1 = X2; CALC_2 = ', 'DS_A'),
  ('FURNITURE', 1, 'Script_2', 'SCRIPT_BASED', '', '', NULL)),
n AS (SELECT v.*, nd.pos, node_id, node_type, filter, calc, input,
    CASE WHEN node_type = 'JOIN' THEN CASE k % 3 WHEN 0 THEN 'LEFT_OUTER' WHEN 1 THEN 'INNER' ELSE '' END ELSE '' END AS join_type
  FROM v JOIN nd USING (seg)),
ct(seg, pos, cte, body) AS (VALUES
  ('BUILDING', 0, 'base', 'SELECT a.COL_A, A.KEY_F, COUNT(x.Z1) AS n, MAX(CASE WHEN (a.COL_B > 1) THEN 1 END) AS m FROM "{s}"."{t}" AS a WHERE a.COL_C IN (SELECT q.IDX FROM "{s}"."{w}" q)'),
  ('BUILDING', 1, 'enriched', 'SELECT b.KEY_F, {u}.NAME1 AS NAME_X FROM base b LEFT JOIN "{r}"."{u}" ON b.KEY_F = {u}.KEY_F'),
  ('HOUSEHOLD', 0, 'calendar', 'SELECT ADD_DAYS(CURRENT_DATE, (1 + (2))) AS D FROM DUMMY'),
  ('HOUSEHOLD', 1, 'facts', 'SELECT f.KEY_F, F.AMOUNT FROM "{s}"."{t}" f JOIN calendar c ON c.D = f.DAY_F'),
  ('HOUSEHOLD', 2, 'final', 'SELECT * FROM Facts'),
  ('FURNITURE', 0, 'only', 'SELECT e.QTY FROM &quot;{s}&quot;.&quot;{t}&quot; e INNER JOIN &quot;{r}&quot;.&quot;{u}&quot; AS g ON e.KEY_F = g.KEY_F')),
c AS (SELECT v.*, ct.pos, ct.cte, replace(replace(replace(replace(replace(ct.body, '{s}', s), '{t}', t), '{r}', r), '{u}', u), '{w}', w) AS body
  FROM v JOIN ct USING (seg)),
dp(seg, cte, kind, up) AS (VALUES ('BUILDING', 'base', 'table', 'st'), ('BUILDING', 'base', 'table', 'sw'),
  ('BUILDING', 'enriched', 'table', 'ru'), ('BUILDING', 'enriched', 'cte', 'base'), ('HOUSEHOLD', 'facts', 'table', 'st'),
  ('HOUSEHOLD', 'facts', 'cte', 'calendar'), ('HOUSEHOLD', 'final', 'cte', 'facts'),
  ('FURNITURE', 'only', 'table', 'st'), ('FURNITURE', 'only', 'table', 'ru')),
cl(seg, kind, col) AS (VALUES ('BUILDING', 'st', 'COL_A'), ('BUILDING', 'st', 'KEY_F'), ('BUILDING', 'st', 'COL_B'),
  ('BUILDING', 'st', 'COL_C'), ('BUILDING', 'sw', 'IDX'), ('BUILDING', 'ru', 'NAME1'), ('BUILDING', 'ru', 'KEY_F'),
  ('MACHINERY', 'st', 'AMOUNT'), ('MACHINERY', 'st', 'KEY_F'), ('HOUSEHOLD', 'st', 'KEY_F'), ('HOUSEHOLD', 'st', 'AMOUNT'),
  ('HOUSEHOLD', 'st', 'DAY_F'), ('FURNITURE', 'st', 'QTY'), ('FURNITURE', 'st', 'KEY_F'), ('FURNITURE', 'ru', 'KEY_F')),
col AS (SELECT src.k, src.seg, file, view_id, schema, tbl, ds, col FROM src JOIN cl ON cl.seg = src.seg AND cl.kind = src.kind),
fd(seg, pos, field, is_key) AS (VALUES ('BUILDING', 0, 'KEY_F', 'true'), ('BUILDING', 1, 'col_b', 'true'), ('BUILDING', 2, 'COL_A', 'false'),
  ('MACHINERY', 0, 'KEY_F', 'true'), ('MACHINERY', 1, 'AMOUNT', 'false'), ('AUTOMOBILE', 0, 'KEY_F', 'true'), ('AUTOMOBILE', 1, 'QTY', 'false'),
  ('HOUSEHOLD', 0, 'KEY_F', 'true'), ('HOUSEHOLD', 1, 'D', 'true'), ('HOUSEHOLD', 2, 'AMOUNT', 'false'),
  ('FURNITURE', 0, 'KEY_F', 'true'), ('FURNITURE', 1, 'Only', 'true'), ('FURNITURE', 2, 'QTY', 'false')),
f AS (SELECT v.*, fd.pos, field, is_key, CASE WHEN seg = 'AUTOMOBILE' THEN '' WHEN field = 'KEY_F' THEN 'NVARCHAR'
    WHEN field = 'AMOUNT' THEN 'DECIMAL' ELSE '' END AS dt,
    'custom.sap.hana.calscript.v7.HanaCalcViewField/' || view_id || '/' || field AS fe FROM v JOIN fd USING (seg)),
ve AS (SELECT *, 'custom.sap.hana.calscript.v7.HanaCalcView/' || view_id AS e,
    'custom.sap.hana.calscript.v7.HanaScriptBlock/' || view_id || '/' AS b FROM v),
blk AS (SELECT n.k, n.seg, n.view_id, coalesce(ct.cte, n.node_id) AS block, node_type, ct.pos AS cpos FROM n
  LEFT JOIN ct ON ct.seg = n.seg AND n.node_type = 'SCRIPT_BASED'),
flow AS (
  SELECT CASE WHEN dp.kind = 'table' THEN src.ds ELSE b || dp.up END AS source, b || dp.cte AS target
  FROM ve JOIN dp USING (seg) LEFT JOIN src ON src.k = ve.k AND src.kind = dp.up
  UNION SELECT ds, b || 'calendar' FROM ve JOIN src USING (k) WHERE ve.seg = 'HOUSEHOLD'
  UNION SELECT ds, b || 'Script_View' FROM ve JOIN src USING (k) WHERE ve.seg = 'MACHINERY'
  UNION SELECT ds, b || n.node_id FROM ve JOIN n USING (k) JOIN src ON src.k = ve.k AND src.id = n.input
  UNION SELECT b || block, e FROM ve JOIN blk USING (k) WHERE cpos IS NULL OR (blk.seg = 'BUILDING' AND cpos = 1)
    OR (blk.seg = 'HOUSEHOLD' AND cpos = 2) OR blk.seg = 'FURNITURE'),
cflow AS (SELECT DISTINCT ds || '/' || col AS source, fe AS target FROM col JOIN f USING (k) WHERE upper(col) = upper(field)),
hier AS (SELECT '$RESOURCE' AS source, 'hana_calcviews_container' AS target, 'core.ResourceParentChild' AS association
  UNION SELECT '$RESOURCE', 'REF_HANA_' || schema || '_CONN', 'core.ResourceParentChild' FROM src
  UNION SELECT 'REF_HANA_' || schema || '_CONN', 'REF_HANA_' || schema || '_DS', 'core.ResourceParentChild' FROM src
  UNION SELECT 'REF_HANA_' || schema || '_DS', ds, 'core.DataSourceParentChild' FROM src
  UNION SELECT ds, ds || '/' || col, 'core.DataSetToDataElementParentship' FROM col
  UNION SELECT 'hana_calcviews_container', e, 'core.DataSourceParentChild' FROM ve
  UNION SELECT e, fe, 'custom.sap.hana.calscript.v7.HanaCalcViewToHanaCalcViewField' FROM ve JOIN f USING (k)
  UNION SELECT e, b || block, 'custom.sap.hana.calscript.v7.HanaCalcViewToHanaScriptBlock' FROM ve JOIN blk USING (k)),
lks AS (SELECT * FROM hier UNION SELECT source, target, 'core.DataSetDataFlow' FROM flow
  UNION SELECT source, target, 'core.DirectionalDataFlow' FROM cflow),
fst AS (SELECT view_id, min(file) AS file FROM v GROUP BY view_id),
u AS (SELECT hd.* FROM hd JOIN fst USING (view_id, file)),
dec AS (SELECT src.*, row_number() OVER (PARTITION BY src.k ORDER BY src.pos) AS rn FROM src JOIN u USING (k) WHERE declared),
fs AS (SELECT u.k, coalesce(dec.schema, '') AS fsch FROM u LEFT JOIN dec ON dec.k = u.k AND rn = 1),
blkc AS (SELECT n.view_id, node_id, node_type, calc AS logic, join_type, filter,
    (CASE WHEN calc <> '' THEN 2 ELSE 0 END + CASE WHEN join_type <> '' THEN 1 ELSE 0 END
      + CASE WHEN filter <> '' THEN 1 ELSE 0 END)::VARCHAR AS complexity,
    CASE WHEN input IS NULL THEN '0' ELSE '1' END AS source_tables, fsch AS source_schema, n.k, input
  FROM n JOIN u USING (k) JOIN fs USING (k))
"""

_P = "custom.sap.hana.calscript.v7."
_M = "custom.sap.hana.calcscript.v3."

ORACLE = {
    "views_scan": MODEL
    + """SELECT file, true AS is_valid, (SELECT count(*) FROM nd WHERE nd.seg = v.seg) AS nodes,
  (SELECT count(*) FROM fd WHERE fd.seg = v.seg AND is_key = 'true') AS attributes FROM v""",
    "view_headers": MODEL + "SELECT file, view_id, package, view_type, client, description FROM hd",
    "view_sources": MODEL + 'SELECT file, view_id, id, schema, tbl AS "table" FROM src WHERE declared',
    "view_nodes": MODEL
    + """SELECT file, view_id, node_id, node_type, join_type, filter, calc AS logic,
  CASE WHEN node_type = 'SCRIPT_BASED' THEN 2 ELSE 0 END::BIGINT AS typed_attributes FROM n""",
    "node_inputs": MODEL + "SELECT file, view_id, node_id, input AS source_id FROM n WHERE input IS NOT NULL",
    "sql_table_refs": MODEL
    + """, x AS (SELECT src.*, n.node_id FROM src JOIN n ON n.k = src.k AND n.node_type = 'SCRIPT_BASED'
  WHERE NOT declared OR src.seg = 'FURNITURE')
SELECT file, view_id, node_id, row_number() OVER (PARTITION BY k ORDER BY pos) - 1 AS pos, schema, tbl AS "table" FROM x""",
    "cte_names": MODEL + "SELECT file, view_id, cte, pos::BIGINT AS pos FROM c",
    "cte_bodies": MODEL + "SELECT file, cte, body FROM c",
    "cte_deps": MODEL
    + """SELECT v.file, v.view_id, dp.cte, dp.kind,
  CASE WHEN dp.kind = 'cte' THEN dp.up ELSE src.schema || '.' || src.tbl END AS upstream
FROM v JOIN dp USING (seg) LEFT JOIN src ON src.k = v.k AND src.kind = dp.up""",
    "view_tables": MODEL + 'SELECT file, view_id, pos::BIGINT AS pos, id, schema, tbl AS "table" FROM src',
    "table_columns": MODEL + 'SELECT DISTINCT file, view_id, schema, tbl AS "table", col AS "column" FROM col',
    "view_fields": MODEL + "SELECT file, view_id, field, is_key AS key_attribute, dt AS data_type FROM f",
    "field_passthrough": MODEL
    + """, g(seg, field, ctes) AS (VALUES ('BUILDING', 'KEY_F', 'base,enriched'), ('BUILDING', 'col_b', 'base'), ('BUILDING', 'COL_A', 'base'),
  ('MACHINERY', 'KEY_F', ''), ('MACHINERY', 'AMOUNT', ''), ('HOUSEHOLD', 'KEY_F', 'facts'), ('HOUSEHOLD', 'D', 'calendar,facts'),
  ('HOUSEHOLD', 'AMOUNT', 'facts'), ('FURNITURE', 'KEY_F', 'only'), ('FURNITURE', 'Only', 'only'), ('FURNITURE', 'QTY', 'only'))
SELECT file, view_id, field, ctes FROM v JOIN g USING (seg)""",
    "view_reference_assets": MODEL
    + """SELECT 'core.Resource' AS class, 'REF_HANA_' || schema || '_CONN' AS external_id, schema || '_Connection' AS name,
  'True' AS reference, 'True' AS assignable FROM src
UNION SELECT 'core.DataSource', 'REF_HANA_' || schema || '_DS', schema, 'True', 'True' FROM src
UNION SELECT 'core.DataSet', ds, tbl, 'True', 'True' FROM src
UNION SELECT 'core.DataElement', ds || '/' || col, col, 'True', 'True' FROM col
UNION SELECT 'core.DataSource', 'hana_calcviews_container', 'HANA Calculation Views', 'False', 'True'""",
    "view_assets": MODEL
    + f"""SELECT '{_P}HanaCalcView' AS class, e AS external_id, ve.view_id AS name, '' AS reference, 'True' AS assignable,
  package AS "packagePath", view_type AS "calcViewType", NULL AS "keyAttribute", NULL AS "columnDataType", NULL AS "scriptType", NULL AS parent
FROM ve JOIN hd USING (k)
UNION ALL SELECT '{_P}HanaCalcViewField', fe, field, '', 'True', NULL, NULL, is_key, dt, NULL, NULL FROM f
UNION ALL SELECT '{_P}HanaScriptBlock', b || block, block, '', 'True', NULL, NULL, NULL, NULL, node_type, e FROM ve JOIN blk USING (k)""",
    "view_dataset_flow": MODEL + "SELECT source, target, 'core.DataSetDataFlow' AS association FROM flow",
    "view_column_flow": MODEL + "SELECT source, target, 'core.DirectionalDataFlow' AS association FROM cflow",
    "view_hierarchy_links": MODEL + "SELECT * FROM hier",
    "view_links": MODEL + "SELECT * FROM lks",
    "view_stats": MODEL
    + """SELECT file, view_id, (SELECT count(*) FROM sh WHERE sh.seg = v.seg) AS sources,
  (SELECT count(*) FROM nd WHERE nd.seg = v.seg) AS nodes, (SELECT count(*) FROM ct WHERE ct.seg = v.seg) AS ctes,
  (SELECT count(*) FROM fd WHERE fd.seg = v.seg) AS fields FROM v""",
    "dedupe_views": MODEL + "SELECT file, view_id FROM u",
    "block_complexity": MODEL + "SELECT * EXCLUDE (k, input) FROM blkc",
    "package_assets": MODEL
    + f"""SELECT '{_M}HanaPackage' AS class, '{_M}HanaPackage/' || schema AS external_id, schema AS name, 'true' AS reference,
  'true' AS assignable, 'SAP HANA schema / package: ' || schema AS description, NULL AS "sourceSchema", NULL AS "joinType", NULL AS "complexityScore" FROM dec
UNION SELECT '{_M}HanaTable', '{_M}HanaTable/' || schema || '/' || tbl, tbl, 'true', 'true', 'SAP HANA table ' || schema || '.' || tbl, NULL, NULL, NULL FROM dec
UNION SELECT '{_M}HanaCalcView', '{_M}HanaCalcView/' || view_id, view_id, 'true', 'true', description, fsch, NULL, NULL FROM u JOIN fs USING (k)
UNION SELECT '{_M}HanaCalcViewField', '{_M}HanaCalcViewField/' || f.view_id || '/' || field, field, 'true', '',
  'Field ' || field || ' for view ' || f.view_id, NULL, NULL, NULL FROM f JOIN u USING (k)
UNION SELECT '{_M}HanaScriptBlock', '{_M}HanaScriptBlock/' || view_id || '/' || node_id, node_id, 'true', 'true',
  node_type || ' node in ' || view_id, source_schema, join_type, complexity FROM blkc""",
    "package_links": MODEL
    + f"""SELECT 'calculation_views' AS source, '{_M}HanaCalcView/' || view_id AS target, 'core.ResourceParentChild' AS association FROM u
UNION SELECT 'calculation_views', '{_M}HanaPackage/' || fsch, 'core.ResourceParentChild' FROM fs WHERE fsch <> ''
UNION SELECT '{_M}HanaPackage/' || fsch, '{_M}HanaCalcView/' || view_id, '{_M}HanaPackageToHanaCalcView' FROM u JOIN fs USING (k) WHERE fsch <> ''
UNION SELECT 'calculation_views', '{_M}HanaTable/' || schema || '/' || tbl, 'core.ResourceParentChild' FROM dec
UNION SELECT '{_M}HanaPackage/' || schema, '{_M}HanaTable/' || schema || '/' || tbl, '{_M}HanaPackageToHanaTable' FROM dec
UNION SELECT '{_M}HanaCalcView/' || f.view_id, '{_M}HanaCalcViewField/' || f.view_id || '/' || field, '{_M}HanaCalcViewToHanaCalcViewField'
  FROM f JOIN u USING (k)
UNION SELECT '{_M}HanaCalcView/' || view_id, '{_M}HanaScriptBlock/' || view_id || '/' || node_id, '{_M}HanaCalcViewToHanaScriptBlock' FROM blkc
UNION SELECT '{_M}HanaScriptBlock/' || view_id || '/' || node_id, '{_M}HanaCalcView/' || view_id, '{_M}HanaScriptBlockToHanaCalcView' FROM blkc
UNION SELECT '{_M}HanaTable/' || dec.schema || '/' || dec.tbl, '{_M}HanaScriptBlock/' || b.view_id || '/' || node_id, '{_M}HanaTableToHanaScriptBlock'
  FROM blkc b JOIN dec ON dec.k = b.k AND dec.id = b.input""",
}
