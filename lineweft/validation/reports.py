"""Report layouts and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.adapters import reports as adapter
from lineweft.config import LineageConfig
from lineweft.operators import reports as P
from lineweft.session import cut_lineage
from lineweft.sources.reports import extract_layouts

CONFIG = LineageConfig(owned_table="Owned_Table", owned_resource_name="Own Reports")


def _derived(spark: SparkSession, folder: str) -> DataFrame:
    return P.derive(P.parse_layouts(adapter.layout_docs(spark, folder)), CONFIG)


def _fields(spark: SparkSession, folder: str) -> DataFrame:
    return P.visual_fields(_derived(spark, folder))


def _audit(spark: SparkSession, folder: str) -> DataFrame:
    return P.coverage_audit(adapter.expected_fields(spark, folder), P.captured_fields(_fields(spark, folder)))


def _places(spark: SparkSession, folder: str) -> DataFrame:
    return P.coverage_places(adapter.expected_places(spark, folder), P.captured_places(_derived(spark, folder)))


def layouts_scan(spark: SparkSession, folder: str) -> DataFrame:
    parsed = P.parse_layouts(extract_layouts(adapter.report_containers(spark, folder)))
    # Containers are read once; the small columns that are left meet by name.
    scanned = cut_lineage(parsed.select("report_name", "error", F.size("layout.sections").cast("bigint").alias("sections")))
    sections = scanned.select("report_name", "sections").hint("merge")
    return scanned.select("report_name", "error").join(sections, "report_name")


def decode_layout(spark: SparkSession, folder: str) -> DataFrame:
    parsed = P.parse_layouts(adapter.layout_docs(spark, folder))
    containers = F.flatten(F.transform("layout.sections", lambda s: s["visualContainers"]))
    return parsed.select(
        "report_name",
        F.size(containers).cast("bigint").alias("containers"),
        F.size(F.filter(containers, lambda c: c["config"] == "plain text")).cast("bigint").alias("plain_configs"),
        F.size(
            F.filter(containers, lambda c: F.get_json_object(c["dataTransforms"], "$.selects[0].displayName") == "Total Price")
        )
        .cast("bigint")
        .alias("transforms"),
    )


def _flat_fields(spark: SparkSession, folder: str) -> DataFrame:
    return _fields(spark, folder).select(
        "visual_id", F.col("place.pos").cast("bigint").alias("pos"), "field_id", "field_name", "description", "field_type",
        F.col("kind").isin("Aggregation", "HierarchyLevel").alias("is_nested"), "table", "column", "has_source",
    )


def visual_fields(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_fields(spark, folder).select("visual_id", "pos", "field_id", "field_name", "description", "field_type")


def field_sources(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_fields(spark, folder).select("field_id", "pos", "table", "column", "has_source", "is_nested")


QUERIES = {
    "layouts_scan": layouts_scan,
    "decode_layout": decode_layout,
    "report_sections": lambda spark, folder: P.report_sections(_derived(spark, folder)),
    "report_visuals": lambda spark, folder: P.report_visuals(_derived(spark, folder)),
    "visual_fields": visual_fields,
    "field_sources": field_sources,
    "report_assets": lambda spark, folder: P.report_assets(_derived(spark, folder)),
    "report_datasets": lambda spark, folder: P.report_datasets(_fields(spark, folder)),
    "report_reference_assets": lambda spark, folder: P.report_reference_assets(_fields(spark, folder), CONFIG),
    "report_links": lambda spark, folder: P.report_links(_derived(spark, folder)),
    "report_links_distinct": lambda spark, folder: P.report_links(_derived(spark, folder), distinct=True),
    "field_breakdown": lambda spark, folder: P.field_breakdown(P.captured_fields(_fields(spark, folder))),
    "coverage_audit": _audit,
    "coverage_summary": lambda spark, folder: P.coverage_summary(_audit(spark, folder)),
    "coverage_places": _places,
    "coverage_grains": lambda spark, folder: P.coverage_grains(_places(spark, folder)),
}

MODEL = """
WITH rp AS (SELECT c_custkey AS c, 'Sales & Stock #' || c_custkey || ' (v' || c_nationkey || ')' AS report_name, c_nationkey AS nk
  FROM customer),
r AS (SELECT *, trim(regexp_replace(report_name, '[^A-Za-z0-9_-]', '_', 'g'), '_-') || '_' || left(md5(report_name), 8) AS uid FROM rp),
o AS (SELECT o_custkey AS c, o_orderkey AS k, o_orderstatus AS st, o_orderpriority AS pr FROM orders),
sc AS (SELECT r.*, st, row_number() OVER (PARTITION BY c ORDER BY st) - 1 AS spos, uid || '/Section' || st AS section_id
  FROM r JOIN (SELECT DISTINCT c, st FROM o) USING (c)),
vs AS (SELECT sc.*, o.k, o.pr, CASE o.k % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'table' ELSE 'pivotTable' END AS vt,
    row_number() OVER (PARTITION BY sc.c, sc.st ORDER BY o.k) AS ord
  FROM sc JOIN o ON o.c = sc.c AND o.st = sc.st WHERE o.pr IN ('1-URGENT', '2-HIGH', '3-MEDIUM')),
v AS (SELECT *, 'Visual' || ord || '_' || vt AS vname, section_id || '/Visual' || ord || '_' || vt AS vid FROM vs),
f0 AS (
  SELECT v.*, x.* FROM v, LATERAL (
    SELECT 0 AS pos, 'Aggregation' AS kind, 'Total Price' AS fname, 'Sum(orders.o_totalprice)' AS descr, 'Sum_orders_o_totalprice' AS fsid, 'orders vw ' || v.st AS tbl, 'o_totalprice' AS col
    UNION ALL SELECT 1, CASE WHEN v.k % 4 = 0 THEN 'Measure' ELSE 'Column' END, 'orders.key ' || (v.k % 10), 'orders.key ' || (v.k % 10), 'orders_key_' || (v.k % 10), 'orders vw ' || v.st, 'o_key ' || (v.k % 10)
    UNION ALL SELECT 4, 'CountRows', 'Rows', 'CountNonNull', 'CountNonNull', 'dim-' || (v.k % 3), 'dim-' || (v.k % 3)
    UNION ALL SELECT 5, 'HierarchyLevel', 'Month', 'date.month', 'date_month', 'orders vw ' || v.st, 'orders vw ' || v.st
    UNION ALL SELECT 6, 'Aggregation', 'Total Price', 'Sum(orders.o_totalprice)', 'Sum_orders_o_totalprice', 'orders vw ' || v.st, 'o_totalprice' WHERE v.k % 2 = 0
    UNION ALL SELECT CASE WHEN v.k % 2 = 0 THEN 7 ELSE 6 END, 'Literal', 'Const', 'c', 'c', '', ''
    UNION ALL SELECT CASE WHEN v.k % 2 = 0 THEN 8 ELSE 7 END, 'Measure', 'Margin', 'm.margin', 'm_margin', 'Owned_Table', 'Margin %') x
  WHERE v.pr <> '3-MEDIUM'
  UNION ALL SELECT v.*, x.* FROM v, LATERAL (
    SELECT 0, 'Column', 'orders.total', 'orders.total', 'orders_total', 'orders vw ' || v.st, 'o_totalprice'
    UNION ALL SELECT 1, 'Aggregation', 'Sum(dim.qty)', 'Sum(dim.qty)', 'Sum_dim_qty', 'dim-' || (v.k % 3), 'qty'
    UNION ALL SELECT 2, 'Column', 'lost.alias', 'lost.alias', 'lost_alias', '', 'lost') x
  WHERE v.pr = '3-MEDIUM'),
f AS (SELECT *, vid || '/' || fsid AS fid, tbl <> '' AND col <> '' AS has_source,
    CASE kind WHEN 'Column' THEN 'Source Column' WHEN 'Measure' THEN 'Measure' WHEN 'Aggregation' THEN 'Measure'
      WHEN 'CountRows' THEN 'Measure' ELSE 'Calculated Column' END AS ft,
    trim(regexp_replace(tbl, '[^A-Za-z0-9_-]', '_', 'g'), '_-') AS tsid,
    trim(regexp_replace(col, '[^A-Za-z0-9_-]', '_', 'g'), '_-') AS csid FROM f0),
s AS (SELECT *, uid || '/ds_' || tsid AS dsid, uid || '/ds_' || tsid || '/' || csid AS dfid, uid || '/' || tsid AS csetid,
    uid || '/' || tsid || '/' || csid AS celid FROM f WHERE has_source),
cap AS (SELECT tbl, col, ft FROM s QUALIFY row_number() OVER (PARTITION BY tbl, col ORDER BY report_name, spos, ord, pos, ft) = 1),
once AS (
  SELECT '$resource' AS source, uid AS target, 'core.ResourceParentChild' AS association FROM r
  UNION SELECT uid, section_id, 'custom.PowerBI.v3.ReportToSection' FROM sc
  UNION SELECT section_id, vid, 'custom.PowerBI.v3.SectionToVisual' FROM v
  UNION SELECT uid, dsid, 'custom.PowerBI.v3.ReportToDataset' FROM s
  UNION SELECT dsid, vid, 'core.DataSetDataFlow' FROM s
  UNION SELECT dsid, dfid, 'custom.PowerBI.v3.DatasetToField' FROM s
  UNION SELECT '$resource', uid || '/Reference_' || tsid, 'core.ResourceParentChild' FROM s
  UNION SELECT uid || '/Reference_' || tsid, uid || '/Connection_' || tsid, 'core.ResourceParentChild' FROM s
  UNION SELECT uid || '/Connection_' || tsid, csetid, 'core.DataSourceParentChild' FROM s
  UNION SELECT csetid, dsid, 'core.DataSetDataFlow' FROM s
  UNION SELECT csetid, celid, 'core.DataSetToDataElementParentship' FROM s
  UNION SELECT celid, dfid, 'core.DirectionalDataFlow' FROM s),
many AS (SELECT vid AS source, fid AS target, 'custom.PowerBI.v3.VisualToField' AS association FROM f
  UNION ALL SELECT dfid, fid, 'core.DirectionalDataFlow' FROM s),
ex AS (SELECT CASE WHEN c_custkey % 4 = 3 THEN 'model only ' || (c_custkey % 5) ELSE 'orders vw ' || substr('FOP', (c_custkey % 3 + 1)::INT, 1) END AS tbl,
    CASE WHEN c_custkey % 7 = 0 THEN 'o_totalprice' ELSE 'o_key ' || (c_custkey % 12) END AS fld,
    min(CASE WHEN c_mktsegment = 'BUILDING' THEN 'Measure' ELSE 'Source Column' END) AS et FROM customer GROUP BY 1, 2),
au AS (SELECT ex.tbl, fld, et, cap.ft, CASE WHEN cap.ft IS NULL THEN 'MISSING' WHEN cap.ft = et THEN 'CORRECT' ELSE 'PARTIAL' END AS status
  FROM ex LEFT JOIN cap ON cap.tbl = ex.tbl AND cap.col = ex.fld)
"""

_B = "custom.PowerBI.v3."

ORACLE = {
    "layouts_scan": MODEL
    + """SELECT report_name, CASE WHEN nk = 3 THEN 'no Report/Layout in file' END AS error,
  CASE WHEN nk <> 3 THEN (SELECT count(*) FROM sc WHERE sc.c = r.c) END AS sections FROM r""",
    "decode_layout": MODEL
    + """SELECT report_name, count(k) AS containers, count(*) FILTER (pr = '4-NOT SPECIFIED') AS plain_configs,
  count(*) FILTER (pr IN ('1-URGENT', '2-HIGH')) AS transforms FROM r LEFT JOIN o USING (c) GROUP BY report_name""",
    "report_sections": MODEL
    + "SELECT uid AS report_uid, spos AS section_pos, section_id, 'Status ' || st AS section_name FROM sc",
    "report_visuals": MODEL
    + "SELECT section_id, ord AS ordinal, vid AS visual_id, vname AS visual_name, vt AS visual_type FROM v",
    "visual_fields": MODEL
    + """SELECT vid AS visual_id, pos::BIGINT AS pos, fid AS field_id, fname AS field_name, descr AS description, ft AS field_type FROM f""",
    "field_sources": MODEL
    + """SELECT fid AS field_id, pos::BIGINT AS pos, tbl AS "table", col AS "column", has_source,
  kind IN ('Aggregation', 'HierarchyLevel') AS is_nested FROM f""",
    "report_assets": MODEL
    + f"""SELECT DISTINCT '{_B}Report' AS class, uid AS external_id, report_name AS name, report_name AS description, '' AS field_type, '' AS visual_type FROM r
UNION ALL SELECT '{_B}Section', section_id, 'Status ' || st, 'Status ' || st, '', '' FROM sc
UNION ALL SELECT '{_B}Visual', vid, vname, vname, '', vt FROM v
UNION ALL SELECT '{_B}Field', fid, fname, descr, ft, '' FROM f""",
    "report_datasets": MODEL
    + f"""SELECT DISTINCT '{_B}Dataset' AS class, dsid AS external_id, 'ds_' || tbl AS name, '' AS field_type FROM s
UNION ALL SELECT * FROM (SELECT '{_B}Field', dfid, col, ft FROM s
  QUALIFY row_number() OVER (PARTITION BY dfid ORDER BY spos, ord, pos) = 1)""",
    "report_reference_assets": MODEL
    + """SELECT 'core.Resource' AS class, uid || '/Reference_' || tsid AS external_id,
  CASE WHEN tbl = 'Owned_Table' THEN 'Own Reports' ELSE 'Reference_' || tbl END AS name, 'TRUE' AS reference, 'TRUE' AS assignable FROM s
UNION SELECT 'core.DataSource', uid || '/Connection_' || tsid, 'Connection_' || tbl, 'TRUE', 'TRUE' FROM s
UNION SELECT 'core.DataSet', csetid, tbl, 'TRUE', 'TRUE' FROM s
UNION SELECT 'core.DataElement', celid, col, 'TRUE', 'TRUE' FROM s""",
    "report_links": MODEL + "SELECT * FROM once UNION ALL SELECT * FROM many",
    "report_links_distinct": MODEL + "SELECT * FROM once UNION SELECT * FROM many",
    "field_breakdown": MODEL
    + """SELECT tbl AS "table", count(*) FILTER (ft = 'Source Column') AS source_columns, count(*) FILTER (ft = 'Measure') AS measures,
  count(*) FILTER (ft = 'Calculated Column') AS calculated_columns, count(*) AS total FROM cap GROUP BY tbl""",
    "coverage_audit": MODEL
    + 'SELECT tbl AS "table", fld AS field, et AS expected_type, ft AS captured_type, status FROM au',
    "coverage_summary": MODEL
    + """SELECT tbl AS "table", count(*) AS expected, count(*) FILTER (status = 'CORRECT') AS correct,
  count(*) FILTER (status = 'PARTIAL') AS partial, count(*) FILTER (status = 'MISSING') AS missing,
  bool_or(status <> 'MISSING') AS table_captured FROM au GROUP BY tbl""",
}

_PLACES = (
    MODEL
    + """, wanted AS (SELECT CASE WHEN o_orderkey % 60 = 0 THEN 'Archive' ELSE 'Status ' || o_orderstatus END AS page,
    CASE WHEN o_orderkey % 7 = 0 THEN 'slicer' WHEN o_orderkey % 3 = 0 THEN 'card' WHEN o_orderkey % 3 = 1 THEN 'table' END AS vt,
    CASE WHEN o_orderkey % 11 = 0 THEN 'model only' ELSE 'orders vw ' || o_orderstatus END AS tbl,
    CASE WHEN o_orderkey % 5 = 0 THEN 'o_totalprice' ELSE 'o_key ' || (o_orderkey % 12) END AS fld,
    min(CASE WHEN o_orderkey % 2 = 0 THEN 'Measure' ELSE 'Source Column' END) AS et
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') GROUP BY ALL),
shown AS (SELECT 'Status ' || st AS page, vt, tbl, col AS fld, string_agg(DISTINCT ft, ',' ORDER BY ft) AS fts, list(DISTINCT ft) AS l
  FROM s GROUP BY ALL),
places AS (SELECT coalesce(w.page, c.page) AS page, coalesce(w.vt, c.vt) AS visual_type, coalesce(w.tbl, c.tbl) AS "table",
    coalesce(w.fld, c.fld) AS field, et AS expected_type, coalesce(fts, '') AS captured_types,
    CASE WHEN w.page IS NULL THEN 'UNEXPECTED' WHEN c.page IS NULL THEN 'MISSING' WHEN list_contains(l, et) THEN 'CORRECT' ELSE 'PARTIAL' END AS status
  FROM wanted w FULL OUTER JOIN shown c ON w.page = c.page AND w.vt IS NOT DISTINCT FROM c.vt AND w.tbl = c.tbl AND w.fld = c.fld)
"""
)
ORACLE["coverage_places"] = _PLACES + "SELECT * FROM places"
ORACLE["coverage_grains"] = (
    _PLACES
    + """SELECT CASE WHEN grouping("table") = 0 THEN 'table' WHEN grouping(visual_type) = 0 THEN 'visual' ELSE 'page' END AS grain,
  "table", page, visual_type, count(*) FILTER (status <> 'UNEXPECTED') AS expected, count(*) FILTER (status = 'CORRECT') AS correct,
  count(*) FILTER (status = 'PARTIAL') AS partial, count(*) FILTER (status = 'MISSING') AS missing,
  count(*) FILTER (status = 'UNEXPECTED') AS unexpected, bool_or(status <> 'MISSING') AS captured
FROM places GROUP BY GROUPING SETS (("table"), (page), (page, visual_type))"""
)
