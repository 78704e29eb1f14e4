"""SQL script corpora and metadata."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.adapters import scripts as adapter
from lineweft.config import LineageConfig
from lineweft.operators import metadata as M
from lineweft.operators import scripts as S
from lineweft.session import shared_folder
from lineweft.sources import scripts as sources

CONFIG = LineageConfig(source_resource="src_res", target_resource="tgt_res")


def _statements(spark: SparkSession, folder: str) -> DataFrame:
    return S.statements(adapter.script_files(spark, folder))


def _refs(spark: SparkSession, folder: str) -> DataFrame:
    return S.table_refs(_statements(spark, folder), CONFIG)


def _facts(spark: SparkSession, folder: str, separator: str = "/") -> DataFrame:
    return S.prepare_facts(adapter.lineage_facts(spark, folder), CONFIG, separator)


def scripts_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Scripts written as files and read back by the scan."""
    path = f"{shared_folder(spark)}/lineweft-scripts-{uuid.uuid4().hex}"
    adapter.write_script_files(adapter.script_files(spark, folder), path)
    files = sources.read_scripts(spark, path)
    return files.select("file", F.char_length("text").cast("bigint").alias("chars"), F.md5("text").alias("digest"))


def clean_sql(spark: SparkSession, folder: str) -> DataFrame:
    return adapter.script_files(spark, folder).select("file", S.clean_sql(F.col("text")).alias("sql"))


def table_refs(spark: SparkSession, folder: str) -> DataFrame:
    refs = _refs(spark, folder)
    roles = F.concat(
        F.transform("targets", lambda t: F.struct(F.lit("target").alias("role"), t.alias("table"))),
        F.transform("sources", lambda s: F.struct(F.lit("source").alias("role"), s.alias("table"))),
    )
    return refs.select("file", "stmt_no", "state", F.explode_outer(roles).alias("r")).select(
        "file", "stmt_no", "state", "r.role", "r.table"
    )


def star_refs(spark: SparkSession, folder: str) -> DataFrame:
    return _facts(spark, folder).select("task", "stmt_no", "src_dataset", "src_column", "tgt_dataset", "tgt_column")


def script_columns(spark: SparkSession, folder: str) -> DataFrame:
    return S.script_columns(_facts(spark, folder))


def script_assets(spark: SparkSession, folder: str) -> DataFrame:
    assets = S.script_assets(_refs(spark, folder), S.script_columns(_facts(spark, folder)), CONFIG)
    return assets.select(
        "class", "external_id", "name", "reference", "assignable", F.get("attrs", 0)["value"].alias("sql")
    )


def script_reference_assets(spark: SparkSession, folder: str) -> DataFrame:
    return S.script_reference_assets(_refs(spark, folder), _facts(spark, folder), CONFIG)


def script_links(spark: SparkSession, folder: str) -> DataFrame:
    facts = _facts(spark, folder)
    return S.script_links(_refs(spark, folder), facts, S.script_columns(facts), CONFIG)


def published_ids(spark: SparkSession, folder: str) -> DataFrame:
    facts = _facts(spark, folder)
    ids = facts.select("task", F.explode(F.array("src_element", "tgt_element", "src_dataset")).alias("raw_id")).distinct()
    return S.published_ids(ids, S.known_sources(facts))


def referenced_resources(spark: SparkSession, folder: str) -> DataFrame:
    ids = _facts(spark, folder).select(F.explode(F.array("src_dataset", "tgt_dataset")).alias("raw_id"))
    config = LineageConfig(source_resource="src_res", target_resource="tgt_res", excluded_resource="tgt_res")
    return S.referenced_resources(ids, config).unionByName(S.referenced_resources(ids, CONFIG))


def script_stats(spark: SparkSession, folder: str) -> DataFrame:
    assets = S.script_assets(_refs(spark, folder), S.script_columns(_facts(spark, folder)), CONFIG)
    return S.script_stats(_refs(spark, folder), adapter.lineage_facts(spark, folder), assets)


def manifest_scan(spark: SparkSession, folder: str) -> DataFrame:
    return sources.load_manifest(adapter.manifests(spark, folder))


def metadata_feed(spark: SparkSession, folder: str) -> DataFrame:
    documents = adapter.manifests(spark, folder).withColumn("document", F.col("file"))
    feed = sources.load_metadata(documents, F.col("current.sources"))
    return feed.withColumn("pos", F.col("pos").cast("bigint"))


def seed_columns(spark: SparkSession, folder: str) -> DataFrame:
    return M.seed_columns(_refs(spark, folder), adapter.table_metadata(spark, folder), CONFIG)


def derived_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return M.derived_metadata(_facts(spark, folder))


def merge_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return M.merge_metadata([M.derived_metadata(_facts(spark, folder)), adapter.table_metadata(spark, folder)])


def metadata_diff(spark: SparkSession, folder: str) -> DataFrame:
    return M.metadata_diff(M.derived_metadata(_facts(spark, folder)), adapter.table_metadata(spark, folder))


def star_fixpoint(spark: SparkSession, folder: str) -> DataFrame:
    return M.star_fixpoint(adapter.chain_metadata(spark, folder), adapter.star_chains(spark, folder))


QUERIES = {
    "scripts_scan": scripts_scan,
    "clean_sql": clean_sql,
    "statements": _statements,
    "table_refs": table_refs,
    "unparsed_sql": lambda spark, folder: S.unparsed_sql(_refs(spark, folder), CONFIG),
    "script_dataset_flow": lambda spark, folder: S.script_dataset_flow(_refs(spark, folder), CONFIG),
    "facts_to_edges": lambda spark, folder: S.facts_to_edges(_facts(spark, folder)),
    "star_refs": star_refs,
    "published_ids": published_ids,
    "referenced_resources": referenced_resources,
    "script_columns": script_columns,
    "script_assets": script_assets,
    "script_reference_assets": script_reference_assets,
    "script_links": script_links,
    "root_links": lambda spark, folder: S.root_links(_refs(spark, folder), _facts(spark, folder), CONFIG),
    "script_job_links": lambda spark, folder: S.script_job_links(
        _refs(spark, folder), _facts(spark, folder, "."), CONFIG
    ),
    "script_stats": script_stats,
    "manifest_scan": manifest_scan,
    "metadata_feed": metadata_feed,
    "seed_columns": seed_columns,
    "derived_metadata": derived_metadata,
    "merge_metadata": merge_metadata,
    "metadata_diff": metadata_diff,
    "star_fixpoint": star_fixpoint,
}

# Per statement: its text as written and as cleaned, its state, target and sources.
_STATEMENTS = """
WITH raw AS (
  SELECT p_partkey AS p, 's_' || p_partkey || '.sql' AS file, i, txt, cleaned, state, targets, sources FROM part, LATERAL (
    SELECT 1 AS i, 'CREATE VIEW lake.stg_' || (p_partkey % 20) || '.v_' || p_partkey || ' SECURITY INVOKER AS' || e'\\n\\nSELECT *\\n\\nFROM\\n\\n  lake.raw_' || (p_partkey % 7) || '.t_' || p_partkey AS txt,
      'CREATE VIEW lake.stg_' || (p_partkey % 20) || '.v_' || p_partkey || ' AS' || e'\\n\\nSELECT *\\n\\nFROM\\n\\n  lake.raw_' || (p_partkey % 7) || '.t_' || p_partkey AS cleaned,
      'usable' AS state, ['lake.stg_' || (p_partkey % 20) || '.v_' || p_partkey] AS targets,
      ['lake.raw_' || (p_partkey % 7) || '.t_' || p_partkey] AS sources
    UNION ALL SELECT 2, x, x, 'usable', ['mart.agg_' || (p_partkey % 10)], ['<default>.stage_' || p_partkey, 'ref.brands']
      FROM (SELECT 'INSERT INTO mart.agg_' || (p_partkey % 10) || e'\\nSELECT a.brand, COUNT(*) AS c\\nFROM stage_' || p_partkey
        || e' a\\nJOIN `ref`.`brands` b ON a.brand = b.brand -- from hidden.comment_table' AS x) WHERE p_size % 2 = 0
    UNION ALL SELECT 3, x, x, 'usable', ['mart.best_' || p_partkey], ['raw.ev_' || p_partkey, 'dim.cal']
      FROM (SELECT 'WITH recent AS (SELECT * FROM raw.ev_' || p_partkey
        || e'),\\n  best AS (SELECT * FROM Recent, dim.cal d WHERE d.note = ''from lost.place'')\\nINSERT OVERWRITE TABLE mart.best_'
        || p_partkey || ' SELECT * FROM best' AS x) WHERE p_size % 3 = 0
    UNION ALL SELECT 4, x, x, 'usable', ['<default>.run_date_' || p_partkey], []
      FROM (SELECT 'CREATE OR REPLACE TEMPORARY VIEW run_date_' || p_partkey || ' AS SELECT CURRENT_DATE() AS run_date' AS x)
      WHERE p_size % 5 = 0
    UNION ALL SELECT 5, x, x, 'unparsed', [], [] FROM (SELECT 'DROP TABLE IF EXISTS tmp_' || p_partkey AS x)
      WHERE p_size % 7 = 0
    UNION ALL SELECT 6, x, x, 'ambiguous', ['out.a_' || p_partkey, 'out.b_' || p_partkey], ['raw.src_' || p_partkey]
      FROM (SELECT 'FROM raw.src_' || p_partkey || ' INSERT INTO out.a_' || p_partkey || ' SELECT x INSERT INTO out.b_'
        || p_partkey || ' SELECT y' AS x) WHERE p_size % 11 = 0
    UNION ALL SELECT 7, 'CREATE FUNCTION f_' || p_partkey || '(x INT) RETURNS STRUCT(a INT, b INT) USING LANGUAGE python RETURN x',
      'CREATE FUNCTION f_' || p_partkey || '(x INT) RETURN x', 'unparsed', [], [] WHERE p_size % 13 = 0) u),
st AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY i) AS stmt_no FROM raw),
files AS (SELECT file, string_agg(txt, e';\\n ; \\n' ORDER BY i) || e';\\n\\n' AS txt,
  string_agg(cleaned, e';\\n ; \\n' ORDER BY i) || e';\\n\\n' AS cleaned FROM st GROUP BY file),
us AS (SELECT *, 'script_repo/script_schema/' || file || '/statement_' || stmt_no AS sid, targets[1] AS tgt
  FROM st WHERE state = 'usable'),
srcs AS (SELECT file, sid, unnest(sources) AS src FROM us)
"""

_FACTS = """
f0 AS (SELECT DISTINCT 's_' || l_partkey || '.sql' AS task,
    (CASE WHEN l_linenumber = 7 AND l_suppkey % 2 = 0 THEN 9 ELSE l_linenumber % 3 + 1 END)::BIGINT AS stmt_no,
    CASE l_returnflag WHEN 'N' THEN '<default>' WHEN 'A' THEN 'lake.raw_' || (l_partkey % 7) ELSE 'erp' END AS ss,
    CASE l_returnflag WHEN 'A' THEN 't_' || l_partkey ELSE 'stage_' || (l_suppkey % 5) END AS stb,
    CASE WHEN l_linenumber >= 6 THEN '*' WHEN l_linestatus = 'O' THEN 'C_' || (l_suppkey % 4) ELSE 'c_' || (l_suppkey % 4) END AS sc,
    CASE WHEN l_linestatus = 'O' THEN 'mart' ELSE '<default>' END AS ts, 'agg_' || (l_partkey % 10) AS ttb,
    CASE l_linenumber WHEN 7 THEN '*' WHEN 6 THEN 'cnt' ELSE 'd_' || (l_orderkey % 3) END AS tc FROM lineitem),
f1 AS (SELECT * FROM f0 QUALIFY NOT (sc = '*' AND tc = '*' AND count(*) OVER (PARTITION BY task, stmt_no) > 1)),
fx AS (SELECT *, 'script_repo/script_schema/' || task || '/statement_' || stmt_no AS sid,
    CASE WHEN sc = '*' THEN stb || '.*' ELSE sc END AS scn, CASE WHEN tc = '*' THEN ttb || '.*' ELSE tc END AS tcn,
    'src_res/' || replace(ss, '.', '/') AS s_source, 'tgt_res/' || replace(ts, '.', '/') AS t_source FROM f1),
f AS (SELECT *, s_source || '/' || stb AS s_ds, t_source || '/' || ttb AS t_ds, s_source || '/' || stb || '/' || scn AS s_el,
    t_source || '/' || ttb || '/' || tcn AS t_el, sid || '/' || tcn AS cal,
    'REFERENCE_' || translate(upper(replace(ss, '.', '_')), '<>', '') || '_CONN' AS s_conn,
    'REFERENCE_' || translate(upper(ts), '<>', '') || '_CONN' AS t_conn FROM fx),
kn AS (SELECT DISTINCT task, s_source AS source_id, s_conn AS conn,
    translate(split_part(s_source, '/', -1), '<>', '') AS label FROM f
  UNION SELECT DISTINCT task, t_source, t_conn, translate(ts, '<>', '') FROM f),
ids AS (SELECT DISTINCT task, s_ds AS raw_id FROM f UNION SELECT task, t_ds FROM f
  UNION SELECT task, s_el FROM f UNION SELECT task, t_el FROM f)
"""

_PUBLISHED = """
pub AS (SELECT i.task, i.raw_id, coalesce(kn.conn || '_DS' || substr(i.raw_id, length(kn.source_id) + 1), i.raw_id) AS final
  FROM allids i LEFT JOIN kn ON kn.task = i.task AND (i.raw_id = kn.source_id OR starts_with(i.raw_id, kn.source_id || '/'))
  QUALIFY row_number() OVER (PARTITION BY i.task, i.raw_id ORDER BY length(kn.source_id) DESC NULLS LAST) = 1)
"""

# Everything that scripts and facts publish, by task.
GRAPH = (
    _STATEMENTS
    + ","
    + _FACTS
    + """,
dsets AS (SELECT file AS task, 'src_res/' || replace(src, '.', '/') AS raw_id FROM srcs
  UNION SELECT file, 'tgt_res/' || replace(tgt, '.', '/') FROM us
  UNION SELECT task, s_ds FROM f UNION SELECT task, t_ds FROM f),
els AS (SELECT task, s_ds AS ds, scn AS col, s_el AS raw_id FROM f UNION SELECT task, t_ds, tcn, t_el FROM f),
par AS (SELECT task, raw_id, left(raw_id, length(raw_id) - length(split_part(raw_id, '/', -1)) - 1) AS parent FROM dsets),
allids AS (SELECT task, raw_id FROM dsets UNION SELECT task, parent FROM par UNION SELECT task, raw_id FROM els),
"""
    + _PUBLISHED
    + """,
cols AS (SELECT DISTINCT task, sid, cal, tcn FROM f),
colx AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY cal) AS ordinal FROM cols),
coly AS (SELECT *, 'SQLSCRIPT_COLUMN_' || ordinal || '_' ||
    trim(upper(regexp_replace(cal, '[^A-Za-z0-9]+', '_', 'g')), '_') AS external_id FROM colx),
scr AS (SELECT file AS task, sid, 'statement_' || stmt_no AS name, cleaned AS sql,
    'SQLSCRIPT_' || trim(upper(regexp_replace(sid, '[^A-Za-z0-9]+', '_', 'g')), '_') AS external_id,
    'SQLPARSER_' || trim(upper(regexp_replace(file, '[^A-Za-z0-9]+', '_', 'g')), '_') AS parser FROM us),
prs AS (SELECT DISTINCT file, 'SQLPARSER_' || trim(upper(regexp_replace(file, '[^A-Za-z0-9]+', '_', 'g')), '_') AS parser FROM st),
tflow AS (SELECT file AS task, 'src_res/' || replace(src, '.', '/') AS source, sid AS target FROM srcs
  UNION SELECT file, sid, 'tgt_res/' || replace(tgt, '.', '/') FROM us),
fflow AS (SELECT task, s_ds AS source, sid AS target FROM f UNION SELECT task, sid, t_ds FROM f),
cflow AS (SELECT task, s_el AS source, cal AS target FROM f UNION SELECT task, cal, t_el FROM f),
rawl AS (SELECT task, parent AS source, raw_id AS target, 'core.DataSourceParentChild' AS association FROM par
  UNION SELECT task, ds, raw_id, 'core.DataSetToDataElementParentship' FROM els
  UNION SELECT task, source, target, 'core.DataSetDataFlow' FROM tflow
  UNION SELECT task, source, target, 'core.DataSetDataFlow' FROM fflow
  UNION SELECT task, source, target, 'core.DirectionalDataFlow' FROM cflow),
idm AS (SELECT task, raw_id, final FROM pub UNION ALL SELECT task, sid, external_id FROM scr
  UNION ALL SELECT task, cal, external_id FROM coly),
links AS (SELECT coalesce(a.final, l.source) AS source, coalesce(b.final, l.target) AS target, association
    FROM rawl l LEFT JOIN idm a ON a.task = l.task AND a.raw_id = l.source
    LEFT JOIN idm b ON b.task = l.task AND b.raw_id = l.target
  UNION SELECT '$RESOURCE', parser, 'core.ResourceParentChild' FROM prs
  UNION SELECT parser, external_id, 'custom.sqlparser.SQLParserToSQLScript' FROM scr
  UNION SELECT scr.external_id, coly.external_id, 'custom.sqlparser.SQLScriptToSQLScriptColumn' FROM coly JOIN scr USING (sid)
  UNION SELECT conn, conn || '_DS', 'core.ResourceParentChild' FROM kn),
assets AS (SELECT 'custom.sqlparser.SQLParser' AS class, parser AS external_id, file AS name, '' AS reference,
    'TRUE' AS assignable, NULL AS sql FROM prs
  UNION ALL SELECT 'custom.sqlparser.SQLScript', external_id, name, '', '', sql FROM scr
  UNION ALL SELECT 'custom.sqlparser.SQLScriptColumn', external_id, tcn, '', '', NULL FROM coly)
"""
)

_CHAIN = """
WITH RECURSIVE e AS (
  SELECT CASE WHEN i = 1 THEN 'base.t_' || p_partkey ELSE 'view.v_' || p_partkey || '_' || (i - 1) END AS a,
    'view.v_' || p_partkey || '_' || i AS b
  FROM part, LATERAL (SELECT unnest(range(1, p_size % 6 + 2)) AS i) u
  UNION SELECT 'view.v_' || p_partkey || '_' || (p_size % 6 + 1), 'view.v_' || p_partkey || '_1' FROM part WHERE p_size % 5 = 0),
m AS (SELECT 'base.t_' || p_partkey AS t, 0 AS pos, 'Id' AS c FROM part UNION ALL SELECT 'base.t_' || p_partkey, 1, p_type FROM part
  UNION ALL SELECT 'base.t_' || p_partkey, 2, p_brand FROM part
  UNION ALL SELECT 'view.v_' || p_partkey || '_2', 0, lower(p_type) FROM part
  UNION ALL SELECT 'view.v_' || p_partkey || '_2', 1, 'extra' FROM part),
k0 AS (SELECT t, lower(c) AS ck, arg_min(c, pos * 1000) AS c FROM m GROUP BY ALL),
r(t, ck, c, d) AS (SELECT t, ck, c, 0 FROM k0
  UNION SELECT e.b, r.ck, r.c, r.d + 1 FROM r JOIN e ON e.a = r.t WHERE r.d < 8)
SELECT t AS "table", ck AS column_key, c AS "column", d::BIGINT AS round FROM r
QUALIFY row_number() OVER (PARTITION BY t, ck ORDER BY d, c) = 1"""

_METADATA = """
md AS (SELECT t AS tbl, pos, c FROM (
  SELECT unnest(['<default>.stage_' || p_partkey, 'lake.raw_' || (p_partkey % 7) || '.t_' || p_partkey, 'erp.unused_' || p_partkey]) AS t,
    p_brand, p_type FROM part), LATERAL (VALUES (0, 'brand'), (1, p_type), (2, 'BRAND'), (3, p_brand), (4, 'c_1')) v(pos, c)),
dm AS (SELECT ss || '.' || stb AS tbl, scn AS c FROM f WHERE scn NOT LIKE '%.*'
  UNION SELECT ts || '.' || ttb, tcn FROM f WHERE tcn NOT LIKE '%.*')
"""

ORACLE = {
    "scripts_scan": _STATEMENTS + "SELECT file, length(txt) AS chars, md5(txt) AS digest FROM files",
    "clean_sql": _STATEMENTS + "SELECT file, cleaned AS sql FROM files",
    "statements": _STATEMENTS + "SELECT file, stmt_no, cleaned AS sql FROM st",
    "table_refs": _STATEMENTS
    + """, rl AS (SELECT file, stmt_no, 'target' AS role, unnest(targets) AS tbl FROM st
  UNION ALL SELECT file, stmt_no, 'source', unnest(sources) FROM st)
SELECT st.file, st.stmt_no, state, role, tbl AS "table" FROM st LEFT JOIN rl ON rl.file = st.file AND rl.stmt_no = st.stmt_no""",
    "unparsed_sql": _STATEMENTS
    + "SELECT DISTINCT 'script_repo/script_schema/' || file AS task, cleaned AS sql FROM st WHERE state <> 'usable'",
    "script_dataset_flow": _STATEMENTS
    + """SELECT 'src_res/' || replace(src, '.', '/') AS source, sid AS target, 'core.DataSetDataFlow' AS association FROM srcs
UNION SELECT sid, 'tgt_res/' || replace(tgt, '.', '/'), 'core.DataSetDataFlow' FROM us""",
    "facts_to_edges": "WITH "
    + _FACTS
    + """SELECT 'column' AS kind, s_el AS source, cal AS target FROM f UNION SELECT 'column', cal, t_el FROM f
UNION SELECT 'dataset', s_ds, sid FROM f UNION SELECT 'dataset', sid, t_ds FROM f
UNION SELECT 'direct_column', s_el, t_el FROM f UNION SELECT 'direct_dataset', s_ds, t_ds FROM f""",
    "star_refs": "WITH "
    + _FACTS
    + """SELECT task, stmt_no, s_ds AS src_dataset, scn AS src_column, t_ds AS tgt_dataset, tcn AS tgt_column FROM f""",
    "published_ids": "WITH "
    + _FACTS
    + """, allids AS (SELECT task, s_el AS raw_id FROM f UNION SELECT task, t_el FROM f UNION SELECT task, s_ds FROM f), """
    + _PUBLISHED
    + "SELECT task, raw_id, final AS published_id FROM pub",
    "referenced_resources": "WITH "
    + _FACTS
    + """, u AS (SELECT DISTINCT split_part(raw_id, '/', 1) AS r FROM ids)
SELECT r AS external_id, replace(r, '/', '.') AS name, 'false' AS reference, 'TRUE' AS assignable FROM u WHERE r <> 'tgt_res'
UNION ALL SELECT r, replace(r, '/', '.'), 'false', 'TRUE' FROM u""",
    "script_columns": GRAPH
    + """SELECT task, sid AS statement_id, cal AS calculation_id, tcn AS "column", ordinal, external_id FROM coly""",
    "script_assets": GRAPH + "SELECT * FROM assets",
    "script_reference_assets": GRAPH
    + """SELECT 'core.Resource' AS class, r AS external_id, r AS name, 'false' AS reference, 'TRUE' AS assignable
  FROM (SELECT DISTINCT split_part(raw_id, '/', 1) AS r FROM dsets)
UNION ALL SELECT 'core.Resource', conn, arg_min(label, source_id), 'true', 'TRUE' FROM kn GROUP BY conn
UNION ALL SELECT DISTINCT 'core.DataSource', conn || '_DS', label, 'TRUE', 'TRUE' FROM kn
UNION ALL SELECT DISTINCT 'core.DataSet', final, split_part(raw_id, '/', -1), 'TRUE', 'TRUE' FROM dsets JOIN pub USING (task, raw_id)
UNION ALL SELECT DISTINCT 'core.DataElement', final, col, 'TRUE', 'TRUE' FROM els JOIN pub USING (task, raw_id)""",
    "script_links": GRAPH + "SELECT * FROM links",
    "root_links": GRAPH
    + """SELECT '$RESOURCE' AS source, r AS target, 'core.ResourceParentChild' AS association
  FROM (SELECT DISTINCT split_part(raw_id, '/', 1) AS r FROM dsets UNION SELECT conn FROM kn)
UNION SELECT conn, conn || '_DS', 'core.ResourceParentChild' FROM kn""",
    "script_job_links": _STATEMENTS
    + ","
    + _FACTS
    + """, g AS (SELECT *, 'src_res.' || ss AS s1, 'tgt_res.' || ts AS t1 FROM f),
dd AS (SELECT 'src_res.' || replace(src, '.', '/') AS d FROM srcs UNION SELECT 'tgt_res.' || replace(tgt, '.', '/') FROM us)
SELECT * FROM (VALUES ('$resource', 'src_res', 'core.ResourceParentChild'), ('$resource', 'tgt_res', 'core.ResourceParentChild'),
  ('$resource', 'script_repo', 'core.ResourceParentChild'), ('src_res', 'src_res.<default>', 'core.ResourceParentChild'),
  ('tgt_res', 'tgt_res.<default>', 'core.ResourceParentChild'),
  ('script_repo', 'script_repo/script_schema', 'com.infa.odin.models.relational.DatabaseToSchema')) v(source, target, association)
UNION SELECT 'script_repo/script_schema', 'script_repo/script_schema/' || file, 'com.infa.odin.models.relational.SchemaToTask' FROM st
UNION SELECT 'script_repo/script_schema/' || file, sid, 'com.infa.odin.models.relational.TaskToStatement' FROM us
UNION SELECT left(d, length(d) - length(split_part(d, '/', -1)) - 1), d, 'core.DataSourceParentChild' FROM dd
UNION SELECT 'src_res.' || replace(src, '.', '/'), sid, 'core.DataSetDataFlow' FROM srcs
UNION SELECT sid, 'tgt_res.' || replace(tgt, '.', '/'), 'core.DataSetDataFlow' FROM us
UNION SELECT 'src_res', s1, 'core.ResourceParentChild' FROM g UNION SELECT 'tgt_res', t1, 'core.ResourceParentChild' FROM g
UNION SELECT s1, s1 || '/' || stb, 'core.DataSourceParentChild' FROM g
UNION SELECT t1, t1 || '/' || ttb, 'core.DataSourceParentChild' FROM g
UNION SELECT s1 || '/' || stb, s1 || '/' || stb || '/' || scn, 'core.DataSetToDataElementParentship' FROM g
UNION SELECT t1 || '/' || ttb, t1 || '/' || ttb || '/' || tcn, 'core.DataSetToDataElementParentship' FROM g
UNION SELECT sid, cal, 'com.infa.odin.models.relational.StatementToCalculation' FROM g
UNION SELECT s1 || '/' || stb || '/' || scn, cal, 'core.DirectionalDataFlow' FROM g
UNION SELECT cal, t1 || '/' || ttb || '/' || tcn, 'core.DirectionalDataFlow' FROM g""",
    "script_stats": GRAPH
    + """SELECT 'statements ' || state AS metric, count(*) AS value FROM st GROUP BY ALL
UNION ALL SELECT 'statements with column lineage', count(DISTINCT (task, stmt_no)) FROM f0
UNION ALL SELECT 'rows ' || class, count(*) FROM assets GROUP BY ALL""",
    "manifest_scan": """
SELECT CASE WHEN p_size % 4 <> 0 THEN 'job_' || p_partkey ELSE 'default' END AS task, 1::BIGINT AS stmt_no,
  'select 1 from t_' || p_partkey AS sql FROM part
UNION ALL SELECT CASE WHEN p_size % 4 <> 0 THEN 'job_' || p_partkey ELSE 'default' END, 2,
  'select ' || p_size || ' from u_' || p_partkey FROM part""",
    "metadata_feed": """
WITH e AS (
  SELECT 'm_' || p_partkey || '.json' AS document, x.o, '<default>.' || x.n AS tbl, x.cols FROM part, LATERAL (
    SELECT 1 AS o, 't_' || p_partkey AS n, ['id', 'old'] AS cols
    UNION ALL SELECT 2, 'u_' || p_partkey, ['id', p_brand]
    UNION ALL SELECT 3, 'v_' || p_partkey, ['id', p_brand] WHERE p_size % 2 = 0
    UNION ALL SELECT 4, 't_' || p_partkey, ['Key', 'new'] WHERE p_size % 3 = 0
    UNION ALL SELECT 5, 'w_' || p_partkey, ['Key', 'new']) x
  QUALIFY row_number() OVER (PARTITION BY document, tbl ORDER BY x.o DESC) = 1)
SELECT document, tbl AS "table", (i - 1)::BIGINT AS pos, cols[i] AS "column" FROM e, LATERAL (SELECT unnest([1, 2]) AS i) u""",
    "seed_columns": _STATEMENTS
    + ","
    + _FACTS
    + ","
    + _METADATA
    + """, t AS (SELECT 'src_res' AS r, src AS tbl FROM srcs UNION SELECT 'tgt_res', tgt FROM us)
SELECT DISTINCT r || '.' || replace(tbl, '.', '/') AS table_id, r || '.' || replace(tbl, '.', '/') || '/' || c AS element_id,
  tbl AS "table", c AS "column" FROM t JOIN md USING (tbl)""",
    "derived_metadata": "WITH " + _FACTS + "," + _METADATA + """SELECT tbl AS "table", c AS "column" FROM dm""",
    "merge_metadata": "WITH "
    + _FACTS
    + ","
    + _METADATA
    + """, u AS (SELECT tbl, c, 0 AS pos, 0 AS rk FROM dm UNION ALL SELECT tbl, c, pos, 1 FROM md)
SELECT tbl AS "table", lower(c) AS column_key, c AS "column", rk::BIGINT AS source_rank FROM u
QUALIFY row_number() OVER (PARTITION BY tbl, lower(c) ORDER BY rk, pos, c) = 1""",
    "metadata_diff": "WITH "
    + _FACTS
    + ","
    + _METADATA
    + """, a AS (SELECT DISTINCT tbl, lower(c) AS k FROM dm), b AS (SELECT DISTINCT tbl, lower(c) AS k FROM md)
SELECT coalesce(a.tbl, b.tbl) AS "table", coalesce(a.k, b.k) AS column_key, CASE WHEN b.k IS NULL THEN 'left' ELSE 'right' END AS side
FROM a FULL JOIN b ON a.tbl = b.tbl AND a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""",
    "star_fixpoint": _CHAIN,
}
