"""Event lineage and event diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.adapters import events as adapter
from lineweft.adapters.tables import table
from lineweft.functions import names as N
from lineweft.operators import diagnostics as D
from lineweft.operators import events as E
from lineweft.sources.events import number_lines, parse_events


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return parse_events(adapter.event_lines(spark, folder))


def _derived(spark: SparkSession, folder: str) -> DataFrame:
    return E.derive(_events(spark, folder))


def _of_derived(operator):
    return lambda spark, folder: operator(_derived(spark, folder))


def _of_events(operator):
    return lambda spark, folder: operator(_events(spark, folder))


def events_scan(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_events(number_lines(adapter.event_files(spark, folder)))
    return parsed.select("file", "line_number", "is_valid", F.col("event.run.runId").alias("run_id"))


def _odd_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every fourth event has a text and a number among its inputs, every sixth an array among its outputs."""
    value = F.when(F.col("line_number") % 4 == 0, F.regexp_replace("value", r'"inputs":\[(?=\{)', '"inputs":["stray",7,')).otherwise(F.col("value"))
    value = F.when(F.col("line_number") % 6 == 0, F.regexp_replace(value, r'"outputs":\[(?=\{)', '"outputs":[["x"],')).otherwise(value)
    return parse_events(adapter.event_lines(spark, folder).withColumn("value", value))


def odd_events_scan(spark: SparkSession, folder: str) -> DataFrame:
    events = _odd_events(spark, folder)
    return events.select("file", "line_number", "is_valid", F.col("event.run.runId").alias("run_id"), "ill_typed")


def odd_event_links(spark: SparkSession, folder: str) -> DataFrame:
    return E.event_links(E.derive(_odd_events(spark, folder)))


def odd_event_problems(spark: SparkSession, folder: str) -> DataFrame:
    return D.event_problems(_odd_events(spark, folder))


def lineage_ready_events(spark: SparkSession, folder: str) -> DataFrame:
    ready = E.lineage_ready_events(_events(spark, folder))
    return ready.select(
        "file",
        "line_number",
        F.col("event.run.runId").alias("run_id"),
        F.size("event.inputs").cast("bigint").alias("inputs_count"),
        F.size("event.outputs").cast("bigint").alias("outputs_count"),
    )


def _bigints(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in columns else F.col(c) for c in df.columns])


def event_datasets(spark: SparkSession, folder: str) -> DataFrame:
    return _bigints(E.event_datasets(_derived(spark, folder)), "pos")


def flatten_fields(spark: SparkSession, folder: str) -> DataFrame:
    return _bigints(E.flatten_fields(_derived(spark, folder)), "dataset_pos")


def job_assets(spark: SparkSession, folder: str) -> DataFrame:
    flat = E.job_assets(_derived(spark, folder))
    return flat.select(
        "class", "external_id", "name", "reference", "assignable", F.get("attrs", 0)["value"].alias("statement_text")
    )


def physical_assets(spark: SparkSession, folder: str) -> DataFrame:
    return E.physical_assets(_derived(spark, folder)).drop("attrs")


def event_links(spark: SparkSession, folder: str) -> DataFrame:
    return E.event_links(_derived(spark, folder))


def source_override(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part", "p_partkey", "p_brand", "p_type", "p_size")
    sources = parts.select(
        F.concat(F.lit("res_"), (F.col("p_size") % 4).cast("string")).alias("resource_id"),
        F.concat(F.col("p_type"), F.lit("_"), F.col("p_partkey").cast("string")).alias("db"),
        F.concat(F.lit("res."), F.col("p_partkey").cast("string")).alias("external_id"),
        F.concat(F.lit("res."), F.col("p_partkey").cast("string")).alias("name"),
    )
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus")
    typed = lines.join(parts.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    mapping = typed.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("pos"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("RES_"), (F.col("l_linenumber") % 4).cast("string"))).alias(
            "resource_id"
        ),
        F.concat(F.lower("p_type"), F.lit("_"), F.col("l_partkey").cast("string")).alias("db"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("cat."), F.col("l_orderkey").cast("string"))).alias(
            "external_id"
        ),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("name "), F.col("l_orderkey").cast("string"))).alias("name"),
    )
    return E.source_override(sources, _one_per_position(mapping))


def _one_per_position(mapping: DataFrame) -> DataFrame:
    columns = [c for c in mapping.columns if c not in ("pos", "db")]
    return (
        mapping.groupBy("pos", "db")
        .agg(F.max(F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])).alias("m"))
        .select("pos", "db", *[N.blank_to_null(F.col(f"m.{c}")).alias(c) for c in columns])
    )


def corpus_compare(spark: SparkSession, folder: str) -> DataFrame:
    lines = adapter.event_lines(spark, folder).join(
        table(spark, folder, "orders", (F.col("o_orderkey") + 1).alias("line_number"), "o_orderdate"), "line_number"
    )
    early = F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp")
    columns = ["file", "line_number", "value"]
    return D.corpus_compare(
        parse_events(lines.where(early).select(*columns)), parse_events(lines.where(~early).select(*columns))
    )


def problem_reasons(spark: SparkSession, folder: str) -> DataFrame:
    problems = D.event_problems(_events(spark, folder))
    return problems.groupBy("error_type", "reason_description").agg(F.count("*").alias("events"))


QUERIES = {
    "events_scan": events_scan,
    "odd_events_scan": odd_events_scan,
    "odd_event_links": odd_event_links,
    "odd_event_problems": odd_event_problems,
    "lineage_ready_events": lineage_ready_events,
    "job_ids": _of_derived(E.job_ids),
    "event_datasets": event_datasets,
    "flatten_fields": flatten_fields,
    "field_lookup": _of_derived(E.field_lookup),
    "dataset_columns": _of_derived(E.dataset_columns),
    "dataset_flow": _of_derived(E.dataset_flow),
    "direct_inputs": _of_derived(E.direct_inputs),
    "resolve_columns": _of_derived(E.resolve_columns),
    "column_lineage": _of_derived(E.column_lineage),
    "physical_assets": physical_assets,
    "job_assets": job_assets,
    "hierarchy_links": _of_derived(E.hierarchy_links),
    "event_links": event_links,
    "source_override": source_override,
    "facet_flags": _of_events(D.with_flags),
    "event_problems": _of_events(D.event_problems),
    "problem_reasons": problem_reasons,
    "file_summary": _of_events(D.file_summary),
    "corpus_compare": corpus_compare,
}

MODEL = """
WITH ln AS (
  SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_returnflag AS rf, l_linestatus AS ls,
    row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) - 1 AS pos
  FROM lineitem),
cnt AS (SELECT k, count(*) AS c FROM ln GROUP BY k),
ev AS (
  SELECT o.o_orderkey AS k, o.o_orderstatus AS st, lower(c.c_mktsegment) AS sl, o.o_orderdate AS od,
    'runs_' || o.o_custkey || '.ndjson' AS file, o.o_orderkey + 1 AS line_number,
    o.o_orderkey % 97 <> 0 AS is_valid,
    CASE WHEN o.o_orderstatus = 'O' AND o.o_orderkey % 19 = 0 THEN 0 ELSE coalesce(cnt.c, 0) END AS n_in,
    CASE WHEN o.o_orderstatus = 'P' THEN 0 WHEN o.o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS n_out,
    o.o_orderkey % 31 <> 0 AS has_job,
    CASE WHEN o.o_orderkey % 31 <> 0 AND o.o_orderkey % 17 <> 0 THEN 'ns.' || lower(left(c.c_mktsegment, 4)) END AS ns,
    CASE WHEN o.o_orderkey % 31 <> 0 AND o.o_orderpriority <> '4-NOT SPECIFIED'
      THEN 'load_' || lower(c.c_mktsegment) END AS jn,
    CASE WHEN o.o_orderkey % 13 = 0 THEN 'default_app' ELSE 'etl_app_' || (c.c_nationkey % 5) END AS app_id,
    CASE WHEN o.o_orderkey % 31 = 0 OR o.o_orderpriority = '5-LOW' THEN 'Default_SPARK_JOB' ELSE 'SQL_JOB' END AS sn,
    CASE WHEN o.o_orderkey % 31 <> 0 AND o.o_orderstatus = 'F'
      THEN 'insert into t' || (o.o_orderkey % 50) END AS txt
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN cnt ON cnt.k = o.o_orderkey),
r AS (
  SELECT *, coalesce(ns, 'default_namespace') AS namespace, coalesce(jn, 'default_job') AS job_name,
    app_id || '/' || coalesce(ns, 'default_namespace') AS schema_id,
    app_id || '/' || coalesce(ns, 'default_namespace') || '/' || coalesce(jn, 'default_job') AS task_id,
    app_id || '/' || coalesce(ns, 'default_namespace') || '/' || coalesce(jn, 'default_job') || '/' || sn AS sid
  FROM ev WHERE is_valid AND n_in > 0 AND n_out > 0),
inp AS (
  SELECT ln.*, NOT (rf = 'N' AND ls = 'F') AS has_schema,
    CASE WHEN s % 11 = 0 THEN 'dft_src' ELSE 'db___host_' || (s % 7) || '_x_5432' END AS res,
    CASE n % 3 WHEN 0 THEN 'erp' WHEN 1 THEN '/landing.v1' ELSE '_default' END AS src,
    'part_' || (p % 50) AS tbl
  FROM ln),
ds AS (
  SELECT r.k, r.file, r.line_number, 'input' AS role, 0 AS rr, i.pos, i.res, i.src, i.tbl,
    i.res || '.' || i.src || '/' || i.tbl AS key, i.has_schema, i.rf
  FROM r JOIN inp i ON i.k = r.k
  UNION ALL
  SELECT k, file, line_number, 'output', 1, 0, 's3___lake_house', 'curated', sl,
    's3___lake_house.curated/' || sl, true, 'OUT' FROM r
  UNION ALL
  SELECT k, file, line_number, 'output', 1, 1, 'dft_src', 'audit', sl, 'dft_src.audit/' || sl, false, 'OUT'
  FROM r WHERE n_out = 2),
shape(kind, fpos, top, leaf) AS (VALUES
  ('IN', 0, 'partkey', 'partkey'), ('IN', 1, 'brand', 'brand'), ('IN', 2, 'Time-Stamp', 'timestamp'),
  ('IN', 3, 'detail', 'size'), ('IN', 4, 'detail', 'retail'), ('IN', 5, 'detail', 'timestamp'), ('IN', 6, 'detail', 'zone'),
  ('OUT', 0, 'partkey', 'partkey'), ('OUT', 1, 'retail', 'retail'), ('OUT', 2, 'loadDateTime', 'loadDateTime'),
  ('OUT', 3, 'summary', 'summary'), ('OUT', 4, 'brand name', 'brand name')),
fld AS (
  SELECT ds.*, shape.fpos, shape.top, shape.leaf
  FROM ds JOIN shape ON shape.kind = CASE WHEN ds.rf = 'OUT' THEN 'OUT' ELSE 'IN' END
  WHERE ds.has_schema AND (shape.fpos < 5 OR ds.rf = 'R')),
last AS (SELECT * FROM ds QUALIFY row_number() OVER (PARTITION BY k, key ORDER BY rr DESC, pos DESC) = 1),
lk AS (SELECT fld.* FROM fld JOIN last USING (k, key, rr, pos)),
tg(target, field) AS (VALUES ('partkey', 'partkey'), ('retail', 'detail'), ('loadDateTime', 'detail'),
  ('summary', 'detail'), ('brand name', 'brand'), ('updated', 'Time-Stamp')),
lin AS (
  SELECT r.k, r.file, r.line_number, r.sid, 's3___lake_house.curated/' || r.sl AS target_key, tg.target, tg.field,
    i.pos, i.res, i.src, i.tbl, i.res || '.' || i.src || '/' || i.tbl AS key, i.rf = 'R' AS direct
  FROM r JOIN inp i ON i.k = r.k CROSS JOIN tg WHERE r.k % 7 <> 0),
pref AS (SELECT * FROM lin QUALIFY direct OR NOT bool_or(direct) OVER (PARTITION BY k)),
cand AS (
  SELECT pref.*, coalesce(lk.leaf, pref.field) AS leaf,
    regexp_replace(lower(pref.target), '[^a-z0-9]', '', 'g') AS ct,
    regexp_replace(lower(coalesce(lk.leaf, pref.field)), '[^a-z0-9]', '', 'g') AS cl
  FROM pref LEFT JOIN lk ON lk.k = pref.k AND lk.key = pref.key AND lk.top = pref.field),
matched AS (SELECT *, ct = cl OR (ct LIKE '%datetime' AND cl LIKE '%timestamp') AS m FROM cand),
solved AS (
  SELECT * FROM matched QUALIFY CASE
    WHEN bool_or(m) OVER (PARTITION BY k, target, pos) THEN m
    WHEN count(*) OVER (PARTITION BY k, target, pos) = 1 AND leaf = field THEN true
    ELSE direct END),
targets AS (
  SELECT r.k, r.sid, 's3___lake_house.curated/' || r.sl AS target_key, x.target
  FROM r CROSS JOIN (SELECT target FROM tg UNION ALL SELECT 'orphan') x WHERE r.k % 7 <> 0),
alld AS (SELECT k, res, src, tbl, key FROM ds UNION SELECT k, res, src, tbl, key FROM pref),
alle AS (
  SELECT key, leaf AS col FROM lk UNION SELECT target_key, target FROM targets
  UNION SELECT key, leaf FROM solved),
flow AS (
  SELECT key AS source, sid AS target, 'core.DataSetDataFlow' AS association FROM ds JOIN r USING (k) WHERE role = 'input'
  UNION SELECT sid, key, 'core.DataSetDataFlow' FROM ds JOIN r USING (k) WHERE role = 'output'),
coll AS (
  SELECT sid AS source, sid || '/' || target AS target,
    'com.infa.odin.models.relational.StatementToCalculation' AS association FROM targets
  UNION SELECT sid || '/' || target, target_key || '/' || target, 'core.DirectionalDataFlow' FROM targets
  UNION SELECT key || '/' || leaf, sid || '/' || target, 'core.DirectionalDataFlow' FROM solved),
hier AS (
  SELECT '$resource' AS source, res AS target, 'core.ResourceParentChild' AS association FROM alld
  UNION SELECT res, res || '.' || src, 'core.ResourceParentChild' FROM alld
  UNION SELECT res || '.' || src, key, 'core.DataSourceParentChild' FROM alld
  UNION SELECT key, key || '/' || col, 'core.DataSetToDataElementParentship' FROM alle
  UNION SELECT '$resource', app_id, 'core.ResourceParentChild' FROM r
  UNION SELECT app_id, schema_id, 'com.infa.odin.models.relational.DatabaseToSchema' FROM r
  UNION SELECT schema_id, task_id, 'com.infa.odin.models.relational.SchemaToTask' FROM r
  UNION SELECT task_id, sid, 'com.infa.odin.models.relational.TaskToStatement' FROM r),
flags AS (
  SELECT ev.file, ev.line_number, ev.is_valid, od,
    CASE WHEN is_valid THEN 'run-' || k END AS run_id,
    CASE WHEN is_valid THEN jn END AS job_name, CASE WHEN is_valid THEN ns END AS job_namespace,
    CASE WHEN is_valid THEN 'COMPLETE' END AS event_type,
    CASE WHEN is_valid THEN n_in ELSE 0 END AS inputs_count, CASE WHEN is_valid THEN n_out ELSE 0 END::BIGINT AS outputs_count,
    is_valid AND has_job AS has_job,
    is_valid AND (n_out > 0 OR (n_in > 0 AND coalesce(h.any_schema, false))) AS has_schema,
    is_valid AND n_out > 0 AND k % 7 <> 0 AS has_column_lineage, false AS has_job_lineage_facet
  FROM ev LEFT JOIN (SELECT k, bool_or(has_schema) AS any_schema FROM inp GROUP BY k) h USING (k)),
prob AS (
  SELECT *, 'Invalid JSON' AS error_type, 'Invalid JSON' AS reason_description FROM flags WHERE NOT is_valid
  UNION ALL SELECT *, 'No inputs - Cannot generate DataSetDataFlow',
    'Dataset input is missing. Lineage flow cannot be established.' FROM flags WHERE is_valid AND inputs_count = 0
  UNION ALL SELECT *, 'No outputs - Cannot generate DataSetDataFlow',
    'Dataset output is missing. Lineage flow cannot be established.' FROM flags WHERE is_valid AND outputs_count = 0
  UNION ALL SELECT *, 'No job information - Cannot generate Task',
    'Job name/namespace missing. Task metadata cannot be created.' FROM flags WHERE is_valid AND job_name IS NULL
  UNION ALL SELECT *, 'No schema facet - Cannot generate column-level DataElement',
    'Schema information missing. Cannot map columns (data elements) in the lineage.' FROM flags WHERE is_valid AND NOT has_schema
  UNION ALL SELECT *, 'No column lineage facet - Cannot generate DirectionalDataFlow',
    'Column-level lineage not available. Cannot create directional flow between columns.'
    FROM flags WHERE is_valid AND NOT has_column_lineage)
"""

_PERCENT = """CASE WHEN {whole} > 0 THEN
  ((({part}) * 2000 + {whole}) // ({whole} * 2)) // 10 || '.' || ((({part}) * 2000 + {whole}) // ({whole} * 2)) % 10 || '%'
  ELSE 'N/A' END"""

ORACLE = {
    "events_scan": """
SELECT 'runs_' || o_custkey || '.ndjson' AS file,
  (row_number() OVER w + coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)
    OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS line_number,
  o_orderkey % 97 <> 0 AS is_valid, CASE WHEN o_orderkey % 97 <> 0 THEN 'run-' || o_orderkey END AS run_id
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""",
    "lineage_ready_events": MODEL
    + "SELECT file, line_number, 'run-' || k AS run_id, n_in AS inputs_count, n_out::BIGINT AS outputs_count FROM r",
    "job_ids": MODEL
    + """SELECT file, line_number, app_id, namespace, schema_id, job_name, task_id, sn AS statement_name,
  sid AS statement_id, txt AS statement_text FROM r""",
    "event_datasets": MODEL + "SELECT file, line_number, role, pos::BIGINT AS pos, key FROM ds",
    "flatten_fields": MODEL
    + "SELECT file, line_number, role, pos::BIGINT AS dataset_pos, key, top AS top_field, leaf FROM fld",
    # The fields of each key's last data set, without a join of all fields with it.
    "field_lookup": MODEL
    + """SELECT file, line_number, key, top AS top_field, leaf FROM last
JOIN shape ON shape.kind = CASE WHEN last.rf = 'OUT' THEN 'OUT' ELSE 'IN' END
WHERE last.has_schema AND (shape.fpos < 5 OR last.rf = 'R')""",
    "dataset_columns": MODEL + "SELECT DISTINCT key, leaf AS \"column\" FROM lk",
    "dataset_flow": MODEL + "SELECT * FROM flow",
    "direct_inputs": MODEL
    + """SELECT file, line_number, target_key, target AS target_column, key AS source_key, field, direct AS is_direct
FROM pref""",
    "resolve_columns": MODEL
    + """SELECT file, line_number, target_key, target AS target_column, key AS source_key, leaf AS source_column
FROM solved""",
    "column_lineage": MODEL + "SELECT * FROM coll",
    "physical_assets": MODEL
    + """, a AS (
  SELECT 'core.Resource' AS class, res AS external_id, res AS name FROM alld
  UNION SELECT 'core.DataSource', res || '.' || src, res || '.' || src FROM alld
  UNION SELECT 'core.DataSet', key, tbl FROM alld
  UNION SELECT 'core.DataElement', key || '/' || col, col FROM alle)
SELECT class, external_id, name, 'TRUE' AS reference, '' AS assignable FROM a""",
    "job_assets": MODEL
    + """, a AS (
  SELECT 'Database' AS c, app_id AS external_id, app_id AS name, NULL AS statement_text FROM r
  UNION SELECT 'Schema', schema_id, namespace, NULL FROM r
  UNION SELECT 'Task', task_id, job_name, NULL FROM r
  UNION SELECT 'Statement', sid, sn, txt FROM r
  UNION SELECT 'Calculation', sid || '/' || target, target, NULL FROM targets)
SELECT 'com.infa.odin.models.relational.' || c AS class, external_id, name, '' AS reference, 'TRUE' AS assignable,
  statement_text FROM a""",
    "hierarchy_links": MODEL + "SELECT * FROM hier",
    "event_links": MODEL + "SELECT * FROM hier UNION SELECT * FROM flow UNION SELECT * FROM coll",
    "source_override": """
WITH s AS (SELECT 'res_' || (p_size % 4) AS resource_id, p_type || '_' || p_partkey AS db, 'res.' || p_partkey AS external_id
  FROM part),
m0 AS (SELECT l_orderkey * 100 + l_linenumber AS pos, lower(p_type) || '_' || l_partkey AS db,
  coalesce(CASE WHEN l_linestatus = 'O' THEN 'RES_' || (l_linenumber % 4) END, '') AS rid,
  coalesce(CASE WHEN l_returnflag <> 'N' THEN 'cat.' || l_orderkey END, '') AS ext,
  coalesce(CASE WHEN l_returnflag = 'R' THEN 'name ' || l_orderkey END, '') AS nm
  FROM lineitem JOIN part ON l_partkey = p_partkey),
m AS (SELECT * FROM m0 QUALIFY row_number() OVER (PARTITION BY pos, db ORDER BY rid DESC, ext DESC, nm DESC) = 1),
hit AS (SELECT s.db, s.resource_id, m.ext, m.nm FROM s JOIN m ON lower(s.db) = m.db
  AND (m.rid = '' OR lower(m.rid) = lower(s.resource_id)) WHERE m.ext <> ''
  QUALIFY row_number() OVER (PARTITION BY s.db, s.resource_id ORDER BY m.pos) = 1)
SELECT s.resource_id, s.db, coalesce(hit.ext, s.external_id) AS external_id,
  CASE WHEN hit.ext IS NULL THEN s.external_id ELSE coalesce(nullif(hit.nm, ''), hit.ext) END AS name
FROM s LEFT JOIN hit USING (db, resource_id)""",
    "facet_flags": MODEL + "SELECT * EXCLUDE (od) FROM flags",
    "event_problems": MODEL
    + """SELECT file, line_number, coalesce(run_id, 'N/A') AS run_id, coalesce(job_name, 'N/A') AS job_name,
  coalesce(job_namespace, 'N/A') AS job_namespace, coalesce(event_type, 'N/A') AS event_type, error_type,
  inputs_count, outputs_count, has_job, has_schema, has_column_lineage, reason_description FROM prob""",
    "problem_reasons": MODEL
    + "SELECT error_type, reason_description, count(*) AS events FROM prob GROUP BY ALL",
    "file_summary": MODEL
    + f""", c AS (SELECT file,
  count(*) FILTER (is_valid) AS total_events, count(*) FILTER (is_valid) AS valid_events,
  count(*) FILTER (NOT is_valid) AS invalid_json,
  count(*) FILTER (is_valid AND inputs_count = 0) AS events_with_no_inputs,
  count(*) FILTER (is_valid AND outputs_count = 0) AS events_with_no_outputs,
  count(*) FILTER (is_valid AND job_name IS NULL) AS events_with_no_job,
  count(*) FILTER (is_valid AND NOT has_schema) AS events_with_no_schema,
  count(*) FILTER (is_valid AND NOT has_column_lineage) AS events_with_no_column_lineage,
  count(*) FILTER (is_valid AND inputs_count > 0 AND outputs_count > 0 AND job_name IS NOT NULL AND has_schema
    AND has_column_lineage) AS lineage_ready_events,
  count(*) FILTER (is_valid AND inputs_count > 0 AND outputs_count > 0) AS fl FROM flags GROUP BY file)
SELECT * EXCLUDE (fl),
  {_PERCENT.format(part='total_events - events_with_no_column_lineage', whole='total_events')}
    AS can_generate_directional_lineage_percent,
  {_PERCENT.format(part='fl', whole='total_events')} AS can_generate_dataset_dataflow_percent FROM c""",
    "corpus_compare": MODEL
    + """SELECT event_type, job_name, inputs_count, outputs_count, has_schema, has_column_lineage,
  count(*) FILTER (od < TIMESTAMP '1995-01-01') AS sample_events,
  count(*) FILTER (od >= TIMESTAMP '1995-01-01') AS main_events
FROM flags WHERE is_valid GROUP BY ALL""",
}
_ODD_IN, _ODD_OUT = "line_number % 4 = 0 AND inputs_count > 0", "line_number % 6 = 0 AND outputs_count > 0"
ORACLE["odd_events_scan"] = (
    MODEL
    + f"""SELECT file, line_number, is_valid, run_id,
  (CASE WHEN {_ODD_IN} THEN 2 ELSE 0 END + CASE WHEN {_ODD_OUT} THEN 1 ELSE 0 END)::BIGINT AS ill_typed FROM flags"""
)
#: The data sets that are left keep all links.
ORACLE["odd_event_links"] = ORACLE["event_links"]
ORACLE["odd_event_problems"] = f"""{ORACLE["event_problems"]} UNION ALL
SELECT file, line_number, coalesce(run_id, 'N/A'), coalesce(job_name, 'N/A'), coalesce(job_namespace, 'N/A'),
  coalesce(event_type, 'N/A'), '{D.ILL_TYPED}', inputs_count, outputs_count, has_job, has_schema, has_column_lineage,
  '{D.ILL_TYPED_REASON}' FROM flags WHERE ({_ODD_IN}) OR ({_ODD_OUT})"""
