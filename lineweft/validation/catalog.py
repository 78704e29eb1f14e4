"""Exports read back, appends, checks and streaming over the event, script and view graphs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.adapters import events as event_adapter
from lineweft.adapters import scripts as script_adapter
from lineweft.adapters.tables import table
from lineweft.functions import vocabulary as V
from lineweft.operators import events as E
from lineweft.operators import quality as Q
from lineweft.operators import scripts as S
from lineweft.plans.graphs import script_graph_of
from lineweft.session import cut_lineage, shared_folder
from lineweft.sinks.append import append_hashed, new_rows, read_hashed
from lineweft.sinks.export import EVENT_LAYOUTS, SCRIPT_LAYOUTS, csv_lines, write_assets, write_links
from lineweft.sinks.ordered import read_in_order
from lineweft.sources.events import parse_events
from lineweft.sources.files import split_lines
from lineweft.streaming.ingest import (
    event_line_stream, start_graph_stream, start_link_stream, start_problem_stream, streamed,
)
from lineweft.validation import events as event_checks
from lineweft.validation import scripts as script_checks


def _derived(spark: SparkSession, folder: str) -> DataFrame:
    return E.derive(parse_events(event_adapter.event_lines(spark, folder)))


def asset_export(spark: SparkSession, folder: str) -> DataFrame:
    return csv_lines(E.event_assets(_derived(spark, folder)), EVENT_LAYOUTS)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/lineweft-{name}-{uuid.uuid4().hex}"


def links_export(spark: SparkSession, folder: str) -> DataFrame:
    """Event links as their export has them, with the place of each line over all parts."""
    path = _folder(spark, "links")
    write_links(E.event_links(_derived(spark, folder)), path, compression="gzip")
    return read_in_order(spark, f"{path}/links.csv").withColumnRenamed("value", "line")


def script_links_export(spark: SparkSession, folder: str) -> DataFrame:
    """The same of the script graph, whose root links come first and in an order of their own."""
    path = _folder(spark, "script-links")
    files, facts = script_adapter.script_files(spark, folder), script_adapter.lineage_facts(spark, folder)
    graph = script_graph_of(files, facts, script_checks.CONFIG)
    write_links(graph.links, path, order=graph.link_order, compression="gzip")
    return read_in_order(spark, f"{path}/links.csv").withColumnRenamed("value", "line")


def export_row_width(spark: SparkSession, folder: str) -> DataFrame:
    """Widths of exported scripts, whose SQL has commas, quotes and line ends, and of a file with planted faults."""
    path = _folder(spark, "widths")
    refs = S.table_refs(S.statements(script_adapter.script_files(spark, folder)), script_checks.CONFIG)
    facts = S.prepare_facts(script_adapter.lineage_facts(spark, folder), script_checks.CONFIG)
    classes = (V.SQL_PARSER, V.SQL_SCRIPT, V.SQL_SCRIPT_COLUMN)
    assets = S.script_assets(refs, S.script_columns(facts), script_checks.CONFIG)
    write_assets(assets, {cls: SCRIPT_LAYOUTS[cls] for cls in classes}, path)
    parts = table(spark, folder, "part", "p_partkey", "p_type", "p_size")
    name = F.when(F.col("p_size") % 9 == 0, F.concat("p_type", F.lit(",one more"))).otherwise(
        F.concat(F.lit('"a ""quoted"",\n\n'), F.col("p_type"), F.lit('"'))
    )
    rows = parts.select(F.col("p_partkey").alias("id"), name.alias("name"), F.col("p_size").alias("size"))
    rows.write.options(header=True, quote="\u0000").csv(f"{path}/planted.csv")
    found = spark.createDataFrame([], "path string, header_width bigint, rows bigint, bad_rows bigint")
    for file in (*classes, "planted"):
        found = found.unionByName(Q.file_row_width(split_lines(spark, f"{path}/{file}.csv")))
    file = F.regexp_extract("path", r"([^/]+)\.csv/[^/]*$", 1).alias("file")
    return found.groupBy(file, "header_width").agg(F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows"))


def append_hashed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A table after line items of status F, those of status O, and those of F once more were appended to it."""
    lines = table(spark, folder, "lineitem", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    path, columns = _folder(spark, "hashed"), ["l_partkey", "s", "l_returnflag"]
    keyed = lines.withColumn("s", F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey") % 7))
    for status in "FOF":
        append_hashed(keyed.where(F.col("l_linestatus") == status), path, columns, buckets=16)
    return read_hashed(spark, path)


def append_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a batch against those of status F as the existing table, on columns with nulls."""
    lines = table(spark, folder, "lineitem", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    keyed = lines.select(
        (F.col("l_partkey") % 50).alias("p"),
        F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey") % 7).alias("s"),
        F.col("l_returnflag").alias("flag"),
        "l_linestatus",
    )
    columns = ["p", "s", "flag"]
    existing = keyed.where((F.col("l_linestatus") == "F") & (F.col("flag") != "R"))
    return new_rows(keyed.where(F.col("l_linestatus") == "O"), existing, columns)


def dangling_links(spark: SparkSession, folder: str) -> DataFrame:
    """Event links against assets from which columns named "zone" and one data source are missing."""
    # Events are read once, for links and assets together.
    graph = cut_lineage(E.graph_rows(_derived(spark, folder)).distinct())
    links, assets = (graph.where(F.col("kind") == kind).select(f"{kind}.*") for kind in ("link", "asset"))
    missing = ((F.col("name") == "zone") & (F.col("class") == "core.DataElement")) | (F.col("external_id") == "dft_src.audit")
    return Q.dangling_links(links, assets.where(~missing))


def row_width(spark: SparkSession, folder: str) -> DataFrame:
    """Exported part lists, one file per brand; every size divisible by 9 loses a field."""
    parts = table(spark, folder, "part", "p_partkey", "p_brand", "p_type", "p_size")
    key = F.col("p_partkey").cast("string")
    row = F.when(F.col("p_size") % 9 == 0, F.concat_ws(",", key, "p_type")).otherwise(
        F.concat(key, F.lit(',"a ""quoted"", '), F.col("p_type"), F.lit('",'), F.col("p_size").cast("string"))
    )
    rows = parts.select("p_brand", (F.col("p_partkey") + 2).alias("line_number"), row.alias("value"))
    headers = parts.select("p_brand").distinct().select(
        "p_brand", F.lit(1).cast("bigint").alias("line_number"), F.lit("id,name,size").alias("value")
    )
    return Q.row_width(rows.unionByName(headers).withColumnRenamed("p_brand", "file"))


def association_counts(spark: SparkSession, folder: str) -> DataFrame:
    return Q.association_counts(E.event_links(_derived(spark, folder)))


def class_counts(spark: SparkSession, folder: str) -> DataFrame:
    return Q.class_counts(E.event_assets(_derived(spark, folder)))


def _land(lines: DataFrame, landing: str, batches: int) -> int:
    """Writes event lines to files, compressed and without moving them, and says how many files make one of ``batches``.

    Files hold so many lines at most, as a compressed file is read by one task.
    """
    writer = lines.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", 5_000)
    writer.text(landing)
    return max(1, len(lines.sparkSession.read.text(landing).inputFiles()) // batches)


def stream_links(spark: SparkSession, folder: str) -> DataFrame:
    """Event files in several micro-batches; the links written in the end equal the batch result."""
    base = f"{shared_folder(spark).removeprefix('file:')}/stream-{uuid.uuid4().hex}"
    per_batch = _land(event_adapter.event_lines(spark, folder).select("value"), f"{base}/landing", 3)
    lines = event_line_stream(spark, f"{base}/landing", files_per_batch=per_batch, pattern="*.txt.gz")
    query = start_link_stream(lines, f"{base}/links", f"{base}/checkpoint")
    query.awaitTermination()
    return spark.read.parquet(f"{base}/links")


def _in_two_runs(spark: SparkSession, folder: str, start) -> str:
    """Event files of which half arrive after a first run of the stream; the folder that both runs wrote."""
    base = f"{shared_folder(spark).removeprefix('file:')}/lineweft-stream-{uuid.uuid4().hex}"
    lines = event_adapter.event_lines(spark, folder).select("value")
    for half in range(2):
        of_half = lines.where(F.pmod(F.crc32("value"), F.lit(2)) == half)
        per_batch = _land(of_half, f"{base}/landing", 2 * (half + 1))
        arrived = event_line_stream(spark, f"{base}/landing", files_per_batch=per_batch, pattern="*.txt.gz")
        start(arrived, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return f"{base}/out"


def stream_assets(spark: SparkSession, folder: str) -> DataFrame:
    """Streamed assets as their export has them, after a restart between two halves of the events."""
    return csv_lines(streamed(spark, _in_two_runs(spark, folder, start_graph_stream), "asset"), EVENT_LAYOUTS)


def stream_problems(spark: SparkSession, folder: str) -> DataFrame:
    """Streamed problems, counted, after a restart between two halves of the events."""
    problems = spark.read.parquet(_in_two_runs(spark, folder, start_problem_stream))
    return problems.groupBy(*[c for c in problems.columns if c not in ("file", "line_number")]).agg(F.count("*").alias("n"))


QUERIES = {
    "asset_export": asset_export,
    "links_export": links_export,
    "script_links_export": script_links_export,
    "export_row_width": export_row_width,
    "append_new_rows": append_new_rows,
    "append_hashed_rows": append_hashed_rows,
    "dangling_links": dangling_links,
    "row_width": row_width,
    "association_counts": association_counts,
    "class_counts": class_counts,
    "stream_links": stream_links,
    "stream_assets": stream_assets,
    "stream_problems": stream_problems,
}

_ASSETS = (
    event_checks.MODEL
    + """, assets AS (
  SELECT 'core.Resource' AS class, res AS id, res AS name, 'TRUE' AS r, '' AS a, NULL AS txt FROM alld
  UNION SELECT 'core.DataSource', res || '.' || src, res || '.' || src, 'TRUE', '', NULL FROM alld
  UNION SELECT 'core.DataSet', key, tbl, 'TRUE', '', NULL FROM alld
  UNION SELECT 'core.DataElement', key || '/' || col, col, 'TRUE', '', NULL FROM alle
  UNION SELECT 'com.infa.odin.models.relational.Database', app_id, app_id, '', 'TRUE', NULL FROM r
  UNION SELECT 'com.infa.odin.models.relational.Schema', schema_id, namespace, '', 'TRUE', NULL FROM r
  UNION SELECT 'com.infa.odin.models.relational.Task', task_id, job_name, '', 'TRUE', NULL FROM r
  UNION SELECT 'com.infa.odin.models.relational.Statement', sid, sn, '', 'TRUE', txt FROM r
  UNION SELECT 'com.infa.odin.models.relational.Calculation', sid || '/' || target, target, '', 'TRUE', NULL FROM targets),
links AS (SELECT * FROM hier UNION SELECT * FROM flow UNION SELECT * FROM coll)
"""
)

_PLANTED_WIDTHS = "SELECT 'planted' AS file, 3::BIGINT AS header_width, count(*) AS rows, count(*) FILTER (p_size % 9 = 0) AS bad_rows FROM part"

ORACLE = {
    "links_export": _ASSETS
    + """SELECT row_number() OVER (ORDER BY association, source, target) AS position,
  source || ',' || target || ',' || association AS line FROM links""",
    "script_links_export": script_checks.GRAPH
    + """, placed AS (SELECT '$RESOURCE' AS source, r AS target, 'core.ResourceParentChild' AS association, 0 AS part, r AS place
    FROM (SELECT DISTINCT split_part(raw_id, '/', 1) AS r FROM dsets UNION SELECT conn FROM kn)
  UNION SELECT conn, conn || '_DS', 'core.ResourceParentChild', 1, conn FROM kn
  UNION SELECT source, target, association, 2, '' FROM links
    WHERE (source, target) NOT IN (SELECT (conn, conn || '_DS') FROM kn))
SELECT row_number() OVER (ORDER BY part, place = 'REFERENCE_DEFAULT_CONN', place DESC, association, source, target) AS position,
  source || ',' || target || ',' || association AS line FROM placed""",
    "export_row_width": script_checks.GRAPH
    + f"""SELECT class AS file, CASE {" ".join(f"WHEN class = '{c}' THEN {len(SCRIPT_LAYOUTS[c].header)}" for c in SCRIPT_LAYOUTS)} END AS header_width,
  count(*) AS rows, 0 AS bad_rows FROM assets GROUP BY class UNION ALL {_PLANTED_WIDTHS}""",
    "asset_export": _ASSETS
    + """SELECT class, id || ',' || r || ',' || a || ',' || name ||
  CASE WHEN class LIKE '%Statement' THEN ',' || coalesce(txt, '') ELSE '' END AS line FROM assets""",
    "append_new_rows": """
WITH k AS (SELECT l_partkey % 50 AS p, CASE WHEN l_suppkey % 3 <> 0 THEN l_suppkey % 7 END AS s, l_returnflag AS flag, l_linestatus AS ls
  FROM lineitem)
SELECT p, s, flag FROM k WHERE ls = 'O' EXCEPT SELECT p, s, flag FROM k WHERE ls = 'F' AND flag <> 'R'""",
    "append_hashed_rows": """SELECT DISTINCT l_partkey, CASE WHEN l_suppkey % 3 <> 0 THEN l_suppkey % 7 END AS s, l_returnflag
FROM lineitem""",
    "dangling_links": _ASSETS
    + """, known AS (SELECT DISTINCT id FROM assets WHERE NOT (name = 'zone' AND class = 'core.DataElement') AND id <> 'dft_src.audit'),
x AS (SELECT l.*, source <> '$resource' AND s.id IS NULL AS missing_source, t.id IS NULL AS missing_target FROM links l
  LEFT JOIN known s ON s.id = source LEFT JOIN known t ON t.id = target)
SELECT * FROM x WHERE missing_source OR missing_target""",
    "row_width": """SELECT p_brand AS file, 3::BIGINT AS header_width, count(*) AS rows,
  count(*) FILTER (p_size % 9 = 0) AS bad_rows FROM part GROUP BY p_brand""",
    "association_counts": _ASSETS + "SELECT association, count(*) AS links FROM links GROUP BY ALL",
    "class_counts": _ASSETS + "SELECT class, count(*) AS assets FROM assets GROUP BY ALL",
    "stream_links": _ASSETS + "SELECT * FROM links",
}
ORACLE["stream_assets"] = ORACLE["asset_export"]
ORACLE["stream_problems"] = f"""SELECT * EXCLUDE (file, line_number), count(*) AS n
FROM ({event_checks.ORACLE["event_problems"]}) GROUP BY ALL"""
