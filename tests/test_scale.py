"""Plans and files of queries that once grew faster than their tables."""

import pathlib
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lineweft.adapters import reports as report_adapter
from lineweft.adapters import scripts as script_adapter
from lineweft.operators import metadata as M
from lineweft.operators import reports as P
from lineweft.operators import scripts as S
from lineweft.validation import catalog
from lineweft.validation import reports as report_checks
from lineweft.validation import scripts as script_checks


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two customers, one of them twice and one without orders, and three orders, one of them twice."""
    base = str(tmp_path_factory.mktemp("tables"))
    day = datetime(2000, 1, 1)
    tables = {
        "customer": ("c_custkey bigint, c_nationkey int, c_mktsegment string", [(1, 2, "BUILDING"), (1, 2, "BUILDING"), (2, 3, "MACHINERY")]),
        "orders": (
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
            [(7, 1, "O", 1.0, day, "1-URGENT"), (3, 1, "O", 1.0, day, "3-MEDIUM"), (3, 1, "O", 1.0, day, "3-MEDIUM"), (5, 1, "F", 1.0, day, "2-HIGH")],
        ),
        "lineitem": (
            "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string",
            [(7, 1, 10, 4, "R", "O"), (5, 2, 11, 5, "N", "O"), (5, 3, 12, 6, "A", "F")],
        ),
    }
    for name, (schema, values) in tables.items():
        spark.createDataFrame(values, schema).write.parquet(f"{base}/{name}.parquet")
    return base


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_layouts_are_not_sent_to_the_driver(spark, folder):
    docs = report_adapter.layout_docs(spark, folder)
    assert "Broadcast" not in plan(docs)
    sections = P.report_sections(P.derive(P.parse_layouts(docs)))
    found = [(pos, name) for _, pos, _, name in rows(sections)]
    assert found == [(0, "Status F"), (0, "Status F"), (1, "Status O"), (1, "Status O")]
    visuals = P.report_visuals(P.derive(P.parse_layouts(docs.distinct())))
    assert rows(visuals, "ordinal", "visual_type") == [(1, "card"), (1, "pivotTable"), (2, "card"), (3, "table")]


def test_containers_are_read_once(spark, folder):
    scanned = report_checks.layouts_scan(spark, folder)
    assert "Broadcast" not in plan(scanned) and "MapInPandas" not in plan(scanned)
    names = {"Sales & Stock #1 (v2)": 4, "Sales & Stock #2 (v3)": 1}
    assert rows(scanned.groupBy("report_name").count()) == sorted(names.items())
    assert {(s, e) for n, e, s in rows(scanned) if n.startswith("Sales & Stock #1")} == {(2, None)}


def test_dangling_links_read_events_once(spark, folder):
    found = catalog.dangling_links(spark, folder)
    assert "l_orderkey" not in plan(found)
    assert {(s, t) for _, _, _, s, t in rows(found)} <= {(True, False), (False, True), (True, True)}


def test_landed_events_are_compressed_and_dealt_over_files(spark, tmp_path):
    lines = spark.range(12_000, numPartitions=2).selectExpr("concat('line ', id) AS value")
    assert catalog._land(lines, str(tmp_path / "landing"), 2) == 2
    files = sorted(f.name for f in pathlib.Path(tmp_path / "landing").glob("part-*"))
    assert len(files) == 4 and all(f.endswith(".txt.gz") for f in files)
    assert spark.read.text(str(tmp_path / "landing")).distinct().count() == 12_000


def test_metadata_of_parts_is_dealt_over_tasks(spark, tmp_path):
    """All rows of the parts of one split met in one task's aggregate."""
    parts = [(p, n % 50, f"Brand#{n % 5}", f"TYPE {n % 7}") for n, p in enumerate([*range(1_000), 5, None])]
    frame = spark.createDataFrame(parts, "p_partkey bigint, p_size int, p_brand string, p_type string")
    frame.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    found = script_adapter.table_metadata(spark, str(tmp_path))
    assert max(n for _, n in rows(found.groupBy(F.spark_partition_id()).count())) < 15 * len(parts) / 4
    assert found.count() == 15 * len(parts)


def test_seeded_metadata_is_not_sent_to_the_driver(spark, tmp_path):
    """Rows of generators were taken for as few as the bytes they come from, and one side was broadcast."""
    refs = spark.createDataFrame([("usable", ["a.s"], ["b.t"]), ("unparsed", ["a.u"], [])], "state string, sources array<string>, targets array<string>")
    metadata = spark.createDataFrame([("a.s", "x "), ("a.s", "x"), ("b.t", "y"), ("a.u", "z"), (None, "w")], "table string, column string")
    found = M.seed_columns(refs, metadata)
    assert rows(found, "table", "column") == [("a.s", "x"), ("b.t", "y")]
    part = spark.createDataFrame([(5, 1, "Brand#1", "TYPE 2"), (None, 1, "Brand#1", "TYPE 2")], "p_partkey bigint, p_size int, p_brand string, p_type string")
    part.write.parquet(f"{tmp_path}/part.parquet")
    found = script_checks.seed_columns(spark, str(tmp_path))
    assert "Broadcast" not in plan(found)
    assert rows(found, "table", "column") == [("lake.raw_5.t_5", c) for c in ("BRAND", "Brand#1", "TYPE 2", "brand", "c_1")]


def test_elements_of_facts_are_published_within_rows(spark):
    """Every element of the facts moved to its data set and to the sources before; ids of null parts are still left out."""
    schema = "task string, stmt_no bigint, src_schema string, src_table string, src_col string, tgt_schema string, tgt_table string, tgt_col string"
    values = [("f", 1, "erp", "t", "a", "mart", "m", "b"), ("f", 1, "erp.t", "u", "c", "mart", "m", "b"),
              ("f", 2, "erp", None, "a", "mart", "m", None), (None, 1, "x", "y", "z", "x", "y", "z")]
    facts = S.prepare_facts(spark.createDataFrame(values, schema))
    refs = spark.createDataFrame([("f", 1, "unparsed", [], [])], "file string, stmt_no bigint, state string, targets array<string>, sources array<string>")
    found = S.script_reference_assets(refs, facts)
    assert "dataset_id" not in plan(found)
    by_class = {cls: sorted(r.name for r in found.where(F.col("class") == cls).collect()) for cls in ("core.DataSet", "core.DataElement")}
    assert by_class == {"core.DataSet": ["m", "t", "u"], "core.DataElement": ["a", "b", "c"]}
