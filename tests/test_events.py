import json
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lineweft.adapters.events import event_lines
from lineweft.adapters.tables import tasks
from lineweft.config import LineageConfig
from lineweft.operators import diagnostics as D
from lineweft.operators import events as E
from lineweft.operators import quality as Q
from lineweft.plans.graphs import event_graph
from lineweft.sources.events import parse_events, read_event_lines
from lineweft.streaming.ingest import event_line_stream, start_graph_stream, start_problem_stream, streamed


def dataset(namespace, name, fields=None, lineage=None):
    facets = {}
    if fields is not None:
        facets["schema"] = {"fields": fields}
    if lineage is not None:
        facets["columnLineage"] = {"fields": lineage}
    return {"namespace": namespace, "name": name, "facets": facets}


def leafs(*names):
    return [{"name": n, "type": "string"} for n in names]


def fed(namespace, name, field, kind="DIRECT"):
    return {"namespace": namespace, "name": name, "field": field, "transformations": [{"type": kind}] if kind else []}


def event(inputs, outputs, app="app", job="job", sql=None):
    body = {
        "eventType": "COMPLETE",
        "run": {"runId": "r", "facets": {"spark_properties": {"properties": {"spark.app.name": app}}}},
        "job": {"namespace": "lake", "name": job, "facets": {"jobType": {"jobType": "SQL_JOB"}}},
    }
    if sql:
        body["job"]["facets"]["sql"] = {"query": sql}
    body["inputs"], body["outputs"] = inputs, outputs
    return body


def parsed(spark, *events, config=LineageConfig()):
    lines = [(f"f{i}", 1, e if isinstance(e, str) else json.dumps(e)) for i, e in enumerate(events)]
    return parse_events(spark.createDataFrame(lines, "file string, line_number bigint, value string"), config)


def three_samples():
    pg, s3, landing, my = "postgres://shop-db:5432", "s3://lake-house", "s3://landing-zone", "mysql://stock-db:3306"
    flat = event(
        [dataset(pg, "raw.sales", leafs("id", "buyer", "total", "made_at"))],
        [dataset(s3, "curated/sales", leafs("id", "buyer", "total"),
                 {c: {"inputFields": [fed(pg, "raw.sales", c)]} for c in ("id", "buyer", "total")})],
        app="sales", job="sales.load", sql="insert into x select 1",
    )
    nested_fields = [
        {"name": "request", "fields": leafs("requestId", "path", "timeStamp")},
        {"name": "response", "fields": leafs("statusCode", "durationMs")},
    ]
    containers = {"requestId": "request", "path": "request", "timestamp": "request",
                  "statusCode": "response", "durationMs": "response"}
    nested = event(
        [dataset(landing, "/raw/calls", nested_fields)],
        [dataset(s3, "curated/calls", leafs(*containers),
                 {t: {"inputFields": [fed(landing, "/raw/calls", c)]} for t, c in containers.items()})],
        app="calls", job="calls.parse",
    )
    columns = leafs("sku", "amount", "changed")
    plain = event([dataset(my, "staging.stock", columns)], [dataset(s3, "curated/stock", columns)], app="stock", job="stock.copy")
    return flat, nested, plain


def test_three_samples_give_the_stated_counts(spark):
    derived = E.derive(parsed(spark, *three_samples()))
    links = E.event_links(derived)
    counts = dict(rows(Q.association_counts(links)))
    job = "com.infa.odin.models.relational."
    assert counts == {
        "core.ResourceParentChild": 11, f"{job}DatabaseToSchema": 3, f"{job}SchemaToTask": 3, f"{job}TaskToStatement": 3,
        f"{job}StatementToCalculation": 8, "core.DataSourceParentChild": 6, "core.DataSetToDataElementParentship": 23,
        "core.DataSetDataFlow": 6, "core.DirectionalDataFlow": 16,
    }
    assets = E.event_assets(derived)
    assert dict(rows(Q.class_counts(assets))) == {
        "core.Resource": 4, "core.DataSource": 4, "core.DataSet": 6, "core.DataElement": 23, f"{job}Database": 3,
        f"{job}Schema": 3, f"{job}Task": 3, f"{job}Statement": 3, f"{job}Calculation": 8,
    }
    assert Q.dangling_links(links, assets).count() == 0
    edges = rows(E.resolve_columns(derived), "target_column", "source_column")
    assert ("timestamp", "timestamp") in edges and len(edges) == 8


def edges_of(spark, *events, config=LineageConfig()):
    return rows(E.resolve_columns(E.derive(parsed(spark, *events, config=config), config)), "target_column", "source_column")


def test_resolution_order(spark):
    box = [{"name": "box", "fields": leafs("a", "b")}]

    def edges(target, field, kinds, fields=box):
        inputs = [fed("n", "s.t", field, k) for k in kinds]
        out = dataset("n", "o", leafs(target), {target: {"inputFields": inputs}})
        return edges_of(spark, event([dataset("n", "s.t", fields)], [out]))

    assert edges("a", "box", ["INDIRECT"]) == [("a", "a")]
    assert edges("z", "box", ["DIRECT"]) == [("z", "a"), ("z", "b")]
    assert edges("z", "box", ["INDIRECT"]) == []
    assert edges("z", "other", [None]) == [("z", "other")]
    assert edges("z", "box", ["INDIRECT", "direct"]) == [("z", "a"), ("z", "b")]
    assert edges("loadDateTime", "box", [None], [{"name": "box", "fields": leafs("x", "event_timestamp")}]) == [
        ("loadDateTime", "event_timestamp")
    ]


def test_a_later_dataset_or_field_of_one_name_counts(spark):
    lineage = {"z": {"inputFields": [fed("n", "t", "box")]}}
    inputs = [
        dataset("n", "t", [{"name": "box", "fields": leafs("old")}]),
        dataset("n", "t", [{"name": "box", "fields": leafs("first")}, {"name": "`box`", "fields": leafs("last")}]),
    ]
    assert edges_of(spark, event(inputs, [dataset("n", "o", None, lineage)])) == [("z", "last")]
    derived = E.derive(parsed(spark, event(inputs, [dataset("n", "o", None, lineage)])))
    assert rows(E.dataset_columns(derived)) == [("n._default/t", "first"), ("n._default/t", "last")]


def test_unresolved_source_dataset_is_kept(spark):
    out = dataset("n", "o", None, {"z": {"inputFields": [fed("n", "gone", "box", "INDIRECT")]}})
    fields = [{"name": "box", "fields": leafs("a", "b")}]
    derived = E.derive(parsed(spark, event([dataset("n", "gone", fields), dataset("m", "i", None)], [out])))
    ids = [r[0] for r in rows(E.physical_assets(derived), "external_id")]
    assert "n._default/gone" in ids and edges_of(spark, event([dataset("n", "gone", fields)], [out])) == []


def chain(depth):
    field = {"name": "leaf"}
    for i in range(depth):
        field = {"name": f"c{i}", "fields": [field]}
    return [field]


def test_nesting_below_the_typed_levels(spark):
    config = LineageConfig(max_depth=3)
    for depth, use in ((3, config), (4, config), (20, config), (20, LineageConfig())):
        deep = event([dataset("n", "i", chain(depth))], [dataset("n", "o", [])])
        found = E.dataset_columns(E.derive(parsed(spark, deep, config=use), use))
        assert rows(found) == [("n._default/i", "leaf")]


def test_leaves_of_any_depth_are_found(spark):
    fields = [{"name": "box", "fields": [*leafs("a{"), *chain(60), {"name": "none", "fields": []}, *leafs("timestamp", "b")]}]
    for use in (LineageConfig(max_depth=1), LineageConfig()):
        deep = event([dataset("n", "i", fields)], [dataset("n", "o", [])])
        found = rows(E.dataset_columns(E.derive(parsed(spark, deep, config=use), use)))
        assert found == [("n._default/i", name) for name in ("a{", "b", "leaf", "none", "timestamp")]


def test_a_monstrous_schema_stops_nothing(spark):
    flat = event([dataset("n", "fine", leafs("a"))], [dataset("n", "o", [])])
    monster = event([dataset("n", "i", chain(60))], [dataset("n", "o", [])])
    found = rows(E.dataset_columns(E.derive(parsed(spark, monster, flat))))
    assert ("n._default/fine", "a") in found and len(found) == 2


def test_split_files_number_their_lines(spark, tmp_path):
    lines = [json.dumps({"eventType": f"E{i}"}) if i % 5 else "\t " for i in range(1, 400)]
    (tmp_path / "a.jsonl").write_text("\r\n".join(lines))
    (tmp_path / "b.NDJSON").write_text("\n".join(lines[:7]) + "\n")
    (tmp_path / "c.txt").write_text("no events")
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        read = read_event_lines(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 3
        got = rows(read, "file", "line_number", "value")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    wanted = [("a.jsonl", i, x) for i, x in enumerate(lines, 1) if i % 5] + [
        ("b.NDJSON", i, x) for i, x in enumerate(lines[:7], 1) if i % 5
    ]
    assert got == sorted(wanted, key=repr)
    assert parse_events(read).where("is_valid").count() == len(wanted)


def test_partial_null_and_malformed_events(spark):
    flat = three_samples()[0]
    no_out = {**flat, "outputs": None}
    bare = {"eventType": "START"}
    events = parsed(spark, flat, no_out, bare, '{"inputs": [', "not json")
    assert E.derive(events).count() == 1
    problems = rows(D.event_problems(events), "file", "error_type")
    assert [p for p in problems if p[0] == "f1"] == [
        ("f1", "No column lineage facet - Cannot generate DirectionalDataFlow"),
        ("f1", "No outputs - Cannot generate DataSetDataFlow"),
    ]
    assert len([p for p in problems if p[0] == "f2"]) == 5
    assert [p for p in problems if p[0] in ("f3", "f4")] == [("f3", "Invalid JSON"), ("f4", "Invalid JSON")]
    summary = {r["file"]: r for r in D.file_summary(events).collect()}
    assert summary["f0"]["lineage_ready_events"] == 1
    assert summary["f0"]["can_generate_dataset_dataflow_percent"] == "100.0%"
    assert summary["f2"]["can_generate_directional_lineage_percent"] == "0.0%"
    assert summary["f3"]["can_generate_dataset_dataflow_percent"] == "N/A"


def test_scan_numbers_lines_and_takes_both_suffixes(spark, tmp_path):
    flat = json.dumps(three_samples()[0])
    (tmp_path / "a b.NDJSON").write_text(f"\n{flat}\n\nbroken\n")
    (tmp_path / "c.jsonl").write_text(flat)
    (tmp_path / "d.txt").write_text(flat)
    events = parse_events(read_event_lines(spark, str(tmp_path)))
    assert rows(events, "file", "line_number", "is_valid") == [
        ("a b.NDJSON", 2, True), ("a b.NDJSON", 4, False), ("c.jsonl", 1, True),
    ]


def test_ill_typed_parts_cost_only_themselves(spark):
    whole = three_samples()[0]
    inputs, outputs = whole["inputs"], whole["outputs"]
    odd = {**whole, "inputs": ["text", *inputs, 7, [1], True, {"namespace": "db://h", "name": "s.odd", "facets": "x"}], "outputs": [*outputs, 1.5]}
    deep = {**whole, "inputs": [*inputs, {"namespace": "db://h", "name": "s.t2", "facets": {"schema": {"fields": 3}}}]}
    none = {**whole, "inputs": 5, "outputs": {"name": "no list"}}
    events = parsed(spark, whole, odd, deep, none)
    counts = rows(events, "file", "is_valid", "ill_typed", F.size("event.inputs"), F.size("event.outputs"))
    n, m = len(inputs), len(outputs)
    assert [c[:3] for c in counts] == [("f0", True, 0), ("f1", True, 6), ("f2", True, 1), ("f3", True, 0)]
    assert [c[3:] for c in counts[:3]] == [(n, m), (n + 1, m), (n + 1, m)]
    links = {r["file"]: set() for r in events.select("file").collect()}
    for file in links:
        links[file] = set(rows(E.event_links(E.derive(events.where(F.col("file") == file)))))
    assert links["f0"] < links["f1"] and links["f0"] < links["f2"] and not links["f3"]
    found = rows(D.event_problems(events).where(F.col("error_type") == D.ILL_TYPED), "file")
    assert found == [("f1",), ("f2",)]


def test_event_text_is_read_once_and_stays_where_it_is(spark, tmp_path):
    lines = [json.dumps({"eventType": "START", "n": n}) if n % 3 else "broken {" for n in range(200)]
    (tmp_path / "a.jsonl").write_text("\n\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        graph = event_graph(spark, str(tmp_path))
        numbers = graph.reports["problems"].where(F.col("error_type") == "Invalid JSON")
        assert sorted(r[0] for r in rows(numbers, "line_number")) == [2 * n + 1 for n in range(0, 200, 3)]
        plan = graph.links._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan text") == 1 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_streams_go_on_after_a_stop_in_the_middle(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for n, line in enumerate(three_samples() * 2):
        text = line if isinstance(line, str) else json.dumps(line)
        (landing / f"{n}.jsonl").write_text(text.replace('"runId": "r"', f'"runId": "r{n % 4}"') + "\nno json\n")
    lines = event_line_stream(spark, str(landing), files_per_batch=1)
    for start, out in ((start_graph_stream, "graph"), (start_problem_stream, "problems")):
        query = start(lines, str(tmp_path / out), str(tmp_path / f"{out}-state"))
        while query.isActive and not query.recentProgress:
            time.sleep(0.05)
        query.stop()
        start(lines, str(tmp_path / out), str(tmp_path / f"{out}-state")).awaitTermination()
    batch = parse_events(read_event_lines(spark, str(landing)))
    derived = E.derive(batch)
    assert rows(streamed(spark, str(tmp_path / "graph"), "link")) == rows(E.event_links(derived))
    assert rows(streamed(spark, str(tmp_path / "graph"), "asset")) == rows(E.event_assets(derived))
    assert rows(spark.read.parquet(str(tmp_path / "problems")).drop("line_number")) == rows(D.event_problems(batch).drop("line_number"))


def test_events_of_orders_are_dealt_out_once_and_say_what_they_did(spark, tmp_path):
    lines = [(1, 1, 52, 11, "R", "O"), (1, 2, 3, 8, "A", "F"), (5, 3, 7, None, None, "O"), (7, 1, 1, 1, "N", "F"), (None, 1, 1, 1, "N", "F")]
    kind = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, kind).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(1, 1, "F", "5-LOW"), (5, 1, "O", None), (7, 2, "P", "1-URGENT"), (None, 2, "O", "1-URGENT"), (19, 1, "O", "x")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    customers = spark.createDataFrame([(1, 3, 'A "Q"'), (2, None, None)], "c_custkey long, c_nationkey int, c_mktsegment string")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism + 3)
    try:
        found = event_lines(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() == tasks(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    texts = {r["line_number"]: json.loads(r["value"]) for r in found.collect()}
    assert set(texts) == {2, 6, 8, None, 20}
    first = texts[2]
    assert first["job"]["name"] == 'load_a "q"' and first["outputs"][0]["name"] == 'curated/a "q"'
    assert [d["namespace"] for d in first["inputs"]] == ["", "db://host-1.x:5432"]
    assert [f["name"] for f in first["inputs"][0]["facets"]["schema"]["fields"]] == ["partkey", '"brand"', "Time-Stamp", "detail"]
    fed_by = first["outputs"][0]["facets"]["columnLineage"]["fields"]
    assert list(fed_by) == ["partkey", "'retail'", "loadDateTime", "summary", "brand name", "updated", "orphan"]
    assert [(f["field"], [t["type"] for t in f["transformations"]]) for f in fed_by["updated"]["inputFields"]] == [
        ("`Time-Stamp`", ["direct"]), ("`Time-Stamp`", ["INDIRECT"])
    ]
    assert fed_by["orphan"] == {"inputFields": []}
    assert [d["name"] for d in texts[6]["outputs"]] == ['curated/a "q"', 'audit.a "q"'] and "namespace" not in texts[6]["inputs"][0]
    assert "outputs" not in texts[8] and texts[8]["inputs"] == [{"namespace": "db://host-1.x:5432", "name": "/landing.v1/part_1"}]
    # No id, no answer to what depends on it: inputs of an open order, the run, the job and the lineage.
    assert texts[None]["run"] == {"facets": {}} and not {"inputs", "job"} & set(texts[None])
    assert "inputs" not in texts[20]


def test_only_what_needs_sources_resolves_them(spark):
    event = {"inputs": [dataset("a", "b.c", leafs("x"))], "outputs": [dataset("d", "e.f", leafs("y"), {"y": {"inputFields": [fed("a", "b.c", "x")]}})]}
    lines = spark.createDataFrame([("f", 1, json.dumps(event))], "file string, line_number long, value string")
    derived = E.derive(parse_events(lines))

    def plan(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString()

    assert "datetime" in plan(E.resolve_columns(derived)) and "datetime" not in plan(E.job_assets(derived))
    calculations = E.job_assets(derived).where(F.col("class").endswith("Calculation"))
    assert [r["name"] for r in calculations.collect()] == ["y"]
    # A text that is read data set by data set is parsed once for that.
    assert plan(parse_events(lines)).count("parseJson") == 1


def test_sources_are_found_by_namespace_and_name_together(spark):
    """Pairs that are the same text when put together, nulls, and a source that no input states."""
    inputs = [dataset("1", "a.t", leafs("x_timestamp")), dataset("", "1a.t", leafs("x")), dataset(None, "1a.t", leafs("z"))]
    sources = [fed("1", "a.t", "x"), fed("", "1a.t", "x"), fed(None, "1a.t", "'q'"), fed("n", "m", "`w`")]
    event = {"inputs": inputs, "outputs": [dataset("d", "e.f", None, {"y": {"inputFields": sources}})]}
    lines = spark.createDataFrame([("f", 1, json.dumps(event))], "file string, line_number long, value string")
    found = E.resolve_columns(E.derive(parse_events(lines))).select("source_key", "source_column")
    assert rows(found) == sorted([("1.a/t", "x"), ("dft_src.1a/t", "x"), ("dft_src.1a/t", "q"), ("n._default/m", "w")], key=repr)
