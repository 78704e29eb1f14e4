import io
import json
import zipfile

from conftest import rows

from lineweft.config import LineageConfig
from lineweft.operators import calcviews as H
from lineweft.operators import reports as P
from lineweft.operators.quality import dangling_links
from lineweft.plans.graphs import event_graph_of, view_graph_of, write_graph
from lineweft.sinks.append import append_new
from lineweft.sources.calcviews import parse_calcviews
from lineweft.sources.reports import read_report_layouts
from lineweft.streaming.ingest import event_line_stream, start_link_stream

VIEW = """<?xml version="1.0"?>
<Calculation:scenario xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xmlns:Calculation="http://c" id="AGING">
<dataSources/><calculationViews><calculationView xsi:type="Calculation:SqlScriptView" id="Script_View">
<viewAttributes><viewAttribute datatype="NVARCHAR" id="BUYER"/></viewAttributes>
<definition>WITH items AS (SELECT B.BUYER, NVL(B.DUE, (1)) AS DAYS FROM &quot;FI&quot;.&quot;OPEN&quot; AS B),
 rich AS (SELECT i.BUYER, K.NAME FROM items AS i LEFT JOIN &quot;FI&quot;.&quot;BUYERS&quot; AS K ON i.BUYER = K.BUYER)
 SELECT * FROM rich</definition></calculationView></calculationViews>
<logicalModel><attributes><attribute id="BUYER"/></attributes><baseMeasures><measure id="Days"/></baseMeasures></logicalModel>
</Calculation:scenario>"""


def views(spark, *documents):
    return spark.createDataFrame([(f"v{i}.hdbcalculationview", d) for i, d in enumerate(documents)], "file string, xml string")


def test_scoped_view_lineage(spark):
    derived = H.derive(parse_calcviews(views(spark, VIEW, "<broken")))
    block = "custom.sap.hana.calscript.v7.HanaScriptBlock/AGING/"
    view = "custom.sap.hana.calscript.v7.HanaCalcView/AGING"
    assert rows(H.view_dataset_flow(derived), "source", "target") == [
        ("REF_HANA_FI_DS/BUYERS", block + "rich"), ("REF_HANA_FI_DS/OPEN", block + "items"),
        (block + "items", block + "rich"), (block + "rich", view),
    ]
    field = "custom.sap.hana.calscript.v7.HanaCalcViewField/AGING/BUYER"
    assert rows(H.view_column_flow(derived), "source", "target") == [
        ("REF_HANA_FI_DS/BUYERS/BUYER", field), ("REF_HANA_FI_DS/OPEN/BUYER", field),
    ]
    assert rows(H.view_fields(derived), "field", "key_attribute", "data_type") == [
        ("BUYER", "true", "NVARCHAR"), ("Days", "false", ""),
    ]


def test_view_graph_has_no_dangling_links_and_is_written(spark, tmp_path):
    graph = view_graph_of(views(spark, VIEW))
    assert dangling_links(graph.links, graph.assets).count() == 0
    write_graph(graph, str(tmp_path / "out"))
    links = spark.read.csv(str(tmp_path / "out" / "links.csv"), header=True)
    assert links.columns == ["Source", "Target", "Association"] and links.count() == graph.links.count()
    blocks = spark.read.csv(
        str(tmp_path / "out" / "custom.sap.hana.calscript.v7.HanaScriptBlock.csv"), header=True, multiLine=True, escape='"'
    )
    assert [c.split(".")[-1] for c in blocks.columns] == [
        "externalId", "name", "parent", "assignable", "scriptType", "transformationLogic",
    ]


def layout(sections):
    return json.dumps({"sections": sections})


def test_report_containers(spark, tmp_path):
    select = {"Aggregation": {"Expression": {"Column": {"Expression": {"SourceRef": {"Entity": "sales vw"}}, "Property": "total"}}}}
    config = {"singleVisual": {"visualType": "card", "prototypeQuery": {"From": [], "Select": []}}}
    transforms = {"selects": [{"displayName": "Total", "queryName": "Sum(total)", "expr": select}, {"queryRef": "x"}]}
    container = {"config": json.dumps(config), "dataTransforms": json.dumps(transforms)}
    text = layout([{"name": "S1", "displayName": "One", "visualContainers": [{"config": "plain"}, container]}])

    def write(name, members):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            for member, content in members.items():
                archive.writestr(member, content)
        (tmp_path / name).write_bytes(buffer.getvalue())

    write("My report.pbix", {"Report/Layout": text.encode("utf-16-le")})
    write("Empty.pbix", {"Other": b"x"})
    (tmp_path / "Bad.pbix").write_bytes(b"no zip")
    write("Odd.pbix", {"Report/Layout": text.encode("utf-16-le")[:-1]})
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("Report/Layout", text.encode("utf-16-le"))
    damaged = bytearray(packed.getvalue())
    damaged[60:90] = b"\xff" * 30
    (tmp_path / "Damaged.pbix").write_bytes(bytes(damaged))
    layouts = read_report_layouts(spark, str(tmp_path))
    errors = {r["report_name"]: r["error"] for r in layouts.collect()}
    assert errors["Odd"].startswith("damaged") and errors["Damaged"]
    assert errors["My report"] is None and errors["Empty"].startswith("no Report/Layout") and "zip" in errors["Bad"]
    derived = P.derive(P.parse_layouts(layouts), LineageConfig(max_depth=3))
    fields = P.visual_fields(derived)
    assert rows(fields, "field_name", "field_type", "table", "column") == [("Total", "Measure", "sales vw", "total")]
    uid = fields.first()["report_uid"]
    assert uid.startswith("My_report_") and fields.first()["visual_id"] == f"{uid}/S1/Visual1_card"
    assert P.report_links(derived).count() == 14


def test_expressions_of_any_depth(spark):
    def nested(kind, entity, levels):
        inner = {"Column": {"Expression": {"SourceRef": {kind: entity}}, "Property": f"c{levels}"}}
        for _ in range(levels):
            inner = {"Layer": {"Expression": inner, "Other": "{"}, "Later": {"Expression": {"SourceRef": {kind: "later"}}}}
        return {"Aggregation": {"Expression": inner}}

    depths = (0, 3, 12, 20, 60)
    transforms = {"selects": [{"displayName": f"d{n}", "expr": nested("Entity", f"t{n}", n)} for n in depths]}
    query = {"From": [{"Name": f"a{n}", "Entity": f"q{n}"} for n in depths],
             "Select": [{**nested("Source", f"a{n}", n), "Name": f"n{n}"} for n in depths]}
    config = lambda q: json.dumps({"singleVisual": {"visualType": "card", "prototypeQuery": q}})
    visuals = [{"config": config({"From": [], "Select": []}), "dataTransforms": json.dumps(transforms)}, {"config": config(query)}]
    docs = [("R", layout([{"name": "S", "displayName": "S", "visualContainers": visuals}]))]
    derived = P.derive(P.parse_layouts(spark.createDataFrame(docs, "report_name string, layout_json string")), LineageConfig(max_depth=3))
    found = rows(P.visual_fields(derived), "field_name", "table", "column")
    assert found == sorted([(f"d{n}", f"t{n}", f"c{n}") for n in depths] + [(f"n{n}", f"q{n}", f"c{n}") for n in depths])


def event(i):
    make = lambda ns, name: {"namespace": ns, "name": name, "facets": {"schema": {"fields": [{"name": "a"}]}}}
    return json.dumps({"job": {"namespace": "n", "name": f"j{i % 2}"}, "inputs": [make("x", f"t{i}")], "outputs": [make("y", "o")]})


def test_stream_continues_and_equals_the_batch(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "links", "checkpoint"))
    (tmp_path / "landing").mkdir()

    def run(first, last):
        for i in range(first, last):
            (tmp_path / "landing" / f"e{i}.ndjson").write_text(event(i) + "\n\n" + event(0) + "\n")
        start_link_stream(event_line_stream(spark, landing, 2), target, checkpoint).awaitTermination()
        return rows(spark.read.parquet(target))

    run(0, 2)
    streamed = run(2, 4)
    lines = spark.createDataFrame([("f", i, event(i)) for i in range(4)], "file string, line_number bigint, value string")
    assert streamed == rows(event_graph_of(lines).links)


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "k string, v string")
    append_new(batch, path)
    append_new(batch, path)
    append_new(spark.createDataFrame([("c", None), ("b", "x")], "k string, v string"), path)
    assert rows(spark.read.parquet(path)) == [("a", None), ("b", "x"), ("c", None)]
