import csv
import io
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lineweft import session
from lineweft.operators.quality import file_row_width
from lineweft.operators.scripts import ROOT_ORDER
from lineweft.sinks import export
from lineweft.sinks.append import append_hashed, read_hashed, touched
from lineweft.sinks.ordered import read_in_order
from lineweft.sources.files import split_lines


def _written(rng, rows, line_end):
    """A CSV text with commas, quotes and line ends in values, empty lines, and some rows of another width."""
    out, bad = io.StringIO(newline=""), 0
    writer = csv.writer(out, lineterminator=line_end)
    writer.writerow(["id", "text", 'na"me'])
    values = ["", "a,b", 'say ""hi""', "two\nlines", '"', ',"\n",\n\n"', "plain"]
    for n in range(rows):
        row = [n, rng.choice(values), rng.choice(values)]
        if rng.random() < 0.1:
            row, bad = rng.choice([row[:2], [*row, "x\ny"]]), bad + 1
        writer.writerow(row)
        if rng.random() < 0.05:
            out.write(line_end)
    return out.getvalue(), bad


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_record_widths_across_splits(spark, tmp_path, line_end):
    rng = random.Random(7)
    expected = []
    for name, n in (("a.csv", 900), ("b c.csv", 300), ("head.csv", 0)):
        text, bad = _written(rng, n, line_end)
        (tmp_path / name).write_text(text, newline="")
        expected.append((name, 3, n, bad))
    (tmp_path / "open.csv").write_text('a,b\n1,"never closed\n2,3\n4,5,6\n')
    (tmp_path / "empty.csv").write_text("")
    expected.append(("open.csv", 2, 1, 0))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    try:
        lines = split_lines(spark, str(tmp_path))
        assert lines.select("path", "block").distinct().count() > 100
        found = file_row_width(lines).withColumn("file", F.url_decode(F.substring_index("path", "/", -1)))
        assert rows(found, "file", "header_width", "rows", "bad_rows") == sorted(expected, key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_links_are_sorted_over_parts(spark, tmp_path):
    rng = random.Random(3)
    links = list({(f"s{rng.randrange(300)}", f"t{rng.randrange(300)}", f"a{rng.randrange(5)}") for _ in range(4000)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export.write_links(spark.createDataFrame(links, "source string, target string, association string"), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "links.csv").glob("part-*.csv"))
    assert len(parts) > 1
    read = [line for part in parts for line in part.read_text().splitlines()[1:]]
    assert read == [",".join(link) for link in sorted(links, key=lambda l: (l[2], l[0], l[1]))]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        found = read_in_order(spark, str(tmp_path / "links.csv"))
        assert [r.value for r in found.orderBy("position").collect()] == read
        assert sorted(r.position for r in found.collect()) == list(range(1, len(read) + 1))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_root_links_come_first(spark, tmp_path):
    links = [("z", "q", "b", None, None, None), ("$R", "A", "p", 0, False, "A"), ("$R", "REFERENCE_DEFAULT_CONN", "p", 0, True, "REFERENCE_DEFAULT_CONN"),
             ("$R", "B", "p", 0, False, "B"), ("B", "B_DS", "p", 1, False, "B"), ("a", "q", "b", None, None, None)]
    frame = spark.createDataFrame(
        links, "source string, target string, association string, part int, is_default boolean, place string"
    )
    export.write_links(frame, str(tmp_path), order=ROOT_ORDER)
    found = read_in_order(spark, str(tmp_path / "links.csv")).orderBy("position")
    assert [r.value for r in found.collect()] == [
        "$R,B,p", "$R,A,p", "$R,REFERENCE_DEFAULT_CONN,p", "B,B_DS,p", "a,q,b", "z,q,b",
    ]


def test_compressed_links_are_read_in_order_where_they_lie(spark, tmp_path):
    links = [(f"s{n % 90:02}", f"t{n // 90:02}", "a") for n in range(900)]
    frame = spark.createDataFrame(links, "source string, target string, association string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    # Splits have no statistics at size, so the planner would move all lines to meet them.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        export.write_links(frame, str(tmp_path), compression="gzip")
        found = read_in_order(spark, str(tmp_path / "links.csv"))
        assert "BroadcastHashJoin" in found._jdf.queryExecution().toString()
        assert [r.value for r in found.orderBy("position").collect()] == [",".join(link) for link in sorted(links)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(list((tmp_path / "links.csv").glob("part-*.csv.gz"))) > 1


def test_append_reads_touched_partitions_only(spark, tmp_path):
    path, kind = str(tmp_path / "table"), "a int, b string"
    first = [(n, None if n % 3 else "x") for n in range(200)] * 2
    assert append_hashed(spark.createDataFrame(first, kind), path, buckets=50).count() == 200
    second = spark.createDataFrame([(3, "x"), (3, "x"), (1, None), (999, None), (None, None)], kind)
    assert rows(append_hashed(second, path, buckets=50)) == sorted([(999, None), (None, None)], key=repr)
    assert append_hashed(second, path, buckets=50).count() == 0
    assert rows(read_hashed(spark, path)) == sorted({*first, (999, None), (None, None)}, key=repr)
    some = spark.createDataFrame([(7,), (7,)], "_bucket int")
    pruned = touched(spark.read.parquet(path), some)
    assert "_bucket" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def _assets(spark, layouts, n):
    """Assets of every class of a layout, with texts that need quoting, and one class that no layout has."""
    texts = ["plain", 'say "hi"', "a,b", "two\nlines", "", None, " padded ", "\\"]
    out = []
    for at, (cls, layout) in enumerate(layouts.items()):
        own = [c for c in layout.header if not c.startswith("core.")]
        for i in range(n if at else 0):
            attrs = [(c, texts[(i + at + k) % len(texts)]) for k, c in enumerate(own)]
            out.append((cls, f"id{i}", texts[i % len(texts)], "TRUE", "", attrs))
    out.append(("other.Class", "x", "x", "", "", []))
    kind = "class string, external_id string, name string, reference string, assignable string, attrs array<struct<key:string,value:string>>"
    return spark.createDataFrame(out, kind).repartition(3)


LAYOUTS = ["EVENT_LAYOUTS", "SCRIPT_LAYOUTS", "VIEW_LAYOUTS", "PACKAGE_LAYOUTS", "REPORT_LAYOUTS"]


@pytest.mark.parametrize("name", LAYOUTS)
def test_all_classes_in_one_write(spark, tmp_path, name):
    """Every layout, quoted throughout or where needed, equals what a CSV writer of its own makes of its rows."""
    layouts = getattr(export, name)
    assets, path = _assets(spark, layouts, 16), str(tmp_path / "out")
    counts = export.write_assets(assets, layouts, path)
    assert counts == {cls: 16 if at else 0 for at, cls in enumerate(layouts)}
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == sorted(f"{c}.csv" for c in layouts)
    for cls, layout in layouts.items():
        single = str(tmp_path / "single" / cls)
        export.project(assets, cls, layout).write.options(header=True, **export.csv_options(layout)).csv(single)
        options = {"header": True, "multiLine": True, "escape": '"'}
        whole, own = (spark.read.options(**options).csv(p) for p in (f"{path}/{cls}.csv", single))
        assert whole.columns == layout.header and rows(whole) == rows(own)
        for part in (tmp_path / "out" / f"{cls}.csv").glob("part-*"):
            text = part.read_text()
            assert text.startswith(export._header_line(layout) + "\n")
            assert not layout.quote_all or all(line.startswith('"') for line in text.splitlines()[:1])
    assert file_row_width(split_lines(spark, f"{path}/*.csv")).where("bad_rows > 0").count() == 0


def test_refresh_and_append(spark, tmp_path):
    layouts, path = export.SCRIPT_LAYOUTS, str(tmp_path / "out")
    cls = list(layouts)[-1]
    read = lambda: spark.read.csv(f"{path}/{cls}.csv", header=True, multiLine=True, escape='"')
    for mode, n, expected in (("overwrite", 8, 8), ("append", 3, 11), ("overwrite", 2, 2)):
        export.write_assets(_assets(spark, layouts, n), layouts, path, mode)
        assert read().count() == expected
    export.write_assets(_assets(spark, layouts, 0), layouts, path)
    assert read().count() == 0 and read().columns == layouts[cls].header


def test_tables_are_dropped_when_done(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    mark = session.written_tables()
    for n in range(3):
        last = session.cut_lineage(spark.range(n + 1))
    session.drop_tables(spark, mark, but_last=1)
    assert last.count() == 3 and len(list(tmp_path.iterdir())) == 1 and session.written_tables() == mark + 1
    session.drop_tables(spark, mark)
    assert not list(tmp_path.iterdir()) and session.written_tables() == mark
