import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lineweft.adapters.calcviews import calcview_docs
from lineweft.adapters.scripts import script_files
from lineweft.config import LineageConfig
from lineweft.functions import vocabulary as V
from lineweft.operators import metadata as M
from lineweft.operators import scripts as S
from lineweft.operators.quality import dangling_links
from lineweft.operators.ranking import with_position
from lineweft.plans.graphs import script_graph_of
from lineweft.sources.scripts import METADATA_DDL, load_metadata, read_documents, read_scripts

FACT = "task string, stmt_no bigint, src_schema string, src_table string, src_col string, tgt_schema string, tgt_table string, tgt_col string"


def refs(spark, text):
    scripts = spark.createDataFrame([("a.sql", text)], "file string, text string")
    return rows(S.table_refs(S.statements(scripts)), "stmt_no", "targets", "sources", "state")


def test_references(spark):
    text = """
    CREATE TABLE by_state AS SELECT State, COUNT(*) AS n, EXTRACT(YEAR FROM made) y FROM dbo.people GROUP BY State;
    CREATE VIEW lake.stage.v SECURITY INVOKER AS

    SELECT * FROM lake.raw.t;
    ; DROP TABLE x; /* insert into c select 1 from d */ SELECT 1;
    WITH a AS (SELECT * FROM s.t1), b AS (SELECT * FROM a JOIN "q s".t2 z ON 1=1)
      INSERT INTO out.t SELECT * FROM b, s.t3 c, (SELECT 1) d
    """
    assert refs(spark, text) == [
        (1, ["<default>.by_state"], ["dbo.people"], "usable"),
        (2, ["lake.stage.v"], ["lake.raw.t"], "usable"),
        (3, [], [], "unparsed"),
        (4, [], [], "unparsed"),
        (5, ["out.t"], ["s.t1", "q s.t2", "s.t3"], "usable"),
    ]


def test_files_and_metadata(spark, tmp_path):
    (tmp_path / "one two.sql").write_text("SELECT 1")
    (tmp_path / "other.txt").write_text("SELECT 2")
    assert rows(read_scripts(spark, str(tmp_path))) == [("one two.sql", "SELECT 1")]
    (tmp_path / "m.json").write_text('{"metadata":{"sources":[{"table":"t","columns":["a","b"]},{"table":"t","columns":["c"]}]}}')
    documents = read_documents(spark, str(tmp_path), METADATA_DDL).withColumn("document", F.col("file"))
    assert rows(load_metadata(documents, F.col("metadata.sources"))) == [("m.json", "<default>.t", 0, "c")]


def test_stars_and_publication(spark):
    facts = spark.createDataFrame(
        [
            ("f.sql", 1, "lake.raw", "t", "*", "mart", "u", "*"),
            ("f.sql", 1, "lake.raw", "t", "a", "mart", "u", "b"),
            ("f.sql", 2, "lake.raw", "t", "*", "<default>", "w", "*"),
            ("f.sql", 3, "lake.raw", "t", "*", "mart", "u", "n"),
            ("f.sql", 4, "lake", "raw", "x", "mart", "u", "y"),
        ],
        FACT,
    )
    known = S.prepare_facts(facts, LineageConfig(source_resource="r", target_resource="r"))
    assert rows(known, "stmt_no", "src_column", "tgt_column") == [
        (1, "a", "b"), (2, "t.*", "w.*"), (3, "t.*", "n"), (4, "x", "y"),
    ]
    sources = S.known_sources(known)
    ids = known.select("task", F.explode(F.array("src_element", "tgt_element", "src_dataset")).alias("raw_id")).distinct()
    published = {r["raw_id"]: r["published_id"] for r in S.published_ids(ids, sources).collect()}
    assert published["r/lake/raw/t/a"] == "REFERENCE_LAKE_RAW_CONN_DS/t/a"
    assert published["r/lake/raw"] == "REFERENCE_LAKE_RAW_CONN_DS"
    assert published["r/<default>/w/w.*"] == "REFERENCE_DEFAULT_CONN_DS/w/w.*"


def test_positions_match_a_plain_sort(spark):
    values = [(g, f"{(i * 7919) % 997:04d}") for g in ("hot", "cold") for i in range(500 if g == "hot" else 20)]
    df = spark.createDataFrame(values, "g string, v string")
    got = rows(with_position(df, ["g"], ["v"], "n"))
    want = sorted(
        [(g, v, i + 1) for g in ("hot", "cold") for i, v in enumerate(sorted(x for h, x in values if h == g))], key=repr
    )
    assert got == want


def test_fixpoint_ends_on_a_cycle_and_keeps_first_spelling(spark):
    metadata = spark.createDataFrame([("a", 0, "Id"), ("a", 1, "ID"), ("c", 0, "own")], "table string, pos int, column string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("b", "b")], "src_table string, tgt_table string")
    assert rows(M.star_fixpoint(metadata, edges, consolidate_every=1), "table", "column", "round") == [
        ("a", "Id", 0), ("b", "Id", 1), ("b", "own", 1), ("c", "Id", 2), ("c", "own", 0),
    ]


def test_metadata_grows_the_script_graph_without_dangling_links(spark):
    files = spark.createDataFrame(
        [("f.sql", "INSERT INTO m.u SELECT * FROM l.t; INSERT INTO m.w (x) WITH c (x, y) AS (SELECT 1, 2 FROM m.u) SELECT x FROM c")],
        "file string, text string",
    )
    facts = spark.createDataFrame([("f.sql", 1, "l", "t", "*", "m", "u", "*"), ("f.sql", 2, "m", "u", "A", "m", "w", "x")], FACT)
    metadata = spark.createDataFrame([("l.t", "a"), ("l.t", "b"), ("other.t", "z")], "table string, column string")
    assert refs(spark, files.first()["text"])[1] == (2, ["m.w"], ["m.u"], "usable")
    config = LineageConfig(source_resource="r", target_resource="r")
    plain, rich = (script_graph_of(files, facts, config, m) for m in (None, metadata))
    elements = lambda g: rows(g.assets.where(F.col("class").endswith("DataElement")), "external_id")
    added = {x[0] for x in elements(rich)} - {x[0] for x in elements(plain)}
    assert {x.rsplit("/", 2)[-2:][0] + "/" + x.rsplit("/", 1)[-1] for x in added} >= {"t/a", "t/b", "u/b"}
    assert not any(x.endswith("/z") for x in added)
    for graph in (plain, rich):
        assert dangling_links(graph.links, graph.assets).count() == 0


def _published(raw_id, sources):
    """The longest known prefix becomes its connection, by trying every prefix."""
    parts = raw_id.split("/")
    for n in range(len(parts), 0, -1):
        prefix = "/".join(parts[:n])
        if prefix in sources:
            connection = "REFERENCE_" + "_".join(parts[1:n]).upper().replace("<", "").replace(">", "") + "_CONN"
            return f"{connection}_DS{raw_id[len(prefix):]}"
    return raw_id


def _nested_facts(seed, n):
    """Facts of which some sources lie below others and some data sets and elements have the ids of sources."""
    rng = random.Random(seed)
    schemas, tables, columns = ["lake", "lake.raw", "lake.raw.x", "lake.raw-1", "erp", "<default>", None], ["raw", "x", "t", "raw/x"], ["a", "x", "*", "raw"]
    pick = lambda: (rng.choice(schemas), rng.choice(tables), rng.choice(columns))
    return [(rng.choice(["a.sql", "b.sql"]), rng.randrange(1, 5), *pick(), *pick()) for _ in range(n)]


def test_ids_are_published_by_their_longest_source(spark):
    facts = spark.createDataFrame(_nested_facts(1, 60), FACT)
    known = S.prepare_facts(facts, LineageConfig(source_resource="r", target_resource="q"))
    sources = {}
    for task, source in rows(S.known_sources(known)):
        sources.setdefault(task, set()).add(source)
    ids = known.select("task", F.explode(F.array("src_element", "tgt_dataset", "src_source")).alias("raw_id")).distinct()
    more = spark.createDataFrame([("a.sql", "q"), ("a.sql", "q/none/t"), ("c.sql", "r/erp/t"), ("a.sql", None)], "task string, raw_id string")
    got = rows(S.published_ids(ids.unionByName(more), S.known_sources(known)))
    assert len(got) > 60 and got == sorted(
        ((t, i, i and _published(i, sources.get(t, ()))) for t, i in rows(ids.unionByName(more))), key=repr
    )


def test_script_links_of_nested_sources(spark):
    """Every raw link, its ends replaced one by one."""
    config = LineageConfig(source_resource="r", target_resource="q")
    text = "CREATE TABLE lake.raw.x AS SELECT * FROM lake.raw, erp.t; INSERT INTO t SELECT 1 FROM lake.raw.x.y.z; DROP TABLE x"
    files = spark.createDataFrame([("a.sql", text), ("b.sql", "SELECT 1; INSERT INTO erp.x SELECT * FROM none.here")], "file string, text string")
    refs = S.table_refs(S.statements(files), config)
    facts = S.prepare_facts(spark.createDataFrame(_nested_facts(2, 80), FACT), config)
    columns = S.script_columns(facts)
    sources, final, raw = {}, {}, set()
    for task, source in rows(S.known_sources(facts)):
        sources.setdefault(task, set()).add(source)
    scripts = {r.statement_id: r for r in S.usable_scripts(refs, config).collect()}
    for r in columns.collect():
        final[r.task, r.calculation_id] = r.external_id
        if r.statement_id in scripts:
            raw.add(("", scripts[r.statement_id].external_id, r.external_id, V.SCRIPT_TO_COLUMN))
    final |= {(r.task, i): r.external_id for i, r in scripts.items()}
    path = lambda resource, table: f"{resource}/{table.replace('.', '/')}"
    for r in refs.collect():
        parser = f"SQLPARSER_{r.file.upper().replace('.', '_')}"
        raw.add(("", V.ROOT_UPPER, parser, V.RESOURCE_PARENT_CHILD))
        if r.state == "usable":
            sid = f"{config.script_path}/{r.file}/statement_{r.stmt_no}"
            read, written = [path("r", s) for s in r.sources], path("q", r.targets[0])
            raw |= {(r.file, d.rpartition("/")[0], d, V.DATASOURCE_PARENT_CHILD) for d in [*read, written]}
            raw |= {(r.file, d, sid, V.DATASET_FLOW) for d in read} | {(r.file, sid, written, V.DATASET_FLOW)}
            raw.add(("", parser, scripts[sid].external_id, V.PARSER_TO_SCRIPT))
    for f in facts.collect():
        raw |= {(f.task, d.rpartition("/")[0], d, V.DATASOURCE_PARENT_CHILD) for d in (f.src_dataset, f.tgt_dataset)}
        raw |= {(f.task, d, e, V.DATASET_ELEMENT) for d, e in ((f.src_dataset, f.src_element), (f.tgt_dataset, f.tgt_element))}
        raw |= {(f.task, f.src_element, f.calculation_id, V.COLUMN_FLOW), (f.task, f.calculation_id, f.tgt_element, V.COLUMN_FLOW)}
        raw |= {(f.task, f.src_dataset, f.statement_id, V.DATASET_FLOW), (f.task, f.statement_id, f.tgt_dataset, V.DATASET_FLOW)}
    for of_task in sources.values():
        raw |= {("", _published(s, {s})[:-3], _published(s, {s}), V.RESOURCE_PARENT_CHILD) for s in of_task}

    def out(task, raw_id):
        if task == "" or (task, raw_id) in final:
            return final.get((task, raw_id), raw_id)
        # An element follows its data set unless it is a source itself, which the longest prefix gives as well.
        return _published(raw_id, sources.get(task, ()))

    expected = {(out(t, s), out(t, e), a) for t, s, e, a in raw}
    got = [tuple(r) for r in S.script_links(refs, facts, columns, config).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_repeated_links_meet_their_places_once(spark):
    kind = "source string, target string, association string"
    root = [("$R", "A", "p", 0, False, "A"), ("REFERENCE_DEFAULT_CONN", "x_DS", "p", 1, True, "REFERENCE_DEFAULT_CONN")]
    root_frame = spark.createDataFrame(root, f"{kind}, part int, is_default boolean, place string")
    links = [("REFERENCE_DEFAULT_CONN", "x_DS", "p"), ("z", "y", "f"), ("z", "y", "f"), (None, "y", "f"), (None, "y", "f")]
    found = S.ordered_script_links(root_frame, spark.createDataFrame(links, kind))
    others = [("z", "y", "f", None, None, None), (None, "y", "f", None, None, None)]
    assert rows(found) == sorted([*root, *others], key=repr)
    # The grouping keeps its state in place, without a sort of all links.
    assert "SortAggregate" not in found._jdf.queryExecution().toString()


def test_documents_of_a_single_split_are_dealt_out(spark, tmp_path):
    part = spark.range(40).select(F.col("id").alias("p_partkey"), (F.col("id") % 30).cast("int").alias("p_size"))
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    name = F.concat(F.lit("Customer#"), F.col("id").cast("string")).alias("c_name")
    customer = spark.range(40).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey"), F.lit("BUILDING").alias("c_mktsegment"), name
    )
    customer.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    for documents in (script_files(spark, str(tmp_path)), calcview_docs(spark, str(tmp_path))):
        held = documents.groupBy(F.spark_partition_id()).count().collect()
        assert len(held) > 2 and sum(r["count"] for r in held) == 40


def _reached(metadata, edges):
    """Columns by breadth-first search: (table, key) to (spelling, edges)."""
    found = {}
    for table, column in sorted(metadata):
        found.setdefault((table, column.lower()), (0, column))
    frontier, n = dict(found), 0
    while frontier:
        n, new = n + 1, {}
        for (table, key), (_, column) in frontier.items():
            for source, target in edges:
                if source == table and (target, key) not in found:
                    new[target, key] = min(new.get((target, key), (n, column)), (n, column))
        found |= new
        frontier = new
    return sorted((t, k, c, n) for (t, k), (n, c) in found.items())


def test_fixpoint_of_long_chains_takes_few_rounds(spark):
    edges = [(f"t{i}", f"t{i + 1}") for i in range(200)]
    metadata = [("t0", "A"), ("t150", "b"), ("t150", "a")]
    lengths = []
    found = M.star_fixpoint(
        spark.createDataFrame(metadata, "table string, column string"),
        spark.createDataFrame(edges, "src_table string, tgt_table string"),
        on_round=lengths.append,
    )
    assert rows(found, "table", "column_key", "column", "round") == _reached(metadata, edges)
    assert len(lengths) <= 9 and lengths[:3] == [1, 2, 4]


@pytest.mark.parametrize("growth", [0, 1, 4])
def test_fixpoint_of_hubs_cycles_and_branches(spark, growth):
    rng = random.Random(growth)
    edges = [(f"s{i}", "hub") for i in range(12)] + [("hub", f"e{i}") for i in range(12)]
    edges += [(f"c{i}", f"c{(i + 1) % 5}") for i in range(5)] + [("e3", "c0"), ("x", "x"), ("none", "c1")]
    edges += [(f"r{rng.randrange(12)}", f"r{rng.randrange(12)}") for _ in range(14)] + [("r1", "s1")]
    metadata = [(f"s{i}", rng.choice("aAbB")) for i in range(12)] + [("c2", "own"), ("x", "y"), ("r0", "z"), ("r5", "Z"), ("lone", "l")]
    metadata = list(dict.fromkeys(metadata))
    lengths = []
    found = M.star_fixpoint(
        spark.createDataFrame(metadata, "table string, column string"),
        spark.createDataFrame(edges, "src_table string, tgt_table string"),
        max_growth=growth,
        consolidate_every=3,
        on_round=lengths.append,
    )
    assert rows(found, "table", "column_key", "column", "round") == _reached(metadata, edges)
    assert growth or set(lengths) == {1}
