"""Calculation views: parsing of nodes and SQL bodies, and the flow model.

A view is one row. Everything found in it (sources, nodes, CTE blocks with their own
dependencies, columns, fields) is kept as arrays in that row, because a CTE only ever
meets the other CTEs and tables of its own view. Rows leave the document once, as links
or assets, and are made distinct once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweft.functions import names as N
from lineweft.functions import vocabulary as V
from lineweft.functions.rows import ASSET_TYPE, LINK_TYPE, asset, explode_rows, flat_map, let, link, no_nulls, union_all

_BLANKS = " \t\n\r\x0b\x0c"
_STRINGS = "array<string>"
_SOURCES = "array<struct<id:string,schema:string,table:string>>"
_FIELDS = "array<struct<field:string,key_attribute:string,data_type:string>>"
_COLUMNS = "array<struct<schema:string,table:string,column:string>>"

# How a SQL body writes tables, CTEs, aliases and columns.
_WORD = r"[A-Za-z_][A-Za-z0-9_]*+"
_QUOTED_TABLE = rf'"([^"]+)"\s*\.\s*(?:"([^"]+)"|({_WORD}))'
_ENTITY_TABLE = rf"&quot;([^&]+)&quot;\s*\.\s*(?:&quot;([^&]+)&quot;|({_WORD}))"
_CTE_HEADER = rf"(?i)(?:WITH|,)\s+({_WORD})\s+AS\s*\("
_ALIASED = (
    r'(?i)\b(?:FROM|JOIN)\s+(?:"([^"]+)"|&quot;([^&]+)&quot;)\s*\.\s*'
    rf'(?:"([^"]+)"|&quot;([^&]+)&quot;|({_WORD}))\s*(?:AS\s+)?({_WORD})?'
)
_DOTTED = rf"\b({_WORD})\.({_WORD})\b"


def _keywords() -> Column:
    return F.array(*[F.lit(word) for word in V.SQL_KEYWORDS])


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def cte_names(sql: Column) -> Column:
    """Names of the CTEs in order, each once."""
    return F.array_distinct(_all(sql, _CTE_HEADER, 1))


def table_pairs(sql: Column) -> Column:
    """array<struct<schema, table>> of every quoted or entity-escaped table, in order of each spelling."""

    def found(pattern: str) -> Column:
        second = F.zip_with(
            _all(sql, pattern, 2), _all(sql, pattern, 3), lambda quoted, bare: F.when(quoted != "", quoted).otherwise(bare)
        )
        return F.zip_with(
            _all(sql, pattern, 1), second, lambda schema, table: F.struct(schema.alias("schema"), table.alias("table"))
        )

    return F.concat(found(_QUOTED_TABLE), found(_ENTITY_TABLE))


def sql_tables(sql: Column, ctes: Column) -> Column:
    """Physical tables: pairs whose schema is no table name of the body and that name no CTE."""

    def physical(pairs: Column) -> Column:
        names = F.transform(pairs, lambda p: p["table"])
        kept = F.filter(
            pairs,
            lambda p: ~F.array_contains(names, p["schema"])
            & ~F.array_contains(ctes, p["schema"])
            & ~F.array_contains(ctes, p["table"]),
        )
        return F.array_distinct(kept)

    return let(table_pairs(sql), physical)


def cte_body(sql: Column, name: Column) -> Column:
    """Text inside the parentheses of a CTE, found by counting parentheses."""
    header = F.concat(F.lit(r"(?i)(?:WITH|,)\s+"), name, F.lit(r"\s+AS\s*\("))
    tail = F.get(F.split(sql, header, 2), 1)

    def up_to_close(text: Column) -> Column:
        pieces = _all(text, r"[^()]*[()]", 0)
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("length"))

        def step(state: Column, piece: Column) -> Column:
            change = F.when(piece.endswith("("), 1).otherwise(-1)
            moved = F.struct(
                (state["depth"] + change).alias("depth"), (state["length"] + F.char_length(piece)).alias("length")
            )
            return F.when(state["depth"] == 0, state).otherwise(moved)

        return let(
            F.aggregate(pieces, start, step),
            lambda end: F.btrim(
                F.left(
                    text,
                    F.when(end["depth"] == 0, end["length"] - 1).otherwise(F.char_length(text) - 1),
                ),
                F.lit(_BLANKS),
            ),
        )

    return F.coalesce(let(tail, up_to_close), F.lit(""))


def mentions(text: Column, name: Column) -> Column:
    """Whether ``name`` stands in ``text`` as a word, in any case."""
    return F.rlike(text, F.concat(F.lit(r"(?i)\b\Q"), name, F.lit(r"\E\b")))


def table_columns(sql: Column, ctes: Column, sources: Column) -> Column:
    """array<struct<schema, table, column>>: ``alias.column`` uses resolved to their tables.

    Aliases come from the sources' own names and from FROM/JOIN; the last definition of
    a name counts. An alias that is unknown as written is tried in upper case.
    """
    keywords = _keywords()

    def either(left: int, right: int) -> Column:
        return F.zip_with(_all(sql, _ALIASED, left), _all(sql, _ALIASED, right), lambda a, b: F.when(a != "", a).otherwise(b))

    tables = F.zip_with(either(3, 4), _all(sql, _ALIASED, 5), lambda a, b: F.when(a != "", a).otherwise(b))
    targets = F.zip_with(either(1, 2), tables, lambda s, t: F.struct(s.alias("schema"), t.alias("table")))
    stated = F.zip_with(
        _all(sql, _ALIASED, 6), targets, lambda alias, target: F.struct(alias.alias("alias"), target.alias("target"))
    )
    stated = F.filter(stated, lambda x: (x["alias"] != "") & ~F.array_contains(keywords, F.upper(x["alias"])))
    explicit = flat_map(
        stated,
        lambda x: F.array(
            x, F.struct(F.upper(x["alias"]).alias("alias"), x["target"].alias("target"))
        ),
    )
    own = F.transform(
        sources,
        lambda s: F.struct(
            s["table"].alias("alias"), F.struct(s["schema"].alias("schema"), s["table"].alias("table")).alias("target")
        ),
    )

    def resolve(latest: Column) -> Column:
        names = F.transform(latest, lambda x: x["alias"])

        def of_use(use: Column) -> Column:
            alias, column = F.get(use, 0), F.get(use, 1)
            exact = F.array_position(names, alias)
            place = F.when(exact > 0, exact).otherwise(F.array_position(names, F.upper(alias))).cast("int")
            target = F.when(place > 0, F.get(latest, place - 1)["target"])
            usable = (
                ~F.array_contains(keywords, F.upper(alias))
                & ~F.array_contains(keywords, F.upper(column))
                & ~F.array_contains(ctes, alias)
                & ~F.array_contains(ctes, F.upper(alias))
            )
            return F.when(
                usable & target.isNotNull(),
                F.struct(target["schema"].alias("schema"), target["table"].alias("table"), column.alias("column")),
            )

        uses = F.transform(F.array_distinct(_all(sql, _DOTTED, 0)), lambda u: F.split(u, r"\."))
        return F.array_distinct(F.array_compact(F.transform(uses, of_use)))

    return let(F.reverse(F.concat(own, explicit)), resolve)


# ---------------------------------------------------------------- one row per view


_HEADER = ("view_id", "package", "view_type", "client", "description")


def _header_columns() -> list[Column]:
    doc = F.col("doc")
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    values = (
        F.coalesce(doc["_id"], stem),
        F.coalesce(doc["_package"], F.lit("")),
        F.coalesce(doc["_dataCategory"], F.lit("CUBE")),
        F.coalesce(doc["_defaultClient"], F.lit("")),
        F.coalesce(doc["descriptions"]["_defaultDescription"], F.lit("")),
    )
    return [value.alias(name) for name, value in zip(_HEADER, values)]


def view_headers(parsed: DataFrame) -> DataFrame:
    return parsed.where("is_valid").select("file", *_header_columns())


def _declared(doc: Column) -> Column:
    def source(d: Column) -> Column:
        schema, table = N.split_uri(d["resourceUri"])
        return F.struct(F.coalesce(d["_id"], F.lit("")).alias("id"), schema.alias("schema"), table.alias("table"))

    return no_nulls(F.transform(doc["dataSources"]["DataSource"], source), _SOURCES)


def _nodes(doc: Column, declared: Column) -> Column:
    declared_ids = F.transform(declared, lambda d: d["id"])

    def node(n: Column) -> Column:
        kind = N.node_type(n["_xsi:type"])
        is_script = kind == V.SCRIPT_NODE
        calculated = F.filter(
            n["calculatedViewAttributes"]["calculatedViewAttribute"],
            lambda c: F.coalesce(c["_id"], F.lit("")) != "",
        )
        inputs = F.transform(n["input"], lambda i: F.ltrim(F.coalesce(i["_node"], F.lit("")), F.lit("#")))
        typed = F.filter(n["viewAttributes"]["viewAttribute"], lambda a: F.coalesce(a["_id"], F.lit("")) != "")
        sql = F.when(is_script, F.btrim(F.coalesce(n["definition"], F.lit("")), F.lit(_BLANKS))).otherwise(F.lit(""))
        return let(
            sql,
            lambda text: let(
                cte_names(text),
                lambda ctes: F.struct(
                    F.coalesce(n["_id"], F.lit("")).alias("node_id"),
                    kind.alias("node_type"),
                    F.when(kind == "JOIN", N.join_type(n["_joinType"])).otherwise(F.lit("")).alias("join_type"),
                    F.btrim(F.coalesce(n["filter"], F.lit("")), F.lit(_BLANKS)).alias("filter"),
                    F.coalesce(
                        F.transform(
                            calculated,
                            lambda c: F.struct(
                                c["_id"].alias("id"),
                                F.coalesce(c["keyMapping"]["_columnName"], F.lit("")).alias("expression"),
                            ),
                        ),
                        F.array().cast("array<struct<id:string,expression:string>>"),
                    ).alias("calculated"),
                    no_nulls(F.filter(inputs, lambda i: F.array_contains(declared_ids, i)), _STRINGS).alias("inputs"),
                    text.alias("sql"),
                    ctes.alias("ctes"),
                    sql_tables(text, ctes).alias("sql_tables"),
                    F.coalesce(
                        F.when(
                            is_script,
                            F.transform(
                                typed,
                                lambda a: F.struct(
                                    a["_id"].alias("id"), F.coalesce(a["_datatype"], F.lit("")).alias("type")
                                ),
                            ),
                        ),
                        F.array().cast("array<struct<id:string,type:string>>"),
                    ).alias("types"),
                ),
            ),
        )

    return F.coalesce(
        F.transform(doc["calculationViews"]["calculationView"], node),
        F.array().cast(
            "array<struct<node_id:string,node_type:string,join_type:string,filter:string,"
            "calculated:array<struct<id:string,expression:string>>,inputs:array<string>,sql:string,ctes:array<string>,"
            "sql_tables:array<struct<schema:string,table:string>>,types:array<struct<id:string,type:string>>>>"
        ),
    )


def _merged_sources(declared: Column, nodes: Column) -> Column:
    """Declared sources, then tables found in SQL bodies; a (schema, table) already there is not added."""
    found = F.array_distinct(flat_map(nodes, lambda n: n["sql_tables"]))
    stated = F.transform(declared, lambda d: F.struct(d["schema"].alias("schema"), d["table"].alias("table")))
    added = F.transform(
        F.array_except(found, stated),
        lambda t: F.struct(t["table"].alias("id"), t["schema"].alias("schema"), t["table"].alias("table")),
    )
    return F.concat(declared, added)


def _fields(doc: Column, nodes: Column) -> Column:
    """Attributes, then measures, with the type that script nodes declare (the last declaration counts)."""
    types = F.reverse(flat_map(nodes, lambda n: n["types"]))

    def typed(latest: Column) -> Column:
        ids = F.transform(latest, lambda t: t["id"])

        def field(f: Column, key: str) -> Column:
            identifier = F.coalesce(f["_id"], F.lit(""))
            place = F.array_position(ids, identifier).cast("int")
            return F.struct(
                identifier.alias("field"),
                F.lit(key).alias("key_attribute"),
                F.when(place > 0, F.get(latest, place - 1)["type"]).otherwise(F.lit("")).alias("data_type"),
            )

        model = doc["logicalModel"]
        attributes = no_nulls(F.transform(model["attributes"]["attribute"], lambda f: field(f, "true")), _FIELDS)
        measures = [
            no_nulls(F.transform(model[group]["measure"], lambda f: field(f, "false")), _FIELDS)
            for group in ("baseMeasures", "calculatedMeasures", "restrictedMeasures")
        ]
        return F.concat(attributes, *measures)

    return let(types, typed)


def _blocks(node: Column, sources: Column) -> Column:
    """CTE blocks of a script node with the tables and earlier CTEs of their own body only."""
    physical = F.transform(sources, lambda s: F.struct(s["schema"].alias("schema"), s["table"].alias("table")))
    return F.transform(
        node["ctes"],
        lambda name, i: let(
            cte_body(node["sql"], name),
            lambda body: F.struct(
                name.alias("cte"),
                i.alias("pos"),
                body.alias("body"),
                F.array_intersect(table_pairs(body), physical).alias("tables"),
                F.filter(F.slice(node["ctes"], F.lit(1), i), lambda prior: mentions(body, prior)).alias("prior"),
            ),
        ),
    )


def derive(parsed: DataFrame) -> DataFrame:
    """One row per valid view with sources, nodes, fields, columns and CTE blocks as arrays."""
    doc = F.col("doc")
    valid = parsed.where("is_valid")
    step = valid.select("file", *_header_columns(), "doc", _declared(doc).alias("declared"))
    step = step.withColumn("nodes", _nodes(doc, F.col("declared")))
    step = step.withColumn("sources", _merged_sources(F.col("declared"), F.col("nodes")))
    columns = flat_map(F.col("nodes"), lambda n: table_columns(n["sql"], n["ctes"], F.col("sources")))
    return step.select(
        "file",
        *_HEADER,
        "declared",
        "nodes",
        "sources",
        _fields(doc, F.col("nodes")).alias("fields"),
        no_nulls(F.array_distinct(columns), _COLUMNS).alias("columns"),
        F.transform("nodes", lambda n: _blocks(n, F.col("sources"))).alias("blocks"),
    )


# ---------------------------------------------------------------- row-level views


def view_sources(views: DataFrame) -> DataFrame:
    return explode_rows(views, F.col("declared"), ("file", "view_id"))


def view_nodes(views: DataFrame) -> DataFrame:
    """(file, view_id, node_id, node_type, join_type, filter, logic)."""
    rows = F.transform(
        "nodes",
        lambda n: F.struct(
            n["node_id"].alias("node_id"),
            n["node_type"].alias("node_type"),
            n["join_type"].alias("join_type"),
            n["filter"].alias("filter"),
            logic_text(n).alias("logic"),
            F.size(n["types"]).cast("bigint").alias("typed_attributes"),
        ),
    )
    return explode_rows(views, rows, ("file", "view_id"))


def logic_text(node: Column) -> Column:
    return F.array_join(
        F.transform(node["calculated"], lambda c: F.concat(c["id"], F.lit(" = "), c["expression"])), "; "
    )


def node_inputs(views: DataFrame) -> DataFrame:
    """(file, view_id, node_id, source_id): inputs of graphical nodes that are data sources."""
    rows = flat_map(
        F.filter("nodes", lambda n: n["node_type"] != V.SCRIPT_NODE),
        lambda n: F.transform(
            n["inputs"], lambda i: F.struct(n["node_id"].alias("node_id"), i.alias("source_id"))
        ),
    )
    return explode_rows(views, rows, ("file", "view_id"))


def sql_table_refs(views: DataFrame) -> DataFrame:
    rows = flat_map(
        F.col("nodes"),
        lambda n: F.transform(
            n["sql_tables"],
            lambda t, i: F.struct(
                n["node_id"].alias("node_id"), i.cast("bigint").alias("pos"), t["schema"].alias("schema"), t["table"].alias("table")
            ),
        ),
    )
    return explode_rows(views, rows, ("file", "view_id"))


def _all_blocks() -> Column:
    return F.flatten("blocks")


def view_ctes(views: DataFrame) -> DataFrame:
    """(file, view_id, cte, pos, body)."""
    return explode_rows(views, _all_blocks(), ("file", "view_id")).select(
        "file", "view_id", "cte", F.col("pos").cast("bigint").alias("pos"), "body"
    )


def cte_dependencies(views: DataFrame) -> DataFrame:
    """(file, view_id, cte, kind, upstream): tables and earlier CTEs inside each CTE's own body."""
    rows = flat_map(
        _all_blocks(),
        lambda b: F.concat(
            F.transform(
                b["tables"],
                lambda t: F.struct(
                    b["cte"].alias("cte"),
                    F.lit("table").alias("kind"),
                    F.concat_ws(".", t["schema"], t["table"]).alias("upstream"),
                ),
            ),
            F.transform(
                b["prior"],
                lambda p: F.struct(b["cte"].alias("cte"), F.lit("cte").alias("kind"), p.alias("upstream")),
            ),
        ),
    )
    return explode_rows(views, rows, ("file", "view_id"))


def view_tables(views: DataFrame) -> DataFrame:
    rows = F.transform(
        "sources",
        lambda s, i: F.struct(
            i.cast("bigint").alias("pos"), s["id"].alias("id"), s["schema"].alias("schema"), s["table"].alias("table")
        ),
    )
    return explode_rows(views, rows, ("file", "view_id"))


def view_table_columns(views: DataFrame) -> DataFrame:
    return explode_rows(views, F.col("columns"), ("file", "view_id"))


def view_fields(views: DataFrame) -> DataFrame:
    return explode_rows(views, F.col("fields"), ("file", "view_id"))


def field_passthrough(views: DataFrame) -> DataFrame:
    """(file, view_id, field, ctes): CTE segments that mention each field, in order.

    A segment runs from one CTE header to the end of the next, as a report of where a
    field appears; it is not used for lineage.
    """

    def of_node(node: Column) -> Column:
        headers, names = _all(node["sql"], _CTE_HEADER, 0), _all(node["sql"], _CTE_HEADER, 1)
        pieces = F.split(node["sql"], _CTE_HEADER)
        return F.transform(
            names,
            lambda name, i: F.struct(
                name.alias("cte"),
                F.concat(F.get(pieces, i + 1), F.coalesce(F.get(headers, i + 1), F.lit(""))).alias("text"),
            ),
        )

    segments = flat_map(F.col("nodes"), of_node)
    report = let(
        segments,
        lambda parts: F.transform(
            F.array_distinct(F.transform("fields", lambda f: f["field"])),
            lambda field: F.struct(
                field.alias("field"),
                F.array_join(
                    F.array_distinct(
                        F.transform(F.filter(parts, lambda s: mentions(s["text"], field)), lambda s: s["cte"])
                    ),
                    ",",
                ).alias("ctes"),
            ),
        ),
    )
    return explode_rows(views.where(F.exists("nodes", lambda n: n["sql"] != "")), report, ("file", "view_id"))


def view_stats(views: DataFrame) -> DataFrame:
    return views.select(
        "file",
        "view_id",
        F.size("sources").cast("bigint").alias("sources"),
        F.size("nodes").cast("bigint").alias("nodes"),
        F.size(_all_blocks()).cast("bigint").alias("ctes"),
        F.size("fields").cast("bigint").alias("fields"),
    )


def dedupe_views(views: DataFrame) -> DataFrame:
    """Of views with one id, the first by file name.

    Only ids and file names are shuffled for the choice, and the minimum is taken
    map-side first; copies of one view may be a large part of the corpus.
    """
    first = views.groupBy("view_id").agg(F.min("file").alias("file"))
    return views.join(first.select("file", "view_id"), ["file", "view_id"], "left_semi")


# ---------------------------------------------------------------- the flow model

def _view_eid() -> Column:
    return F.concat(F.lit(f"{V.CALC_VIEW}/"), F.col("view_id"))


def _field_eid(field: Column) -> Column:
    return F.concat(F.lit(f"{V.CALC_VIEW_FIELD}/"), F.col("view_id"), F.lit("/"), field)


def _block_eid(block: Column) -> Column:
    return F.concat(F.lit(f"{V.SCRIPT_BLOCK}/"), F.col("view_id"), F.lit("/"), block)


def _connection(schema: Column) -> Column:
    return F.concat(F.lit("REF_HANA_"), schema, F.lit("_CONN"))


def _source(schema: Column) -> Column:
    return F.concat(F.lit("REF_HANA_"), schema, F.lit("_DS"))


def _table(schema: Column, table: Column) -> Column:
    return F.concat(_source(schema), F.lit("/"), table)


def _complete(sources: Column) -> Column:
    return F.filter(sources, lambda s: (s["schema"] != "") & (s["table"] != ""))


def view_reference_assets(views: DataFrame) -> DataFrame:
    """Connections, sources, tables and columns that the views read, each once, and the view container."""
    with_schema = F.filter("sources", lambda s: s["schema"] != "")
    rows = F.concat(
        flat_map(
            with_schema,
            lambda s: F.array(
                asset(V.RESOURCE, _connection(s["schema"]), F.concat(s["schema"], F.lit("_Connection")), "True", "True"),
                asset(V.DATA_SOURCE, _source(s["schema"]), s["schema"], "True", "True"),
            ),
        ),
        F.transform(
            _complete(F.col("sources")),
            lambda s: asset(V.DATA_SET, _table(s["schema"], s["table"]), s["table"], "True", "True"),
        ),
        F.transform(
            "columns",
            lambda c: asset(
                V.DATA_ELEMENT,
                F.concat(_table(c["schema"], c["table"]), F.lit("/"), c["column"]),
                c["column"],
                "True",
                "True",
            ),
        ),
        F.array(asset(V.DATA_SOURCE, F.lit(V.VIEW_CONTAINER_ID), F.lit(V.VIEW_CONTAINER_NAME), "False", "True")),
    ).cast(ASSET_TYPE)
    return explode_rows(views, rows).distinct()


def view_assets(views: DataFrame) -> DataFrame:
    """Views, fields and blocks: one block per CTE of a script node, or the node itself."""
    pkg = V.VIEW_PACKAGE
    own = F.array(
        asset(
            V.CALC_VIEW,
            _view_eid(),
            F.col("view_id"),
            "",
            "True",
            **{
                "core.description": F.col("description"),
                f"{pkg}.packagePath": F.col("package"),
                f"{pkg}.calcViewType": F.col("view_type"),
                f"{pkg}.defaultClient": F.col("client"),
            },
        )
    )
    fields = F.transform(
        "fields",
        lambda f: asset(
            V.CALC_VIEW_FIELD,
            _field_eid(f["field"]),
            f["field"],
            "",
            "True",
            **{f"{pkg}.keyAttribute": f["key_attribute"], f"{pkg}.columnDataType": f["data_type"]},
        ),
    )

    def block(name: Column, kind: Column, body: Column) -> Column:
        return asset(
            V.SCRIPT_BLOCK,
            _block_eid(name),
            name,
            "",
            "True",
            **{"core.parent": _view_eid(), f"{pkg}.scriptType": kind, f"{pkg}.transformationLogic": body},
        )

    blocks = F.flatten(
        F.zip_with(
            "nodes",
            "blocks",
            lambda n, own_blocks: F.when(
                F.size(own_blocks) > 0,
                F.transform(own_blocks, lambda b: block(b["cte"], n["node_type"], b["body"])),
            ).otherwise(F.array(block(n["node_id"], n["node_type"], F.lit("")))),
        )
    )
    return explode_rows(views, F.concat(own.cast(ASSET_TYPE), fields.cast(ASSET_TYPE), blocks.cast(ASSET_TYPE)))


def _dataset_links() -> Column:
    sources = _complete(F.col("sources"))

    def feed(source: Column, target: Column) -> Column:
        return link(source, target, V.DATASET_FLOW)

    def of_ctes(node: Column, own_blocks: Column) -> Column:
        def of_block(b: Column) -> Column:
            target = _block_eid(b["cte"])
            from_tables = F.transform(b["tables"], lambda t: feed(_table(t["schema"], t["table"]), target))
            from_ctes = F.transform(b["prior"], lambda p: feed(_block_eid(p), target))
            unresolved = (b["pos"] == 0) & (F.size(b["tables"]) == 0) & (F.size(b["prior"]) == 0)
            from_all = F.transform(sources, lambda s: feed(_table(s["schema"], s["table"]), target))
            return F.when(unresolved, from_all).otherwise(F.concat(from_tables, from_ctes))

        last = _block_eid(F.element_at(node["ctes"], -1))
        return F.concat(flat_map(own_blocks, of_block), F.array(feed(last, _view_eid())))

    def of_plain(node: Column) -> Column:
        target = _block_eid(node["node_id"])
        from_all = F.transform(sources, lambda s: feed(_table(s["schema"], s["table"]), target))
        inputs = F.transform(
            node["inputs"], lambda i: F.get(F.filter("sources", lambda s: s["id"] == i), 0)
        )
        from_inputs = F.transform(inputs, lambda s: feed(_table(s["schema"], s["table"]), target))
        reads = F.when(node["node_type"] == V.SCRIPT_NODE, from_all).otherwise(from_inputs)
        return F.concat(reads, F.array(feed(target, _view_eid())))

    return F.flatten(
        F.zip_with(
            "nodes",
            "blocks",
            lambda n, own_blocks: F.when(F.size(own_blocks) > 0, of_ctes(n, own_blocks)).otherwise(of_plain(n)),
        )
    )


def view_dataset_flow(views: DataFrame) -> DataFrame:
    """table -> CTE -> CTE -> view, each CTE fed only by what its own body names."""
    return explode_rows(views, _dataset_links().cast(LINK_TYPE)).distinct()


def _column_links() -> Column:
    """A column feeds every output field of the same name in any case."""
    named = F.transform("columns", lambda c: F.upper(c["column"]))

    def of_field(f: Column, names: Column) -> Column:
        return F.transform(
            F.filter(
                F.col("columns"), lambda c, i: F.get(names, i) == F.upper(f["field"])
            ),
            lambda c: link(
                F.concat(_table(c["schema"], c["table"]), F.lit("/"), c["column"]), _field_eid(f["field"]), V.COLUMN_FLOW
            ),
        )

    return let(named, lambda names: flat_map(F.col("fields"), lambda f: of_field(f, names)))


def view_column_flow(views: DataFrame) -> DataFrame:
    return explode_rows(views, _column_links()).distinct()


def _hierarchy() -> Column:
    root = F.lit(V.ROOT_UPPER)
    physical = flat_map(
        _complete(F.col("sources")),
        lambda s: F.concat(
            F.array(
                link(root, _connection(s["schema"]), V.RESOURCE_PARENT_CHILD),
                link(_connection(s["schema"]), _source(s["schema"]), V.RESOURCE_PARENT_CHILD),
                link(_source(s["schema"]), _table(s["schema"], s["table"]), V.DATASOURCE_PARENT_CHILD),
            ),
            F.transform(
                F.filter("columns", lambda c: (c["schema"] == s["schema"]) & (c["table"] == s["table"])),
                lambda c: link(
                    _table(s["schema"], s["table"]),
                    F.concat(_table(s["schema"], s["table"]), F.lit("/"), c["column"]),
                    V.DATASET_ELEMENT,
                ),
            ),
        ),
    )
    own = F.array(
        link(root, F.lit(V.VIEW_CONTAINER_ID), V.RESOURCE_PARENT_CHILD),
        link(F.lit(V.VIEW_CONTAINER_ID), _view_eid(), V.DATASOURCE_PARENT_CHILD),
    )
    fields = F.transform("fields", lambda f: link(_view_eid(), _field_eid(f["field"]), V.VIEW_TO_FIELD))
    names = F.flatten(
        F.transform("nodes", lambda n: F.when(F.size(n["ctes"]) > 0, n["ctes"]).otherwise(F.array(n["node_id"])))
    )
    blocks = F.transform(names, lambda b: link(_view_eid(), _block_eid(b), V.VIEW_TO_BLOCK))
    return F.concat(physical, own, fields, blocks)


def view_hierarchy_links(views: DataFrame) -> DataFrame:
    return explode_rows(views, _hierarchy().cast(LINK_TYPE)).distinct()


def view_links(views: DataFrame) -> DataFrame:
    """All links of the flow model in one pass and one shuffle."""
    rows = F.concat(_hierarchy().cast(LINK_TYPE), _dataset_links().cast(LINK_TYPE), _column_links().cast(LINK_TYPE))
    return explode_rows(views, rows).distinct()


# ---------------------------------------------------------------- the package-grouped model


def _class_id(cls: str, *parts: Column) -> Column:
    """``class/part/part`` without the empty parts."""
    return F.concat(F.lit(f"{cls}/"), F.array_join(F.filter(F.array(*parts), lambda p: p != ""), "/"))


def _first_schema() -> Column:
    return F.coalesce(F.get("declared", 0)["schema"], F.lit(""))


def block_complexity(views: DataFrame) -> DataFrame:
    """(view_id, node_id, node_type, logic, join_type, filter, complexity, source_tables, source_schema)."""
    rows = F.transform(
        "nodes",
        lambda n: F.struct(
            n["node_id"].alias("node_id"),
            n["node_type"].alias("node_type"),
            logic_text(n).alias("logic"),
            n["join_type"].alias("join_type"),
            n["filter"].alias("filter"),
            (
                F.size(n["calculated"])
                + (n["join_type"] != "").cast("int")
                + (n["filter"] != "").cast("int")
            )
            .cast("string")
            .alias("complexity"),
            F.size(n["inputs"]).cast("string").alias("source_tables"),
            _first_schema().alias("source_schema"),
        ),
    )
    return explode_rows(views, rows, ("view_id",))


def package_assets(views: DataFrame) -> DataFrame:
    """Packages, tables, views, fields and blocks of the package-grouped model."""
    pkg = V.PACKAGE_MODEL
    view_id = F.col("view_id")
    packages = F.transform(
        F.filter("declared", lambda d: d["schema"] != ""),
        lambda d: asset(
            V.PACKAGE,
            _class_id(V.PACKAGE, d["schema"]),
            d["schema"],
            "true",
            "true",
            **{"core.description": F.concat(F.lit("SAP HANA schema / package: "), d["schema"])},
        ),
    )
    tables = F.transform(
        "declared",
        lambda d: asset(
            V.PACKAGE_TABLE,
            _class_id(V.PACKAGE_TABLE, d["schema"], d["table"]),
            d["table"],
            "true",
            "true",
            **{
                "core.description": F.concat(F.lit("SAP HANA table "), d["schema"], F.lit("."), d["table"]),
                f"{pkg}.tableSchema": d["schema"],
            },
        ),
    )
    own = F.array(
        asset(
            V.PACKAGE_VIEW,
            _class_id(V.PACKAGE_VIEW, view_id),
            view_id,
            "true",
            "true",
            **{
                "core.description": F.col("description"),
                f"{pkg}.packagePath": F.col("package"),
                f"{pkg}.sourceSchema": _first_schema(),
                f"{pkg}.calcViewType": F.col("view_type"),
                f"{pkg}.defaultClient": F.col("client"),
            },
        )
    )
    fields = F.transform(
        "fields",
        lambda f: asset(
            V.PACKAGE_FIELD,
            _class_id(V.PACKAGE_FIELD, view_id, f["field"]),
            f["field"],
            "true",
            "",
            **{
                "core.description": F.concat(F.lit("Field "), f["field"], F.lit(" for view "), view_id),
                f"{pkg}.keyAttribute": f["key_attribute"],
            },
        ),
    )
    grouped = explode_rows(
        views, F.concat(packages.cast(ASSET_TYPE), tables.cast(ASSET_TYPE), own.cast(ASSET_TYPE), fields.cast(ASSET_TYPE))
    ).distinct()
    blocks = block_complexity(views).select(
        asset(
            V.PACKAGE_BLOCK,
            _class_id(V.PACKAGE_BLOCK, view_id, F.col("node_id")),
            F.col("node_id"),
            "true",
            "true",
            **{
                "core.description": F.concat("node_type", F.lit(" node in "), view_id),
                f"{pkg}.scriptType": F.col("node_type"),
                f"{pkg}.transformationLogic": F.col("logic"),
                f"{pkg}.joinType": F.col("join_type"),
                f"{pkg}.filterCondition": F.col("filter"),
                f"{pkg}.complexityScore": F.col("complexity"),
                f"{pkg}.sourceTableCount": F.col("source_tables"),
                f"{pkg}.sourceSchema": F.col("source_schema"),
            },
        ).alias("a")
    )
    return union_all([grouped, blocks.select("a.*")])


def package_links(views: DataFrame, root_resource: str) -> DataFrame:
    """Package grouping, structure and flow of the package-grouped model."""
    root, view_id = F.lit(root_resource), F.col("view_id")
    view_eid = _class_id(V.PACKAGE_VIEW, view_id)
    package_eid = _class_id(V.PACKAGE, _first_schema())
    own = F.array(link(root, view_eid, V.RESOURCE_PARENT_CHILD))
    grouping = F.when(
        _first_schema() != "",
        F.array(
            link(root, package_eid, V.RESOURCE_PARENT_CHILD),
            link(package_eid, view_eid, V.PACKAGE_TO_VIEW),
        ),
    ).otherwise(F.array().cast(LINK_TYPE))
    tables = flat_map(
        F.filter("declared", lambda d: d["schema"] != ""),
        lambda d: F.array(
            link(root, _class_id(V.PACKAGE_TABLE, d["schema"], d["table"]), V.RESOURCE_PARENT_CHILD),
            link(
                _class_id(V.PACKAGE, d["schema"]),
                _class_id(V.PACKAGE_TABLE, d["schema"], d["table"]),
                V.PACKAGE_TO_TABLE,
            ),
        ),
    )
    fields = F.transform(
        "fields",
        lambda f: link(view_eid, _class_id(V.PACKAGE_FIELD, view_id, f["field"]), V.PACKAGE_VIEW_TO_FIELD),
    )

    def of_node(n: Column) -> Column:
        block = _class_id(V.PACKAGE_BLOCK, view_id, n["node_id"])
        # A source id that is declared twice stands for its last declaration.
        latest = F.reverse(F.col("declared"))
        reads = F.transform(
            n["inputs"],
            lambda i: let(
                F.get(F.filter(latest, lambda d: d["id"] == i), 0),
                lambda d: link(
                    _class_id(V.PACKAGE_TABLE, d["schema"], d["table"]), block, V.PACKAGE_TABLE_TO_BLOCK
                ),
            ),
        )
        return F.concat(
            F.array(link(view_eid, block, V.PACKAGE_VIEW_TO_BLOCK), link(block, view_eid, V.PACKAGE_BLOCK_TO_VIEW)),
            reads,
        )

    rows = F.concat(own.cast(LINK_TYPE), grouping, tables, fields, flat_map(F.col("nodes"), of_node))
    return explode_rows(views, rows.cast(LINK_TYPE)).distinct()
