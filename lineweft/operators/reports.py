"""Report layouts: sections, visuals, fields and the tables and columns behind them.

A slot that may hold JSON inside a string is read as text, which gives the same JSON
whether it was encoded or not, and is parsed again where its content is needed. Maps
from text to text keep the order of the document, which the kind of an expression
(its first key) depends on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweft.config import LineageConfig
from lineweft.functions import names as N
from lineweft.functions import vocabulary as V
from lineweft.functions.rows import ASSET_TYPE, asset, explode_rows, flat_map, let, link, no_nulls, parse_once, union_all

_LAYOUT = (
    "sections array<struct<name:string,displayName:string,"
    "visualContainers:array<struct<config:string,dataTransforms:string>>>>,_corrupt string"
)
_TEXT_MAP = "map<string,string>"
_LINK_ROWS = (
    "array<struct<l:struct<source:string,target:string,association:string>,"
    "place:struct<section_pos:int,ordinal:int,pos:int>>>"
)
_FIELD = (
    "array<struct<kind:string,field_name:string,description:string,id_text:string,table:string,column:string,pos:int>>"
)


def parse_layouts(layouts: DataFrame) -> DataFrame:
    """(report_name, layout, is_valid) of the layouts that could be extracted, and their ``error`` if they have that column."""
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    error = [c for c in ("error",) if c in layouts.columns]
    parsed = parse_once(layouts.select("report_name", "layout_json", *error), F.from_json("layout_json", _LAYOUT, options), "l")
    valid = F.col("layout_json").isNotNull() & (F.col("l._corrupt").isNull() | F.col("l.sections").isNotNull())
    return parsed.select("report_name", F.when(valid, F.col("l")).alias("layout"), valid.alias("is_valid"), *error)


def _reference(expression: Column, key: str) -> Column:
    """struct<ref, property> of the first source reference in or below ``expression``, else null.

    Objects wait in a list, those of the one just read before the others; every one has a brace of its
    own in the text, so there are steps enough for any depth.
    """
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.regexp_count(expression, F.lit(r"\{|\\u007[bB]"))))

    def step(state: Column, _: Column) -> Column:
        def of_object(parts: Column) -> Column:
            inner = parts["Expression"]
            ref = F.get_json_object(inner, f"$.SourceRef.{key}")
            direct = F.struct(ref.alias("ref"), F.coalesce(parts["Property"], F.lit("")).alias("property"))
            values = F.filter(F.map_values(F.from_json(inner, _TEXT_MAP)), lambda value: value.contains("{"))
            below = F.coalesce(values, F.array().cast("array<string>"))
            rest = F.slice(state["left"], F.lit(2), F.size(state["left"]))
            return _search(F.concat(below, rest), F.when(F.coalesce(ref, F.lit("")) != "", direct))

        over = state["hit"].isNotNull() | (F.size(state["left"]) == 0)
        return F.when(over, state).otherwise(
            let(F.from_json(F.get(state["left"], 0), "Expression string, Property string"), of_object)
        )

    return F.aggregate(steps, _search(F.array(expression), F.lit(None)), step, lambda state: state["hit"])


def _search(left: Column, hit: Column) -> Column:
    return F.struct(left.alias("left"), hit.alias("hit")).cast("struct<left:array<string>,hit:struct<ref:string,property:string>>")


def _entry(m: Column, place: int) -> Column:
    return F.get(F.map_values(m), place)


def _field(kind: Column, name: Column, description: Column, id_text: Column, table: Column, prop: Column, pos: Column) -> Column:
    column = F.when(prop != "", prop).otherwise(table)
    return F.struct(
        kind.alias("kind"),
        name.alias("field_name"),
        description.alias("description"),
        id_text.alias("id_text"),
        table.alias("table"),
        column.alias("column"),
        pos.alias("pos"),
    )


def transform_fields(data_transforms: Column) -> Column:
    """Fields of ``dataTransforms.selects``: items without expression or without any name are left out."""

    def of_item(item: Column, pos: Column) -> Column:
        return let(
            F.from_json(item, "displayName string, queryName string, expr string"),
            lambda i: let(
                F.from_json(i["expr"], _TEXT_MAP),
                lambda expr: let(
                    _reference(_entry(expr, 0), "Entity"),
                    lambda ref: _named(i, expr, ref, pos),
                ),
            ),
        )

    def _named(i: Column, expr: Column, ref: Column, pos: Column) -> Column:
        query_name = F.coalesce(i["queryName"], F.lit(""))
        display = F.trim(F.coalesce(i["displayName"], F.lit("")))
        name = F.when(display != "", display).otherwise(F.trim(query_name))
        usable = i["expr"].isNotNull() & (name != "")
        return F.when(
            usable,
            _field(
                F.get(F.map_keys(expr), 0),
                name,
                query_name,
                F.when(query_name != "", query_name).otherwise(name),
                F.coalesce(ref["ref"], F.lit("")),
                F.coalesce(ref["property"], F.lit("")),
                pos,
            ),
        )

    selects = F.from_json(data_transforms, "selects array<string>")["selects"]
    return no_nulls(F.array_compact(F.transform(selects, of_item)), _FIELD)


def query_fields(prototype_query: Column) -> Column:
    """Fields of ``prototypeQuery.Select``, their source alias resolved through ``From``."""
    query = F.from_json(prototype_query, "`From` array<struct<Name:string,Entity:string>>, `Select` array<string>")

    def resolve(q: Column) -> Column:
        # The last table of a name counts.
        tables = F.reverse(q["From"])
        aliases = F.transform(tables, lambda t: t["Name"])

        def of_item(item: Column, pos: Column) -> Column:
            return let(
                F.from_json(item, _TEXT_MAP),
                lambda m: let(_reference(_entry(m, 0), "Source"), lambda ref: _named(m, ref, pos)),
            )

        def _named(m: Column, ref: Column, pos: Column) -> Column:
            name = F.coalesce(F.try_element_at(m, F.lit("Name")), F.lit(""))
            place = F.array_position(aliases, ref["ref"]).cast("int")
            table = F.when(place > 0, F.get(tables, place - 1)["Entity"])
            return F.when(
                ref.isNotNull() & (name != ""),
                _field(F.get(F.map_keys(m), 0), name, name, name, F.coalesce(table, F.lit("")), ref["property"], pos),
            )

        return no_nulls(F.array_compact(F.transform(q["Select"], of_item)), _FIELD)

    return no_nulls(let(query, resolve), _FIELD)


def derive(parsed: DataFrame, config: LineageConfig = LineageConfig()) -> DataFrame:
    """One row per section: (report_name, report_uid, section_pos, section_id, section_name, visuals).

    A report without sections keeps one row with a null section. Only containers with a prototype query are visuals; their ordinal counts those alone.
    """
    uid = N.report_uid(F.col("report_name"))

    def opened(container: Column) -> Column:
        single = F.from_json(container["config"], "singleVisual string")["singleVisual"]
        return let(
            F.from_json(single, "visualType string, prototypeQuery string"),
            lambda v: F.struct(
                v["visualType"].alias("visual_type"),
                v["prototypeQuery"].alias("query"),
                container["dataTransforms"].alias("transforms"),
            ),
        )

    def visual(section_id: Column, v: Column, i: Column) -> Column:
        name = F.concat(F.lit("Visual"), (i + 1).cast("string"), F.lit("_"), F.coalesce(v["visual_type"], F.lit("")))
        return F.struct(
            (i + 1).alias("ordinal"),
            name.alias("visual_name"),
            F.concat(section_id, F.lit("/"), name).alias("visual_id"),
            v["visual_type"].alias("visual_type"),
            v["query"].alias("query"),
            F.when(v["transforms"].isNotNull(), transform_fields(v["transforms"]))
            .otherwise(query_fields(v["query"]))
            .alias("fields"),
        )

    sections = parsed.where("is_valid").select(
        "report_name", uid.alias("report_uid"), F.posexplode_outer("layout.sections").alias("section_pos", "s")
    )
    section_id = F.concat("report_uid", F.lit("/"), F.col("s.name"))
    eligible = F.filter(F.transform("s.visualContainers", opened), lambda v: v["query"].isNotNull())
    return sections.select(
        "report_name",
        "report_uid",
        "section_pos",
        section_id.alias("section_id"),
        F.coalesce("s.displayName", F.lit("")).alias("section_name"),
        F.transform(eligible, lambda v, i: visual(section_id, v, i)).alias("visuals"),
    )


# ---------------------------------------------------------------- row-level views


def report_sections(derived: DataFrame) -> DataFrame:
    return derived.where(F.col("section_pos").isNotNull()).select(
        "report_uid", F.col("section_pos").cast("bigint").alias("section_pos"), "section_id", "section_name"
    )


def report_visuals(derived: DataFrame) -> DataFrame:
    rows = explode_rows(derived, F.col("visuals"), ("section_id",))
    return rows.select(
        "section_id", F.col("ordinal").cast("bigint").alias("ordinal"), "visual_id", "visual_name", "visual_type"
    )


def _placed_fields() -> Column:
    """Every field with its ids and its place in the report."""
    return flat_map(
        F.col("visuals"),
        lambda v: F.transform(
            v["fields"],
            lambda f: F.struct(
                v["visual_id"].alias("visual_id"),
                F.struct(F.col("section_pos"), v["ordinal"].alias("ordinal"), f["pos"].alias("pos")).alias("place"),
                F.concat(v["visual_id"], F.lit("/"), N.report_sid(f["id_text"])).alias("field_id"),
                f["field_name"].alias("field_name"),
                f["description"].alias("description"),
                N.classify_field_type(f["kind"]).alias("field_type"),
                f["kind"].alias("kind"),
                f["table"].alias("table"),
                f["column"].alias("column"),
                ((f["table"] != "") & (f["column"] != "")).alias("has_source"),
            ),
        ),
    )


def visual_fields(derived: DataFrame) -> DataFrame:
    """(report_name, report_uid, visual_id, place, field_id, field_name, description, field_type, kind, table, column, ...)."""
    return explode_rows(derived, _placed_fields(), ("report_name", "report_uid"))


def _dataset_id(table: Column) -> Column:
    return F.concat("report_uid", F.lit("/ds_"), N.report_sid(table))


def _core_id(prefix: str, table: Column) -> Column:
    return F.concat("report_uid", F.lit(f"/{prefix}"), N.report_sid(table))


def _first(df: DataFrame, key: str, *values: str) -> DataFrame:
    """The first row by report and place for each ``key``; picked by an aggregate, so map-side first."""
    ordered = F.struct("report_name", "place", F.struct(*values).alias("v"))
    return df.groupBy(key).agg(F.min(ordered).alias("m")).select(key, *[F.col(f"m.v.{v}").alias(v) for v in values])


def report_datasets(fields: DataFrame) -> DataFrame:
    """(class, external_id, name, field_type): tables and columns of a report, the first spelling and type."""
    sourced = fields.where("has_source")
    table, column = F.col("table"), F.col("column")
    datasets = _first(
        sourced.select(
            "report_name", "place", _dataset_id(table).alias("external_id"), F.concat(F.lit("ds_"), table).alias("name")
        ),
        "external_id",
        "name",
    )
    columns = _first(
        sourced.select(
            "report_name",
            "place",
            F.concat(_dataset_id(table), F.lit("/"), N.report_sid(column)).alias("external_id"),
            column.alias("name"),
            "field_type",
        ),
        "external_id",
        "name",
        "field_type",
    )
    return union_all(
        [
            datasets.select(F.lit(V.REPORT_DATASET).alias("class"), "external_id", "name", F.lit("").alias("field_type")),
            columns.select(F.lit(V.REPORT_FIELD).alias("class"), "external_id", "name", "field_type"),
        ]
    )


def report_assets(derived: DataFrame) -> DataFrame:
    """(class, external_id, name, description, field_type, visual_type): reports, sections, visuals and their fields.

    Repeated fields of a visual stay repeated.
    """
    columns = ["class", "external_id", "name", "description", "field_type", "visual_type"]
    empty = F.lit("")

    def rows(df: DataFrame, cls: str, eid: str, name: str, description: str, field_type: Column, visual_type: Column) -> DataFrame:
        values = (F.lit(cls), F.col(eid), F.col(name), F.col(description), field_type, visual_type)
        return df.select(*[value.alias(column) for value, column in zip(values, columns)])

    reports = derived.select("report_uid", "report_name").distinct()
    visuals = explode_rows(derived, F.col("visuals"))
    return union_all(
        [
            rows(reports, V.REPORT, "report_uid", "report_name", "report_name", empty, empty),
            rows(derived.where(F.col("section_pos").isNotNull()), V.SECTION, "section_id", "section_name", "section_name", empty, empty),
            rows(visuals, V.VISUAL, "visual_id", "visual_name", "visual_name", empty, F.col("visual_type")),
            rows(
                visual_fields(derived), V.REPORT_FIELD, "field_id", "field_name", "description", F.col("field_type"), empty
            ),
        ]
    )


def report_reference_assets(fields: DataFrame, config: LineageConfig = LineageConfig()) -> DataFrame:
    """Resource, source, set and element of every table and column that a report reads."""
    sourced = fields.where("has_source")
    table, column = F.col("table"), F.col("column")
    shown = F.concat(F.lit("Reference_"), table)
    if config.owned_table is not None and config.owned_resource_name is not None:
        shown = F.when(table == config.owned_table, F.lit(config.owned_resource_name)).otherwise(shown)

    def core(cls: str, external_id: Column, name: Column) -> Column:
        return F.struct(F.lit(cls).alias("class"), external_id.alias("external_id"), name.alias("name"))

    rows = explode_rows(
        sourced,
        F.array(
            core(V.RESOURCE, _core_id("Reference_", table), shown),
            core(V.DATA_SOURCE, _core_id("Connection_", table), F.concat(F.lit("Connection_"), table)),
            core(V.DATA_SET, _core_id("", table), table),
            core(V.DATA_ELEMENT, F.concat(_core_id("", table), F.lit("/"), N.report_sid(column)), column),
        ),
        ("report_name", "place"),
    )
    first = rows.groupBy("class", "external_id").agg(F.min(F.struct("report_name", "place", "name")).alias("m"))
    return first.select(
        "class",
        "external_id",
        F.col("m.name").alias("name"),
        F.lit("TRUE").alias("reference"),
        F.lit("TRUE").alias("assignable"),
    )


def catalog_assets(derived: DataFrame, config: LineageConfig = LineageConfig()) -> DataFrame:
    """All rows of a report export in the shared asset form, texts repeated where the export repeats them."""
    pkg = V.REPORT_PACKAGE
    section = derived.where(F.col("section_pos").isNotNull())
    fields = visual_fields(derived)

    def described(cls: str | Column, eid: str, name: str, description: str, **attrs: Column) -> Column:
        texts = {
            "core.description": F.col(description),
            "core.businessDescription": F.col(name),
            "core.businessName": F.col(name),
        }
        return asset(cls, F.col(eid), F.col(name), "", "", **texts, **attrs).alias("a")

    typed = {f"{pkg}.FieldType": F.col("field_type")}
    datasets = report_datasets(fields)
    frames = [
        derived.select("report_uid", "report_name").distinct().select(
            described(V.REPORT, "report_uid", "report_name", "report_name")
        ),
        section.select(described(V.SECTION, "section_id", "section_name", "section_name")),
        explode_rows(derived, F.col("visuals")).select(
            described(
                V.VISUAL,
                "visual_id",
                "visual_name",
                "visual_name",
                **{f"{pkg}.VisualQuery": F.col("query"), f"{pkg}.VisualType": F.col("visual_type")},
            )
        ),
        fields.select(described(V.REPORT_FIELD, "field_id", "field_name", "description", **typed)),
        datasets.select(described(F.col("class"), "external_id", "name", "name", **typed)),
    ]
    as_rows = [frame.select(F.array("a").cast(ASSET_TYPE).alias("rows")) for frame in frames]
    own = union_all([explode_rows(frame, F.col("rows")) for frame in as_rows])
    core = report_reference_assets(fields, config)
    no_attrs = F.array().cast("array<struct<key:string,value:string>>")
    return own.unionByName(core.withColumn("attrs", no_attrs))


def report_links(derived: DataFrame, distinct: bool = False) -> DataFrame:
    """All links of the reports in one pass.

    Field links of visuals are repeated when a visual repeats a field, unless
    ``distinct``; each repetition keeps its place until the other links are made distinct.
    """
    root = F.lit(V.ROOT_LOWER)
    uid, section = F.col("report_uid"), F.col("section_id")
    once = F.lit(None).cast("struct<section_pos:int,ordinal:int,pos:int>")

    def row(l: Column, place: Column = once) -> Column:
        return F.struct(l.alias("l"), place.alias("place"))

    visuals = F.coalesce(
        F.transform("visuals", lambda v: row(link(section, v["visual_id"], V.SECTION_TO_VISUAL))),
        F.array().cast(_LINK_ROWS),
    )
    containment = F.concat(
        F.array(row(link(root, uid, V.RESOURCE_PARENT_CHILD))),
        F.when(
            F.col("section_pos").isNotNull(), F.array(row(link(uid, section, V.REPORT_TO_SECTION)))
        ).otherwise(F.array().cast(_LINK_ROWS)),
        visuals,
    )

    def of_field(f: Column) -> Column:
        repeated = once if distinct else f["place"]
        table, column = f["table"], f["column"]
        dataset = _dataset_id(table)
        dataset_field = F.concat(dataset, F.lit("/"), N.report_sid(column))
        core_resource, core_source = _core_id("Reference_", table), _core_id("Connection_", table)
        core_set = _core_id("", table)
        core_element = F.concat(core_set, F.lit("/"), N.report_sid(column))
        own = F.array(row(link(f["visual_id"], f["field_id"], V.VISUAL_TO_FIELD), repeated))
        sourced = F.array(
            row(link(uid, dataset, V.REPORT_TO_DATASET)),
            row(link(dataset, f["visual_id"], V.DATASET_FLOW)),
            row(link(dataset, dataset_field, V.DATASET_TO_FIELD)),
            row(link(dataset_field, f["field_id"], V.COLUMN_FLOW), repeated),
            row(link(root, core_resource, V.RESOURCE_PARENT_CHILD)),
            row(link(core_resource, core_source, V.RESOURCE_PARENT_CHILD)),
            row(link(core_source, core_set, V.DATASOURCE_PARENT_CHILD)),
            row(link(core_set, dataset, V.DATASET_FLOW)),
            row(link(core_set, core_element, V.DATASET_ELEMENT)),
            row(link(core_element, dataset_field, V.COLUMN_FLOW)),
        )
        return F.when(f["has_source"], F.concat(own, sourced)).otherwise(own)

    rows = F.concat(containment, no_nulls(flat_map(_placed_fields(), of_field), _LINK_ROWS))
    exploded = explode_rows(derived, rows, ("report_name",))
    keyed = exploded.select(
        "l.source", "l.target", "l.association", "place", F.when(F.col("place").isNotNull(), F.col("report_name")).alias("r")
    )
    return keyed.distinct().select("source", "target", "association")


# ---------------------------------------------------------------- coverage


def captured_fields(fields: DataFrame) -> DataFrame:
    """(table, field, field_type): distinct captured columns of all reports, the first type by place."""
    return _first(
        fields.where("has_source").select(
            "report_name", "place", F.struct("table", F.col("column").alias("field")).alias("key"), "field_type"
        ),
        "key",
        "field_type",
    ).select("key.table", "key.field", "field_type")


def field_breakdown(captured: DataFrame) -> DataFrame:
    """Per table: captured fields by type and in total."""
    kind = F.col("field_type")
    return captured.groupBy("table").agg(
        F.count_if(kind == "Source Column").alias("source_columns"),
        F.count_if(kind == "Measure").alias("measures"),
        F.count_if(kind == V.OTHER_FIELD_TYPE).alias("calculated_columns"),
        F.count("*").alias("total"),
    )


def coverage_audit(expected: DataFrame, captured: DataFrame) -> DataFrame:
    """(table, field, expected_type, captured_type, status) of every expected field."""
    wanted = expected.select("table", "field", F.col("field_type").alias("expected_type")).distinct()
    found = captured.select("table", "field", F.col("field_type").alias("captured_type"))
    status = (
        F.when(F.col("captured_type").isNull(), "MISSING")
        .when(F.col("captured_type") == F.col("expected_type"), "CORRECT")
        .otherwise("PARTIAL")
    )
    return wanted.join(found, ["table", "field"], "left").select(
        "table", "field", "expected_type", "captured_type", status.alias("status")
    )


def coverage_summary(audit: DataFrame) -> DataFrame:
    """Per table: expected fields by status and whether any of them was captured."""
    status = F.col("status")
    return audit.groupBy("table").agg(
        F.count("*").alias("expected"),
        F.count_if(status == "CORRECT").alias("correct"),
        F.count_if(status == "PARTIAL").alias("partial"),
        F.count_if(status == "MISSING").alias("missing"),
        F.bool_or(status != "MISSING").alias("table_captured"),
    )


_PLACE = ["page", "visual_type", "table", "field"]


def captured_places(derived: DataFrame) -> DataFrame:
    """(page, visual_type, table, field, field_type): where on the reports' pages each column is shown, each once."""
    shown = F.transform(
        "visuals",
        lambda v: F.transform(
            F.filter(v["fields"], lambda f: (f["table"] != "") & (f["column"] != "")),
            lambda f: F.struct(
                F.col("section_name").alias("page"),
                v["visual_type"].alias("visual_type"),
                f["table"].alias("table"),
                f["column"].alias("field"),
                N.classify_field_type(f["kind"]).alias("field_type"),
            ),
        ),
    )
    return explode_rows(derived, F.flatten(shown)).distinct()


def coverage_places(expected: DataFrame, captured: DataFrame) -> DataFrame:
    """(page, visual_type, table, field, expected_type, captured_types, status) of what is expected or shown.

    Both sides have (page, visual_type, table, field, field_type), any of which may be null. They meet in
    one grouping, pre-aggregated by the tasks, as an outer join of both would. What is shown
    but not expected is UNEXPECTED; several captured types are listed, and the expected one among them is CORRECT.
    """
    sides = expected.select(*_PLACE, F.col("field_type").alias("expected"), F.lit(None).cast("string").alias("captured"), F.lit(True).alias("asked"))
    sides = sides.unionByName(
        captured.select(*_PLACE, F.lit(None).cast("string").alias("expected"), F.coalesce("field_type", F.lit("")).alias("captured"), F.lit(False).alias("asked"))
    )
    met = sides.groupBy(*_PLACE).agg(
        F.min("expected").alias("expected_type"), F.sort_array(F.collect_set("captured")).alias("types"), F.bool_or("asked").alias("asked")
    )
    status = (
        F.when(~F.col("asked"), "UNEXPECTED")
        .when(F.size("types") == 0, "MISSING")
        .when(F.array_contains("types", F.coalesce("expected_type", F.lit(""))), "CORRECT")
        .otherwise("PARTIAL")
    )
    return met.select(*_PLACE, "expected_type", F.array_join("types", ",").alias("captured_types"), status.alias("status"))


def coverage_grains(places: DataFrame) -> DataFrame:
    """Coverage per table, per page and per visual type of a page: (grain, table, page, visual_type, counts by status, captured).

    One pass over ``coverage_places`` with grouping sets; columns that a grain does not have are null.
    """
    status = F.col("status")
    counted = places.groupingSets(
        [["table"], ["page"], ["page", "visual_type"]], "table", "page", "visual_type"
    ).agg(
        F.grouping("table").alias("no_table"),
        F.grouping("visual_type").alias("no_visual"),
        F.count_if(status != "UNEXPECTED").alias("expected"),
        *[F.count_if(status == s).alias(s.lower()) for s in ("CORRECT", "PARTIAL", "MISSING", "UNEXPECTED")],
        F.bool_or(status != "MISSING").alias("captured"),
    )
    grain = F.when(F.col("no_table") == 0, "table").when(F.col("no_visual") == 0, "visual").otherwise("page")
    return counted.select(
        grain.alias("grain"), "table", "page", "visual_type", "expected", "correct", "partial", "missing", "unexpected", "captured"
    )
