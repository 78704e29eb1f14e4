"""Lineage of run events.

Everything that is local to one event stays inside its row: datasets, their column
lookups and the resolved column lineage are arrays built with higher-order functions.
One explode turns them into links or assets, and one ``distinct`` (which pre-aggregates
on the map side, so a hot id costs nothing) is the only shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweft.config import LineageConfig
from lineweft.functions import names as N
from lineweft.functions import vocabulary as V
from lineweft.functions.rows import ASSET_TYPE, LINK_TYPE, asset, explode_rows, flat_map, let, link, no_nulls

_COLUMNS = "array<struct<key:string,column:string,pos:int>>"
_STRINGS = "array<string>"
_INPUT_FIELDS = (
    "array<struct<namespace:string,name:string,field:string,transformations:array<struct<type:string>>>>"
)
_SOURCES = "array<struct<source_key:string,columns:array<string>>>"
_LINEAGE = f"array<struct<target_key:string,target_column:string,sources:{_SOURCES}>>"


def _size(array: Column) -> Column:
    return F.coalesce(F.size(array), F.lit(0))


def is_lineage_ready() -> Column:
    return (_size(F.col("event.inputs")) > 0) & (_size(F.col("event.outputs")) > 0)


def lineage_ready_events(events: DataFrame) -> DataFrame:
    """Events with at least one input and one output; the others cannot give lineage."""
    return events.where(F.col("is_valid") & is_lineage_ready())


def _stripped_sql(name: str) -> str:
    """The SQL of ``names.strip_quotes``."""
    quoted = f"""contains({name}, '`') OR contains({name}, '"') OR contains({name}, "'")"""
    return f"""if({quoted}, btrim(btrim(btrim({name}, '`'), '"'), "'"), {name})"""


def _expand_sql(field: str, depth: int) -> str:
    """SQL of a field's leaf names; containers themselves are dropped.

    The recursion is written as text because each level is the same expression; building
    it call by call took most of the planning time. Below the typed levels a container holds its
    fields as text. They are read one by one from a list in which those of a container take its place; every
    one has a brace of its own in the text, so there are steps enough for any depth.
    """
    own = _own_sql(field)
    if depth:
        inner = f"f{depth}"
        below = f"flatten(transform({_named_sql(f'{field}.fields', inner)}, {inner} -> {_expand_sql(inner, depth - 1)}))"
        return f"if(coalesce(size({field}.fields) > 0, false), {below}, {own})"
    rest = "slice(s.left, 2, size(s.left))"
    opened = f"struct(concat({_named_sql(_parsed_sql('s.left[0]'), 'g')}, {rest}) AS left, s.leaves AS leaves)"
    kept = f"struct({rest} AS left, concat(s.leaves, {_own_sql('s.left[0]')}) AS leaves)"
    start = f"struct({_named_sql(_parsed_sql(field), 'g')} AS left, CAST(array() AS array<string>) AS leaves)"
    step = f"if(size(s.left) = 0, s, if({_filled_sql('s.left[0]')}, {opened}, {kept}))"
    steps = f"sequence(1, regexp_count({field}.fields, r'\\{{'))"
    return f"if({_filled_sql(field)}, aggregate({steps}, {start}, (s, i) -> {step}, s -> s.leaves), {own})"


def _own_sql(field: str) -> str:
    name = _stripped_sql(f"{field}.name")
    comparable = f"regexp_replace(lower({name}), r'[^\\p{{L}}\\p{{N}}]', '')"
    return f"array(if(char_length({name}) >= 9 AND {comparable} = 'timestamp', 'timestamp', {name}))"


def _parsed_sql(field: str) -> str:
    return f"from_json({field}.fields, 'array<struct<name:string,fields:string>>')"


def _filled_sql(field: str) -> str:
    return f"coalesce({field}.fields LIKE '%{{%' AND size({_parsed_sql(field)}) > 0, false)"


def _named_sql(fields: str, field: str) -> str:
    return f"filter({fields}, {field} -> coalesce({_stripped_sql(f'{field}.name')}, '') <> '')"


def _top_fields(datasets: str, depth: int) -> Column:
    """Per dataset array<struct<top, leaves>> in document order, for the lookup of container names."""
    top = f"struct({_stripped_sql('t.name')} AS top, {_expand_sql('t', depth)} AS leaves)"
    return F.expr(f"transform({datasets}, d -> transform({_named_sql('d.facets.schema.fields', 't')}, t -> {top}))")


def with_job_ids(events: DataFrame) -> DataFrame:
    job = F.col("event.job")
    app = F.coalesce(
        F.col("event.run.facets.spark_properties.properties").getField("spark.app.name"), F.lit(V.DEFAULT_APP)
    )
    namespace = F.coalesce(job["namespace"], F.lit(V.DEFAULT_JOB_NAMESPACE))
    name = F.coalesce(job["name"], F.lit(V.DEFAULT_JOB))
    statement = F.coalesce(job["facets"]["jobType"]["jobType"], F.lit(V.DEFAULT_STATEMENT))
    slash = F.lit("/")
    app_id = N.escape_resource(app)
    return events.select(
        "*",
        F.struct(
            app_id.alias("app_id"),
            namespace.alias("namespace"),
            F.concat(app_id, slash, namespace).alias("schema_id"),
            name.alias("job_name"),
            F.concat(app_id, slash, namespace, slash, name).alias("task_id"),
            statement.alias("statement_name"),
            F.concat(app_id, slash, namespace, slash, name, slash, statement).alias("statement_id"),
            job["facets"]["sql"]["query"].alias("statement_text"),
        ).alias("job"),
    )


_DATASETS = "array<struct<role:string,pos:int,key:string,source_id:string,resource_id:string,table:string>>"
_DATASET_FIELDS = "array<array<struct<top:string,leaves:array<string>>>>"


def with_datasets(events: DataFrame, config: LineageConfig = LineageConfig()) -> DataFrame:
    """Adds ``datasets``: inputs then outputs, each with its key; and ``dataset_fields``, their columns in the same order.

    The two are columns of their own, so what only needs keys unfolds no schema.
    """

    def described(side: str, role: str) -> Column:
        return F.transform(
            F.col(side),
            lambda d, i: let(
                N.dataset_key(d["namespace"], d["name"]),
                lambda key: F.struct(
                    F.lit(role).alias("role"),
                    i.alias("pos"),
                    key.alias("key"),
                    N.parent_id(key).alias("source_id"),
                    N.resource_of(key).alias("resource_id"),
                    N.leaf_name(key).alias("table"),
                ),
            ),
        )

    sides = {"_in": "inputs", "_out": "outputs"}
    present = [F.expr(f"filter(event.{name}, d -> d IS NOT NULL)").alias(side) for side, name in sides.items()]
    fields = F.concat(*[no_nulls(_top_fields(side, config.max_depth), _DATASET_FIELDS) for side in sides])
    prepared = events.select("*", *present)
    both = F.concat(
        no_nulls(described("_in", "input"), _DATASETS), no_nulls(described("_out", "output"), _DATASETS)
    )
    return prepared.select(*events.columns, both.alias("datasets"), fields.alias("dataset_fields"))


def _candidate(column: Column) -> Column:
    return F.struct(column.alias("column"), N.comparable_leaf(column).alias("comparable"))


def with_lookup(events: DataFrame) -> DataFrame:
    """Adds ``lookup``: parallel arrays, newest dataset and field first.

    ``array_position`` on the reversed keys finds the last occurrence, which is the
    one that counts when a dataset or a field is stated twice.
    """
    newest, fields = F.reverse(F.col("datasets")), F.reverse(F.col("dataset_fields"))
    return events.withColumn(
        "lookup",
        F.struct(
            F.transform(newest, lambda d: d["key"]).alias("keys"),
            F.transform(fields, lambda of: F.transform(F.reverse(of), lambda f: f["top"])).alias("tops"),
            F.transform(
                fields,
                lambda of: F.transform(
                    F.reverse(of),
                    lambda f: F.transform(
                        F.when(F.size(f["leaves"]) > 0, f["leaves"]).otherwise(F.array(f["top"])), _candidate
                    ),
                ),
            ).alias("leaves"),
        ),
    )


def preferred_inputs(input_fields: Column) -> Column:
    """Only the DIRECT inputs when there are any, else all of them."""

    def is_direct(f: Column) -> Column:
        return f.isNotNull() & N.has_direct(f["transformations"])

    return F.when(F.exists(input_fields, is_direct), F.filter(input_fields, is_direct)).otherwise(
        F.filter(input_fields, lambda f: f.isNotNull())
    )


def resolved_columns(wanted: Column, at: Column, raw_field: Column, direct: Column, lookup: Column) -> Column:
    """Leaf columns of the source ``at`` its place in ``lookup`` (0: not there) that feed a target through ``raw_field``.

    In this order: the leaves whose comparable name agrees with ``wanted``; the field
    itself when it is no container; every leaf when the transformation is DIRECT; nothing.
    """

    def place(field: Column, of_leaves) -> Column:
        """The leaves of the stated ``field``; one that the data set does not state stands for itself."""
        return let(
            F.when(at > 0, F.array_position(F.get(lookup["tops"], at - 1), field)).cast("int"),
            lambda t: F.when(t > 0, of_leaves(F.get(F.get(lookup["leaves"], at - 1), t - 1))).otherwise(F.array(field)),
        )

    def choose(field: Column, leaves: Column) -> Column:
        def agrees(c: Column) -> Column:
            return N.names_agree(wanted, c["comparable"])

        is_field = (F.size(leaves) == 1) & (F.get(leaves, 0)["column"] == field)
        chosen = F.when(F.exists(leaves, agrees), F.filter(leaves, agrees)).when(is_field | direct, leaves)
        return F.coalesce(F.transform(chosen, lambda c: c["column"]), F.array().cast(_STRINGS))

    return let(
        N.strip_quotes(raw_field),
        lambda field: F.when(F.coalesce(field, F.lit("")) == "", F.array().cast(_STRINGS)).otherwise(
            place(field, lambda leaves: choose(field, leaves))
        ),
    )


def _targets(output: Column) -> Column:
    """Entries of an output's column lineage that name a column."""
    return F.filter(
        F.map_entries(output["facets"]["columnLineage"]["fields"]),
        lambda e: F.coalesce(N.strip_quotes(e["key"]), F.lit("")) != "",
    )


def with_column_lineage(events: DataFrame) -> DataFrame:
    """Adds ``lineage``: per target column of every output, the resolved source columns.

    ``target_columns`` has the names of the targets alone, so what only needs those resolves nothing.
    """
    lookup = F.col("lookup")
    outputs = F.filter(F.col("event.outputs"), lambda o: o.isNotNull())

    def placed(key: Column) -> Column:
        return F.struct(key.alias("key"), F.array_position(lookup["keys"], key).cast("int").alias("at"))

    # Sources are mostly inputs of the event: their keys and places in the lookup are worked out once. As parts of
    # one struct, both of them used, the planner leaves them where they are and does not move them into the lambdas.
    stated = F.transform(F.filter(F.col("event.inputs"), lambda i: i.isNotNull()), _names)
    known = F.transform("datasets", lambda d: placed(d["key"]))
    events = events.withColumn("_sources", F.struct(stated.alias("names"), known.alias("placed")))

    def source(f: Column) -> Column:
        return let(
            F.array_position("_sources.names", _names(f)).cast("int"),
            lambda i: F.when(i > 0, F.get("_sources.placed", i - 1)).otherwise(
                let(N.dataset_key(f["namespace"], f["name"]), placed)
            ),
        )

    def of_entry(target_key: Column, entry: Column) -> Column:
        inputs = no_nulls(preferred_inputs(entry["value"]["inputFields"]), _INPUT_FIELDS)

        def of_input(wanted: Column, f: Column) -> Column:
            return let(
                source(f),
                lambda s: F.struct(
                    s["key"].alias("source_key"),
                    resolved_columns(wanted, s["at"], f["field"], N.has_direct(f["transformations"]), lookup).alias(
                        "columns"
                    ),
                ),
            )

        return let(
            N.strip_quotes(entry["key"]),
            lambda target: let(
                N.comparable(target),
                lambda wanted: F.struct(
                    target_key.alias("target_key"),
                    target.alias("target_column"),
                    F.transform(inputs, lambda f: of_input(wanted, f)).alias("sources"),
                ),
            ),
        )

    def of_output(output: Column) -> Column:
        key = N.dataset_key(output["namespace"], output["name"])
        return let(key, lambda k: no_nulls(F.transform(_targets(output), lambda e: of_entry(k, e)), _LINEAGE))

    def names_of(output: Column) -> Column:
        return no_nulls(F.transform(_targets(output), lambda e: N.strip_quotes(e["key"])), _STRINGS)

    return events.select(
        "*",
        no_nulls(flat_map(outputs, of_output), _LINEAGE).alias("lineage"),
        no_nulls(flat_map(outputs, names_of), _STRINGS).alias("target_columns"),
    ).drop("_sources")


def _names(dataset: Column) -> Column:
    """One text that only equal pairs of namespace and name have; null where one of them is."""
    namespace = dataset["namespace"]
    return F.concat(F.octet_length(namespace).cast("string"), F.lit(":"), namespace, dataset["name"])


def derive(events: DataFrame, config: LineageConfig = LineageConfig()) -> DataFrame:
    """Ready events with job, datasets, lookup, own columns and column lineage as in-row arrays."""
    ready = with_lookup(with_datasets(with_job_ids(lineage_ready_events(events)), config))
    place = [c for c in ("line_number", "at") if c in events.columns]
    return with_own_columns(with_column_lineage(ready)).select(
        "file", *place, "event", "job", "datasets", "dataset_fields", "lookup", "lineage", "target_columns", "columns"
    )


def with_own_columns(events: DataFrame) -> DataFrame:
    """Adds ``columns``: the schema leaves of the last dataset of every key."""
    datasets = F.arrays_zip("datasets", "dataset_fields")
    last = F.filter(
        datasets,
        lambda d, i: i == F.size("datasets") - F.array_position(F.col("lookup.keys"), d["datasets"]["key"]).cast("int"),
    )
    columns = flat_map(
        last,
        lambda d: F.transform(
            F.coalesce(flat_map(d["dataset_fields"], lambda f: f["leaves"]), F.array().cast(_STRINGS)),
            lambda leaf, i: F.struct(d["datasets"]["key"].alias("key"), leaf.alias("column"), i.alias("pos")),
        ),
    )
    return events.withColumn("columns", no_nulls(columns, _COLUMNS))


# ---------------------------------------------------------------- row-level views of the derived arrays


def job_ids(derived: DataFrame) -> DataFrame:
    return derived.select("file", "line_number", "job.*")


def event_datasets(derived: DataFrame) -> DataFrame:
    return explode_rows(derived, F.col("datasets"), ("file", "line_number")).select(
        "file", "line_number", "role", "pos", "key"
    )


def flatten_fields(derived: DataFrame) -> DataFrame:
    """(file, line_number, role, dataset_pos, key, top_field, leaf, pos)."""
    rows = flat_map(
        F.arrays_zip("datasets", "dataset_fields"),
        lambda d: F.coalesce(
            flat_map(
                d["dataset_fields"],
                lambda f: F.transform(
                    f["leaves"],
                    lambda leaf: F.struct(
                        d["datasets"]["role"].alias("role"),
                        d["datasets"]["pos"].alias("dataset_pos"),
                        d["datasets"]["key"].alias("key"),
                        f["top"].alias("top_field"),
                        leaf.alias("leaf"),
                    ),
                ),
            ),
            F.array().cast("array<struct<role:string,dataset_pos:int,key:string,top_field:string,leaf:string>>"),
        ),
    )
    return explode_rows(derived, rows, ("file", "line_number"))


def field_lookup(derived: DataFrame) -> DataFrame:
    """(file, line_number, key, top_field, leaf): the lookup that column resolution uses."""
    lookup = F.col("lookup")
    per_dataset = F.transform(
        lookup["keys"],
        lambda key, i: F.struct(
            key.alias("key"), F.get(lookup["tops"], i).alias("tops"), F.get(lookup["leaves"], i).alias("leaves")
        ),
    )
    newest = F.filter(per_dataset, lambda d, i: F.array_position(lookup["keys"], d["key"]) == i + 1)
    rows = flat_map(
        newest,
        lambda d: F.coalesce(
            F.flatten(
                F.transform(
                    d["tops"],
                    lambda top, i: F.when(
                        F.array_position(d["tops"], top) == i + 1,
                        F.transform(
                            F.get(d["leaves"], i),
                            lambda leaf: F.struct(
                                d["key"].alias("key"), top.alias("top_field"), leaf["column"].alias("leaf")
                            ),
                        ),
                    ).otherwise(F.array().cast("array<struct<key:string,top_field:string,leaf:string>>")),
                )
            ),
            F.array().cast("array<struct<key:string,top_field:string,leaf:string>>"),
        ),
    )
    return explode_rows(derived, rows, ("file", "line_number"))


def dataset_columns(derived: DataFrame) -> DataFrame:
    """Distinct (key, column) of all schemas."""
    return explode_rows(derived, F.col("columns")).select("key", "column").distinct()


def direct_inputs(derived: DataFrame) -> DataFrame:
    """(file, line_number, target_key, target_column, source_key, field) after DIRECT preference."""
    outputs = F.filter(F.col("event.outputs"), lambda o: o.isNotNull())
    rows = flat_map(
        outputs,
        lambda o: F.coalesce(
            flat_map(
                F.map_entries(o["facets"]["columnLineage"]["fields"]),
                lambda e: F.coalesce(
                    F.transform(
                        preferred_inputs(e["value"]["inputFields"]),
                        lambda f: F.struct(
                            N.dataset_key(o["namespace"], o["name"]).alias("target_key"),
                            N.strip_quotes(e["key"]).alias("target_column"),
                            N.dataset_key(f["namespace"], f["name"]).alias("source_key"),
                            N.strip_quotes(f["field"]).alias("field"),
                            N.has_direct(f["transformations"]).alias("is_direct"),
                        ),
                    ),
                    F.array().cast(
                        "array<struct<target_key:string,target_column:string,source_key:string,field:string,"
                        "is_direct:boolean>>"
                    ),
                ),
            ),
            F.array().cast(
                "array<struct<target_key:string,target_column:string,source_key:string,field:string,is_direct:boolean>>"
            ),
        ),
    )
    return explode_rows(derived, rows, ("file", "line_number"))


def resolve_columns(derived: DataFrame) -> DataFrame:
    """(file, line_number, target_key, target_column, source_key, source_column)."""
    rows = flat_map(
        F.col("lineage"),
        lambda e: flat_map(
            e["sources"],
            lambda s: F.transform(
                s["columns"],
                lambda c: F.struct(
                    e["target_key"].alias("target_key"),
                    e["target_column"].alias("target_column"),
                    s["source_key"].alias("source_key"),
                    c.alias("source_column"),
                ),
            ),
        ),
    )
    return explode_rows(derived, rows, ("file", "line_number"))


# ---------------------------------------------------------------- the graph

def _join(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def _flow_links() -> Column:
    """input -> statement -> output; both ends exist for every ready event."""
    statement = F.col("job.statement_id")
    return F.transform(
        F.col("datasets"),
        lambda d: F.when(d["role"] == "input", link(d["key"], statement, V.DATASET_FLOW)).otherwise(
            link(statement, d["key"], V.DATASET_FLOW)
        ),
    )


def _column_links() -> Column:
    statement = F.col("job.statement_id")

    def of_target(e: Column) -> Column:
        calculation = _join(statement, e["target_column"])
        own = F.array(
            link(statement, calculation, V.STATEMENT_TO_CALCULATION),
            link(calculation, _join(e["target_key"], e["target_column"]), V.COLUMN_FLOW),
        )
        feeding = flat_map(
            e["sources"],
            lambda s: F.transform(
                s["columns"], lambda c: link(_join(s["source_key"], c), calculation, V.COLUMN_FLOW)
            ),
        )
        return F.concat(own, feeding)

    return flat_map(F.col("lineage"), of_target)




def _all_datasets() -> Column:
    """Datasets of the event plus those that only column lineage names."""
    stated = F.transform(
        F.col("datasets"),
        lambda d: F.struct(
            d["key"].alias("key"),
            d["source_id"].alias("source_id"),
            d["resource_id"].alias("resource_id"),
            d["table"].alias("table"),
        ),
    )
    traced = flat_map(F.col("lineage"), lambda e: F.transform(e["sources"], lambda s: s["source_key"]))
    only_traced = F.array_except(traced, F.transform(F.col("datasets"), lambda d: d["key"]))
    derived = F.transform(
        only_traced,
        lambda key: F.struct(
            key.alias("key"),
            N.parent_id(key).alias("source_id"),
            N.resource_of(key).alias("resource_id"),
            N.leaf_name(key).alias("table"),
        ),
    )
    return F.concat(stated, derived)


def _all_elements() -> Column:
    """array<struct<key, column>>: schema leaves, lineage targets and resolved sources."""

    def element(key: Column, column: Column) -> Column:
        return F.struct(key.alias("key"), column.alias("column"))

    own = F.transform(F.col("columns"), lambda c: element(c["key"], c["column"]))
    targets = F.transform(F.col("lineage"), lambda e: element(e["target_key"], e["target_column"]))
    sources = flat_map(
        F.col("lineage"),
        lambda e: flat_map(e["sources"], lambda s: F.transform(s["columns"], lambda c: element(s["source_key"], c))),
    )
    return F.concat(own, targets, sources)


def _hierarchy_links() -> Column:
    root = F.lit(V.ROOT_LOWER)
    job = F.col("job")
    physical = flat_map(
        _all_datasets(),
        lambda d: F.array(
            link(root, d["resource_id"], V.RESOURCE_PARENT_CHILD),
            link(d["resource_id"], d["source_id"], V.RESOURCE_PARENT_CHILD),
            link(d["source_id"], d["key"], V.DATASOURCE_PARENT_CHILD),
        ),
    )
    elements = F.transform(
        _all_elements(), lambda e: link(e["key"], _join(e["key"], e["column"]), V.DATASET_ELEMENT)
    )
    jobs = F.array(
        link(root, job["app_id"], V.RESOURCE_PARENT_CHILD),
        link(job["app_id"], job["schema_id"], V.DATABASE_TO_SCHEMA),
        link(job["schema_id"], job["task_id"], V.SCHEMA_TO_TASK),
        link(job["task_id"], job["statement_id"], V.TASK_TO_STATEMENT),
    )
    return F.concat(physical, elements, jobs)


def dataset_flow(derived: DataFrame) -> DataFrame:
    return explode_rows(derived, _flow_links()).distinct()


def column_lineage(derived: DataFrame) -> DataFrame:
    return explode_rows(derived, _column_links()).distinct()


def hierarchy_links(derived: DataFrame) -> DataFrame:
    """Containment links, without statement -> calculation (see ``column_lineage``)."""
    return explode_rows(derived, _hierarchy_links()).distinct()


def link_rows(derived: DataFrame) -> DataFrame:
    """All links of every event, repeated as often as events state them."""
    return explode_rows(derived, F.concat(_hierarchy_links(), _flow_links(), _column_links()).cast(LINK_TYPE))


def event_links(derived: DataFrame) -> DataFrame:
    """All links of the event graph: one pass over the events, one shuffle."""
    return link_rows(derived).distinct()


def _physical_assets() -> Column:
    per_dataset = flat_map(
        _all_datasets(),
        lambda d: F.array(
            asset(V.RESOURCE, d["resource_id"], d["resource_id"], "TRUE", ""),
            asset(V.DATA_SOURCE, d["source_id"], d["source_id"], "TRUE", ""),
            asset(V.DATA_SET, d["key"], d["table"], "TRUE", ""),
        ),
    )
    elements = F.transform(
        _all_elements(),
        lambda e: asset(V.DATA_ELEMENT, _join(e["key"], e["column"]), e["column"], "TRUE", ""),
    )
    return F.concat(per_dataset, elements).cast(ASSET_TYPE)


def _job_assets() -> Column:
    job = F.col("job")
    chain = F.array(
        asset(V.JOB_DATABASE, job["app_id"], job["app_id"], "", "TRUE"),
        asset(V.JOB_SCHEMA, job["schema_id"], job["namespace"], "", "TRUE"),
        asset(V.JOB_TASK, job["task_id"], job["job_name"], "", "TRUE"),
    ).cast(ASSET_TYPE)
    statement = F.array(
        asset(
            V.JOB_STATEMENT,
            job["statement_id"],
            job["statement_name"],
            "",
            "TRUE",
            **{V.STATEMENT_TEXT: job["statement_text"]},
        )
    ).cast(ASSET_TYPE)
    calculations = F.transform(
        F.col("target_columns"),
        lambda column: asset(V.JOB_CALCULATION, _join(job["statement_id"], column), column, "", "TRUE"),
    ).cast(ASSET_TYPE)
    return F.concat(chain, statement, calculations)


def physical_assets(derived: DataFrame) -> DataFrame:
    return explode_rows(derived, _physical_assets()).distinct()


def job_assets(derived: DataFrame) -> DataFrame:
    return explode_rows(derived, _job_assets()).distinct()


def event_assets(derived: DataFrame) -> DataFrame:
    return explode_rows(derived, F.concat(_physical_assets(), _job_assets())).distinct()


def graph_rows(derived: DataFrame) -> DataFrame:
    """(kind, link, asset): all links and assets of every event in one pass, repeated as often as events state them."""
    links = F.concat(_hierarchy_links(), _flow_links(), _column_links()).cast(LINK_TYPE)
    assets = F.concat(_physical_assets(), _job_assets()).cast(ASSET_TYPE)
    no_link, no_asset = (F.lit(None).cast(t.removeprefix("array<").removesuffix(">")) for t in (LINK_TYPE, ASSET_TYPE))

    def tagged(kind: str, link: Column, asset: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), link.alias("link"), asset.alias("asset"))

    rows = F.concat(
        F.transform(links, lambda l: tagged("link", l, no_asset)), F.transform(assets, lambda a: tagged("asset", no_link, a))
    )
    return explode_rows(derived, rows)


def source_override(sources: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace data-source ids by a mapping (pos, resource_id, db, external_id, name).

    ``sources`` has (resource_id, db, external_id, name). The first mapping row by
    ``pos`` that has an id, the same db and no or the same resource wins. The mapping
    is reduced to one row per key first, so a source meets at most two rows.
    """
    usable = mapping.where(
        (F.coalesce(F.col("db"), F.lit("")) != "") & (F.coalesce(F.col("external_id"), F.lit("")) != "")
    ).select(
        F.lower("db").alias("_db"),
        F.lower(F.coalesce("resource_id", F.lit(""))).alias("_resource"),
        F.struct("pos", "external_id", N.blank_to_null(F.col("name")).alias("name")).alias("_hit"),
    )
    first = usable.groupBy("_db", "_resource").agg(F.min_by("_hit", "_hit.pos").alias("_hit"))
    exact = first.select("_db", "_resource", F.col("_hit").alias("_exact")).where("_resource <> ''")
    general = first.where("_resource = ''").select("_db", F.col("_hit").alias("_general"))
    keyed = sources.select(
        "*",
        F.lower("db").alias("_db"),
        F.lower(F.coalesce("resource_id", F.lit(""))).alias("_resource"),
    )
    joined = keyed.join(exact, ["_db", "_resource"], "left").join(general, "_db", "left")
    use_exact = F.col("_general").isNull() | (F.col("_exact.pos") <= F.col("_general.pos"))
    hit = F.when(F.col("_exact").isNotNull() & use_exact, F.col("_exact")).otherwise(F.col("_general"))
    chosen = joined.withColumn("_hit", hit)
    return chosen.select(
        "resource_id",
        "db",
        F.coalesce("_hit.external_id", "external_id").alias("external_id"),
        F.when(F.col("_hit").isNotNull(), F.coalesce("_hit.name", "_hit.external_id"))
        .otherwise(F.col("name"))
        .alias("name"),
    )
