"""SQL script corpora: clean-up, statements, table references, flow and publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweft.config import LineageConfig
from lineweft.functions import names as N
from lineweft.functions import vocabulary as V
from lineweft.functions.rows import LINK_TYPE, asset, explode_rows, flat_map, link, union_all
from lineweft.operators.ranking import sort_columns, with_position
from lineweft.session import cut_lineage

_BLANKS = " \t\n\r\x0b\x0c"

# Dialect clauses that are dropped before a script is split.
DIALECT_CLAUSES = (
    r"(?i)\bSECURITY\s+INVOKER\s+",
    r"(?i)\bRETURNS\s+STRUCT\s*\([^)]*\)\s*",
    r"(?i)\bUSING\s+LANGUAGE\s+\w+\s*",
)

_PART = r'(?:`[^`]+`|"[^"]+"|[\w$]+)'
_NAME = rf"{_PART}(?:\s*\.\s*{_PART})*+"
_TABLE = rf"(?!(?:LATERAL|UNNEST|SELECT|VALUES)\b){_NAME}(?!\s*\()"
_CREATED = (
    r"(?i)\bCREATE\s+(?:OR\s+REPLACE\s+)?(?:GLOBAL\s+)?(?:TEMP(?:ORARY)?\s+)?(?:MATERIALIZED\s+)?(?:TABLE|VIEW)\s+"
    rf"(?:IF\s+NOT\s+EXISTS\s+)?({_NAME})(?=[\s\S]*?\bAS\s*\(*\s*(?:SELECT|WITH|FROM)\b)"
)
_INSERTED = rf"(?i)\bINSERT\s+(?:INTO|OVERWRITE)\s+(?:TABLE\s+)?({_NAME})"
# An alias is any word that cannot go on the statement; else "FROM a JOIN b" would lose its join.
_CLAUSES = "JOIN|INNER|LEFT|RIGHT|FULL|CROSS|NATURAL|ON|USING|WHERE|GROUP|ORDER|HAVING|LIMIT|UNION|INSERT|SELECT|FROM"
_ALIAS = rf"(?:\s+(?:AS\s+)?(?!(?:{_CLAUSES})\b)\w+)?"
_READ = rf"(?i)\b(?:FROM|JOIN)\s+({_TABLE}{_ALIAS}(?:\s*,\s*{_TABLE}{_ALIAS})*)"
_CTE = (
    r"(?i)(?:\bWITH|,)\s+(?:RECURSIVE\s+)?([A-Za-z_]\w*|`[^`]+`|\"[^\"]+\")\s*(?:\([^()]*\)\s*)?"
    r"AS\s*(?:(?:NOT\s+)?MATERIALIZED\s*)?\("
)
_NOISE = r"'[^']*+'|--[^\n]*|(?s:/\*.*?\*/)"
_FUNCTION_FROM = r"(?i)\b(?:EXTRACT|TRIM|SUBSTRING|OVERLAY|POSITION)\s*\([^()]*?\bFROM\b|\bIS\s+(?:NOT\s+)?DISTINCT\s+FROM\b"


def clean_sql(text: Column) -> Column:
    for clause in DIALECT_CLAUSES:
        text = F.regexp_replace(text, clause, "")
    return text


def statements(scripts: DataFrame) -> DataFrame:
    """(file, text) to (file, stmt_no, sql): cut at every ``;``, empties dropped, numbered from 1."""
    parts = F.transform(F.split(clean_sql(F.col("text")), ";"), lambda s: F.btrim(s, F.lit(_BLANKS)))
    return scripts.select("file", F.posexplode(F.filter(parts, lambda s: s != "")).alias("pos", "sql")).select(
        "file", (F.col("pos") + 1).cast("bigint").alias("stmt_no"), "sql"
    )


def _plain_name(name: Column, default_schema: str) -> Column:
    flat = F.regexp_replace(name, r'\s*\.\s*', ".")
    flat = F.translate(flat, '`"', "")
    return F.when(F.contains(flat, F.lit(".")), flat).otherwise(F.concat(F.lit(f"{default_schema}."), flat))


def table_refs(stmts: DataFrame, config: LineageConfig = LineageConfig()) -> DataFrame:
    """Adds ``targets``, ``sources`` and ``state`` of each statement.

    Literals and comments are blanked first. Only CREATE ... AS and INSERT give targets
    and only FROM/JOIN give sources; a statement of another form is left unparsed
    rather than guessed at. The state is usable for one target, unparsed for none and
    ambiguous for several.
    """
    bare = F.regexp_replace(F.regexp_replace("sql", _NOISE, " "), _FUNCTION_FROM, " ( ")
    prepared = stmts.withColumn("_bare", bare)
    ctes = F.transform(F.regexp_extract_all("_bare", F.lit(_CTE), F.lit(1)), lambda n: F.lower(F.translate(n, '`"', "")))
    created = F.regexp_extract_all("_bare", F.lit(_CREATED), F.lit(1))
    inserted = F.regexp_extract_all("_bare", F.lit(_INSERTED), F.lit(1))
    lists = F.regexp_extract_all("_bare", F.lit(_READ), F.lit(1))
    read = flat_map(
        lists,
        lambda l: F.transform(F.split(l, r"\s*,\s*"), lambda piece: F.regexp_extract(piece, f"^({_NAME})", 1)),
    )
    named = prepared.select(
        *stmts.columns,
        ctes.alias("_ctes"),
        F.array_distinct(
            F.transform(F.concat(created, inserted), lambda n: _plain_name(n, config.target_schema))
        ).alias("targets"),
        read.alias("_read"),
    )
    physical = F.filter("_read", lambda n: ~F.array_contains(F.col("_ctes"), F.lower(F.translate(n, '`"', ""))))
    count = F.size("targets")
    return named.select(
        *stmts.columns,
        "targets",
        F.array_distinct(F.transform(physical, lambda n: _plain_name(n, config.source_schema))).alias("sources"),
        F.when(count == 0, "unparsed").when(count > 1, "ambiguous").otherwise("usable").alias("state"),
    )


def kept_refs(refs: DataFrame) -> DataFrame:
    """``refs`` without their text, written once, so that what reads them several times neither parses nor moves it again."""
    return cut_lineage(refs.select("file", "stmt_no", "state", "targets", "sources", F.lit("").alias("sql")))


def task_id(file: Column, config: LineageConfig) -> Column:
    return F.concat(F.lit(f"{config.script_path}/"), file)


def statement_id(file: Column, number: Column, config: LineageConfig) -> Column:
    return F.concat(task_id(file, config), F.lit("/statement_"), number.cast("string"))


def unparsed_sql(refs: DataFrame, config: LineageConfig = LineageConfig()) -> DataFrame:
    """(task, sql) without a single clear target, each once."""
    return refs.where(F.col("state") != "usable").select(task_id(F.col("file"), config).alias("task"), "sql").distinct()


def _path(resource: str, table: Column, separator: str = "/") -> Column:
    return F.concat(F.lit(f"{resource}{separator}"), F.replace(table, F.lit("."), F.lit("/")))


def _dataset_edges(config: LineageConfig, separator: str) -> Column:
    """source -> statement -> target; a statement without source still feeds its target."""
    sid = statement_id(F.col("file"), F.col("stmt_no"), config)
    target = _path(config.target_resource, F.get("targets", 0), separator)
    reads = F.transform(
        "sources", lambda s: link(_path(config.source_resource, s, separator), sid, V.DATASET_FLOW)
    )
    return F.concat(reads, F.array(link(sid, target, V.DATASET_FLOW)))


def script_dataset_flow(
    refs: DataFrame, config: LineageConfig = LineageConfig(), separator: str = "/"
) -> DataFrame:
    usable = refs.where(F.col("state") == "usable")
    return explode_rows(usable, _dataset_edges(config, separator)).distinct()


# ---------------------------------------------------------------- column facts

_FACT = ["task", "stmt_no", "src_schema", "src_table", "src_col", "tgt_schema", "tgt_table", "tgt_col"]


def drop_resolved_stars(facts: DataFrame) -> DataFrame:
    """Distinct facts without the ``* -> *`` facts of statements that have any other fact.

    Only the star pairs are looked up, against one pre-aggregated row per statement, so
    a statement with very many facts is never gathered in one place.
    """
    unique = facts.select(*_FACT).distinct()
    is_star = (F.col("src_col") == "*") & (F.col("tgt_col") == "*")
    crowded = unique.groupBy("task", "stmt_no").agg(F.count("*").alias("_facts")).where("_facts > 1")
    alone = unique.where(is_star).join(crowded, ["task", "stmt_no"], "left_anti")
    return unique.where(~F.coalesce(is_star, F.lit(False))).unionByName(alone.select(*_FACT))


def with_fact_ids(facts: DataFrame, config: LineageConfig = LineageConfig(), separator: str = "/") -> DataFrame:
    """Ids of both sides, the statement and its column; ``separator`` joins resource and schema."""

    def side(prefix: str, resource: str, default: str) -> dict[str, Column]:
        schema = F.col(f"{prefix}_schema")
        schema = F.when(schema.isNull() | (schema == "<default>"), F.lit(default)).otherwise(schema)
        path = F.replace(schema, F.lit("."), F.lit("/")) if separator == "/" else schema
        source = F.concat(F.lit(f"{resource}{separator}"), path)
        dataset = F.concat(source, F.lit("/"), F.col(f"{prefix}_table"))
        column = N.star_ref(F.col(f"{prefix}_table"), F.col(f"{prefix}_col"))
        return {
            f"{prefix}_table_name": F.concat(schema, F.lit("."), F.col(f"{prefix}_table")),
            f"{prefix}_column": column,
            f"{prefix}_source": source,
            f"{prefix}_dataset": dataset,
            f"{prefix}_element": F.concat(dataset, F.lit("/"), column),
        }

    sid = statement_id(F.col("task"), F.col("stmt_no"), config)
    source = side("src", config.source_resource, config.source_schema)
    target = side("tgt", config.target_resource, config.target_schema)
    return facts.select(
        *_FACT,
        sid.alias("statement_id"),
        F.concat(sid, F.lit("/"), target["tgt_column"]).alias("calculation_id"),
        *[c.alias(n) for n, c in {**source, **target}.items()],
    )


def prepare_facts(facts: DataFrame, config: LineageConfig = LineageConfig(), separator: str = "/") -> DataFrame:
    """Facts without resolved stars and with their ids, written once: publication reads them several times."""
    return cut_lineage(with_fact_ids(drop_resolved_stars(facts), config, separator))


def facts_to_edges(facts_with_ids: DataFrame) -> DataFrame:
    """(kind, source, target): flow through the statement, and the direct source-target pairs."""

    def edge(kind: str, source: str, target: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(source).alias("source"), F.col(target).alias("target"))

    edges = F.array(
        edge("column", "src_element", "calculation_id"),
        edge("column", "calculation_id", "tgt_element"),
        edge("dataset", "src_dataset", "statement_id"),
        edge("dataset", "statement_id", "tgt_dataset"),
        edge("direct_column", "src_element", "tgt_element"),
        edge("direct_dataset", "src_dataset", "tgt_dataset"),
    )
    return explode_rows(facts_with_ids, edges).distinct()


# ---------------------------------------------------------------- publication


def _source_rows(facts_with_ids: DataFrame) -> DataFrame:
    """(task, source_id) as often as facts name it."""
    return explode_rows(
        facts_with_ids,
        F.array(F.struct(F.col("src_source").alias("source_id")), F.struct(F.col("tgt_source").alias("source_id"))),
        ("task",),
    )


def known_sources(facts_with_ids: DataFrame) -> DataFrame:
    """(task, source_id): data sources that column facts of the script name."""
    return _source_rows(facts_with_ids).distinct()


def _top(identifier: Column) -> Column:
    """Resource and first part of the path; a source and every id below it have it in common."""
    return F.substring_index(identifier, "/", 2)


def _sources_by_top(sources: DataFrame) -> DataFrame:
    """(task, _top, _sources): a script's sources, a short array per first part of their paths."""
    keyed = sources.groupBy("task", _top(F.col("source_id")).alias("_top"))
    return keyed.agg(F.collect_set("source_id").alias("_sources"))


def _longest(raw_id: Column, sources: Column) -> Column:
    """The longest of ``sources`` that is ``raw_id`` or a prefix of it; of prefixes of one text the longest is the largest."""
    return F.array_max(F.filter(sources, lambda s: (raw_id == s) | F.startswith(raw_id, F.concat(s, F.lit("/")))))


def _under(raw_id: Column, source: Column) -> Column:
    """``raw_id`` with the connection of ``source`` in its place; unchanged without a source."""
    rest = F.substring(raw_id, F.char_length(source) + 1, F.char_length(raw_id))
    return F.coalesce(F.concat(N.connection_id(source), F.lit("_DS"), rest), raw_id)


def published_ids(ids: DataFrame, sources: DataFrame) -> DataFrame:
    """(task, raw_id, published_id): the longest prefix that is a known source becomes its connection.

    ``sources`` have a resource and a path, as ``known_sources`` gives them. An id meets the
    sources that share resource and first path part with it as one array, once, and finds its
    prefix within the row; nothing is exploded or grouped back.
    """
    met = ids.withColumn("_top", _top(F.col("raw_id"))).join(_sources_by_top(sources), ["task", "_top"], "left")
    published = _under(F.col("raw_id"), _longest(F.col("raw_id"), F.col("_sources")))
    return met.select("task", "raw_id", published.alias("published_id"))


def _nested_sources(sources: DataFrame) -> DataFrame:
    """(task, _nested): sources that lie below another source of the same script, where a script has any.

    In the order of their parts a source is followed by all that lie below it.
    """
    parts = F.transform("_sources", lambda s: F.struct(F.split(s, "/").alias("parts"), s.alias("id")))

    def step(state: Column, source: Column) -> Column:
        below = F.coalesce(F.startswith(source["id"], F.concat(state["root"], F.lit("/"))), F.lit(False))
        return F.struct(
            F.when(below, state["root"]).otherwise(source["id"]).alias("root"),
            F.when(below, F.concat(state["found"], F.array(source["id"]))).otherwise(state["found"]).alias("found"),
        )

    start = F.struct(F.lit(None).cast("string").alias("root"), F.array().cast("array<string>").alias("found"))
    found = F.aggregate(F.sort_array(parts), start, step, lambda state: state["found"])
    by_top = _sources_by_top(sources).where(F.size("_sources") > 1).select("task", F.explode(found).alias("id"))
    return by_top.groupBy("task").agg(F.collect_list("id").alias("_nested"))


def published_facts(facts_with_ids: DataFrame, sources: DataFrame) -> DataFrame:
    """Facts with ``*_parent_out``, ``*_dataset_out`` and ``*_element_out``, the published ids of both sides.

    A fact's own source is a known one, so only sources nested below another could be a
    longer prefix. Most scripts have none, and the table of them stays small enough for Spark
    to ship. Placeholders ``/*`` are not published.
    """
    met = facts_with_ids.join(_nested_sources(sources), "task", "left")
    nested = F.col("_nested")

    def side(prefix: str) -> dict[str, Column]:
        own, dataset, element = (F.col(f"{prefix}_{c}") for c in ("source", "dataset", "element"))

        def out(raw_id: Column) -> Column:
            return _under(raw_id, F.greatest(own, _longest(raw_id, nested)))

        itself = F.coalesce(F.array_contains(nested, element), F.lit(False))
        below = F.concat(out(dataset), F.lit("/"), F.col(f"{prefix}_column"))
        published = F.when(itself, F.concat(N.connection_id(element), F.lit("_DS"))).otherwise(below)
        return {
            f"{prefix}_parent_out": out(N.parent_id(dataset)),
            f"{prefix}_dataset_out": out(dataset),
            f"{prefix}_element_out": F.when(element.endswith("/*"), element).otherwise(published),
        }

    return met.select(*facts_with_ids.columns, *[c.alias(n) for p in ("src", "tgt") for n, c in side(p).items()])


def _dataset_rows(refs: DataFrame, facts_with_ids: DataFrame, config: LineageConfig) -> DataFrame:
    """(task, raw_id) of every dataset of usable statements and of column facts, as often as they name it."""
    usable = refs.where(F.col("state") == "usable").withColumnRenamed("file", "task")
    stated = F.concat(
        F.transform("sources", lambda s: _path(config.source_resource, s)),
        F.array(_path(config.target_resource, F.get("targets", 0))),
    )
    from_refs = usable.select("task", F.explode(stated).alias("raw_id"))
    from_facts = facts_with_ids.select("task", F.explode(F.array("src_dataset", "tgt_dataset")).alias("raw_id"))
    return from_refs.unionByName(from_facts)


def _dataset_ids(refs: DataFrame, facts_with_ids: DataFrame, config: LineageConfig) -> DataFrame:
    """(task, raw_id) of every dataset of usable statements and of column facts."""
    return _dataset_rows(refs, facts_with_ids, config).distinct()


def metadata_elements(
    refs: DataFrame, facts_with_ids: DataFrame, columns: DataFrame, config: LineageConfig = LineageConfig()
) -> DataFrame:
    """(task, dataset_id, column, raw_id): known (table, column) of the tables that a script names."""
    usable = refs.where(F.col("state") == "usable").withColumnRenamed("file", "task")

    def named(resource: str, table: Column) -> Column:
        return F.struct(table.alias("table"), _path(resource, table).alias("dataset_id"))

    stated = F.concat(
        F.transform("sources", lambda s: named(config.source_resource, s)),
        F.array(named(config.target_resource, F.get("targets", 0))),
    )
    of_facts = F.array(
        F.struct(F.col("src_table_name").alias("table"), F.col("src_dataset").alias("dataset_id")),
        F.struct(F.col("tgt_table_name").alias("table"), F.col("tgt_dataset").alias("dataset_id")),
    )
    tables = explode_rows(usable, stated, ("task",)).unionByName(explode_rows(facts_with_ids, of_facts, ("task",)))
    found = tables.distinct().join(columns.select("table", F.trim("column").alias("column")).distinct(), "table")
    raw_id = F.concat("dataset_id", F.lit("/"), "column").alias("raw_id")
    return found.select("task", "dataset_id", "column", raw_id).distinct()


def _published_elements(facts_with_ids: DataFrame, sources: DataFrame) -> DataFrame:
    """(published_id, column) of the columns that facts name, as often as they do; published within the facts' rows."""

    def element(side: str) -> Column:
        return F.struct(
            F.col(f"{side}_element").alias("raw_id"),
            F.col(f"{side}_element_out").alias("published_id"),
            F.col(f"{side}_column").alias("column"),
        )

    facts = published_facts(facts_with_ids, sources).where(F.col("task").isNotNull())
    named = explode_rows(facts, F.array(element("src"), element("tgt")))
    return named.where(~F.col("raw_id").endswith("/*")).select("published_id", "column")


def _published(datasets: DataFrame, elements: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(task, raw_id, published_id) of datasets with their parents, and of elements.

    Prefixes are only worked out for the few dataset ids. An element follows its
    dataset, unless the element's whole id is a known source itself.
    """
    parents = datasets.select("task", N.parent_id(F.col("raw_id")).alias("raw_id"))
    of_datasets = published_ids(datasets.unionByName(parents).distinct(), sources)
    by_dataset = of_datasets.select("task", F.col("raw_id").alias("dataset_id"), F.col("published_id").alias("_parent"))
    itself = sources.select("task", F.col("source_id").alias("raw_id"), F.lit(True).alias("_known"))
    own = F.concat(N.connection_id(F.col("raw_id")), F.lit("_DS"))
    of_elements = (
        elements.join(by_dataset, ["task", "dataset_id"])
        .join(itself, ["task", "raw_id"], "left")
        .select(
            "task",
            "dataset_id",
            "raw_id",
            "column",
            F.when(F.col("_known"), own).otherwise(F.concat("_parent", F.lit("/"), "column")).alias("published_id"),
        )
    )
    return of_datasets, of_elements


def script_columns(facts_with_ids: DataFrame) -> DataFrame:
    """(task, statement_id, calculation_id, column, ordinal, external_id).

    The ordinal is the position of the id among the script's sorted ids and counts ids
    that are not published themselves.
    """
    ids = facts_with_ids.select(
        "task", "statement_id", "calculation_id", F.col("tgt_column").alias("column")
    ).distinct()
    ranked = with_position(ids, ["task"], ["calculation_id"], "ordinal")
    published = ranked.where(~F.col("calculation_id").endswith("/*")).withColumn(
        "external_id",
        F.concat(
            F.lit("SQLSCRIPT_COLUMN_"),
            F.col("ordinal").cast("string"),
            F.lit("_"),
            N.sanitize_upper(F.col("calculation_id")),
        ),
    )
    # Assets and links both read these rows, links more than once.
    return cut_lineage(published)


def _parser_id(file: Column) -> Column:
    return F.concat(F.lit("SQLPARSER_"), N.sanitize_upper(file))


def _script_id(sid: Column) -> Column:
    return F.concat(F.lit("SQLSCRIPT_"), N.sanitize_upper(sid))


def usable_scripts(refs: DataFrame, config: LineageConfig) -> DataFrame:
    """(task, statement_id, name, sql, external_id) of the usable statements."""
    sid = statement_id(F.col("file"), F.col("stmt_no"), config)
    return refs.where(F.col("state") == "usable").select(
        F.col("file").alias("task"),
        sid.alias("statement_id"),
        F.concat(F.lit("statement_"), F.col("stmt_no").cast("string")).alias("name"),
        "sql",
        _script_id(sid).alias("external_id"),
    )


def script_assets(
    refs: DataFrame, columns: DataFrame, config: LineageConfig = LineageConfig()
) -> DataFrame:
    """Parser per file, script per usable statement, column per calculated column."""
    files = refs.select("file").distinct()
    parsers = files.select(
        asset(V.SQL_PARSER, _parser_id(F.col("file")), F.col("file"), "", "TRUE").alias("a")
    )
    scripts = usable_scripts(refs, config).select(
        asset(V.SQL_SCRIPT, F.col("external_id"), F.col("name"), "", "", **{V.SCRIPT_TEXT: F.col("sql")}).alias("a")
    )
    script_cols = columns.select(
        asset(V.SQL_SCRIPT_COLUMN, F.col("external_id"), F.col("column"), "", "").alias("a")
    )
    return union_all([parsers, scripts, script_cols]).select("a.*")


def referenced_resources(dataset_ids: DataFrame, config: LineageConfig = LineageConfig()) -> DataFrame:
    """Default resources that any dataset or data source uses, without the excluded one."""
    used = dataset_ids.select(F.substring_index("raw_id", "/", 1).alias("external_id")).distinct()
    wanted = used.where(F.col("external_id").isin(config.source_resource, config.target_resource))
    if config.excluded_resource is not None:
        wanted = wanted.where(F.col("external_id") != config.excluded_resource)
    return wanted.select(
        "external_id",
        N.transform_name(F.col("external_id")).alias("name"),
        F.lit("false").alias("reference"),
        F.lit("TRUE").alias("assignable"),
    )


def _source_label(source_id: Column) -> Column:
    return F.translate(N.leaf_name(source_id), "<>", "")


def script_reference_assets(
    refs: DataFrame,
    facts_with_ids: DataFrame,
    config: LineageConfig = LineageConfig(),
    more_elements: DataFrame | None = None,
) -> DataFrame:
    """Connections, data sources, data sets and elements under their published ids.

    ``more_elements`` are those that metadata adds to the ones of the facts.
    """
    # Written, as several parts read them; else each would move the data sets of all facts again.
    sources = cut_lineage(known_sources(facts_with_ids))
    datasets = cut_lineage(_dataset_ids(refs, facts_with_ids, config))
    columns = ["class", "external_id", "name", "reference", "assignable"]

    resources = referenced_resources(datasets, config).select(F.lit(V.RESOURCE).alias("class"), *columns[1:])
    connections = (
        sources.groupBy(N.connection_id(F.col("source_id")).alias("external_id"))
        .agg(F.min_by(_source_label(F.col("source_id")), F.col("source_id")).alias("name"))
        .select(
            F.lit(V.RESOURCE).alias("class"),
            "external_id",
            "name",
            F.lit("true").alias("reference"),
            F.lit("TRUE").alias("assignable"),
        )
    )
    if config.excluded_resource is not None:
        connections = connections.where(F.col("external_id") != config.excluded_resource)

    def reference_rows(df: DataFrame, cls: str, external_id: Column, name: Column) -> DataFrame:
        return df.select(
            F.lit(cls).alias("class"),
            external_id.alias("external_id"),
            name.alias("name"),
            F.lit("TRUE").alias("reference"),
            F.lit("TRUE").alias("assignable"),
        ).distinct()

    source_rows = reference_rows(
        sources,
        V.DATA_SOURCE,
        F.concat(N.connection_id(F.col("source_id")), F.lit("_DS")),
        _source_label(F.col("source_id")),
    )
    dataset_rows = reference_rows(
        published_ids(datasets, sources).where("task IS NOT NULL AND raw_id IS NOT NULL"),
        V.DATA_SET, F.col("published_id"), N.leaf_name(F.col("raw_id")),
    )
    of_elements = _published_elements(facts_with_ids, sources)
    if more_elements is not None:
        of_more = _published(datasets, more_elements, sources)[1]
        of_elements = of_elements.unionByName(of_more.select("published_id", "column"))
    element_rows = reference_rows(of_elements, V.DATA_ELEMENT, F.col("published_id"), F.col("column"))
    return union_all([resources, connections, source_rows, dataset_rows, element_rows])


def script_links(
    refs: DataFrame,
    facts_with_ids: DataFrame,
    columns: DataFrame,
    config: LineageConfig = LineageConfig(),
    more_elements: DataFrame | None = None,
) -> DataFrame:
    """Hierarchy and flow with every id replaced by the one it is published under, each link once."""
    return script_link_rows(kept_refs(refs), facts_with_ids, columns, config, more_elements).distinct()


def script_link_rows(
    refs: DataFrame,
    facts_with_ids: DataFrame,
    columns: DataFrame,
    config: LineageConfig = LineageConfig(),
    more_elements: DataFrame | None = None,
) -> DataFrame:
    """The links of ``script_links``, repeated as often as statements and facts state them.

    ``facts_with_ids`` should come from ``prepare_facts`` and ``refs`` from ``kept_refs``. Ids are published
    within the rows of statements and facts; a fact meets one other row, that of its column with the
    column's and the script's ids. Links of all kinds are left to meet one distinct or grouping.
    """
    sources = cut_lineage(known_sources(facts_with_ids))
    scripts = usable_scripts(refs, config).select("task", "statement_id", "external_id")

    # Statements: each of their data sets with its parent, and its flow into or out of the script.
    def stated(resource: str, table: Column, is_target: bool) -> Column:
        return F.struct(_path(resource, table).alias("raw_id"), F.lit(is_target).alias("is_target"))

    named = F.concat(
        F.transform("sources", lambda s: stated(config.source_resource, s, False)),
        F.array(stated(config.target_resource, F.get("targets", 0), True)),
    )
    script_id = _script_id(statement_id(F.col("file"), F.col("stmt_no"), config))
    usable = refs.where(F.col("state") == "usable").select(F.col("file").alias("task"), script_id.alias("script"), named.alias("named"))
    met = (
        explode_rows(usable, F.col("named"), ("task", "script"))
        .withColumn("_top", _top(F.col("raw_id")))
        .join(_sources_by_top(sources), ["task", "_top"], "left")
    )
    raw, parent = F.col("raw_id"), N.parent_id(F.col("raw_id"))
    out = _under(raw, _longest(raw, F.col("_sources")))
    held_by = _under(parent, _longest(parent, F.col("_sources")))
    flow = F.struct(
        F.when(F.col("is_target"), F.col("script")).otherwise(out).alias("source"),
        F.when(F.col("is_target"), out).otherwise(F.col("script")).alias("target"),
        F.lit(V.DATASET_FLOW).alias("association"),
    )
    of_statements = explode_rows(met, F.array(link(held_by, out, V.DATASOURCE_PARENT_CHILD), flow).cast(LINK_TYPE))

    # Facts: statements without a script keep their raw id, as do calculations without a column.
    of_script = scripts.select("statement_id", F.col("external_id").alias("script"))
    known = columns.select("task", "statement_id", "calculation_id", F.col("external_id").alias("calculation"))
    known = known.join(of_script, "statement_id", "left")
    facts = published_facts(facts_with_ids, sources)
    placeholder = F.coalesce(F.col("calculation_id").endswith("/*"), F.lit(False))
    with_column = facts.where(~placeholder).join(known.drop("statement_id"), ["task", "calculation_id"], "left")
    without = facts.where(placeholder).join(of_script, "statement_id", "left").withColumn("calculation", F.lit(None).cast("string"))
    calculation = F.coalesce("calculation", "calculation_id")
    script = F.coalesce("script", "statement_id")

    def element(side: str) -> Column:
        """Of a placeholder ``/*`` no element is held."""
        held = link(F.col(f"{side}_dataset_out"), F.col(f"{side}_element_out"), V.DATASET_ELEMENT)
        return F.when(~F.coalesce(F.col(f"{side}_element").endswith("/*"), F.lit(False)), held)

    of_fact = F.array(
        link(F.col("src_parent_out"), F.col("src_dataset_out"), V.DATASOURCE_PARENT_CHILD),
        link(F.col("tgt_parent_out"), F.col("tgt_dataset_out"), V.DATASOURCE_PARENT_CHILD),
        element("src"),
        element("tgt"),
        link(F.col("src_element_out"), calculation, V.COLUMN_FLOW),
        link(calculation, F.col("tgt_element_out"), V.COLUMN_FLOW),
        link(F.col("src_dataset_out"), script, V.DATASET_FLOW),
        link(script, F.col("tgt_dataset_out"), V.DATASET_FLOW),
    )
    of_facts = explode_rows(with_column.unionByName(without), of_fact)

    files = refs.select("file").distinct()
    root = files.select(link(F.lit(V.ROOT_UPPER), _parser_id(F.col("file")), V.RESOURCE_PARENT_CHILD).alias("l"))
    parser_links = scripts.select(link(_parser_id(F.col("task")), F.col("external_id"), V.PARSER_TO_SCRIPT).alias("l"))
    column_links = known.where("script IS NOT NULL").select(link(F.col("script"), F.col("calculation"), V.SCRIPT_TO_COLUMN).alias("l"))
    own = union_all([root, parser_links, column_links]).select("l.*")
    parts = [of_statements, of_facts, own, _connection_links(sources, config)]
    if more_elements is not None:
        named_by_metadata = more_elements.select("task", F.col("dataset_id").alias("raw_id")).distinct()
        of_datasets, of_elements = _published(named_by_metadata, more_elements, sources)
        held = of_elements.join(
            of_datasets.select("task", F.col("raw_id").alias("dataset_id"), F.col("published_id").alias("_dataset")),
            ["task", "dataset_id"],
        )
        parts.append(held.select(link(F.col("_dataset"), F.col("published_id"), V.DATASET_ELEMENT).alias("l")).select("l.*"))
    return union_all(parts)


def _connection_links(sources: DataFrame, config: LineageConfig) -> DataFrame:
    """Connections to their sources, without the excluded connection, which is no asset."""
    connection = N.connection_id(F.col("source_id"))
    wanted = sources if config.excluded_resource is None else sources.where(connection != config.excluded_resource)
    return wanted.select(
        link(connection, F.concat(connection, F.lit("_DS")), V.RESOURCE_PARENT_CHILD).alias("l")
    ).select("l.*")


#: Root links come first: those to resources, then those to sources, each with the default
#: connection last and the others by descending id; all other links follow in the usual order.
ROOT_ORDER = ("part", "is_default", "-place", "association", "source", "target")


def placed_root_links(
    refs: DataFrame, facts_with_ids: DataFrame, config: LineageConfig = LineageConfig()
) -> DataFrame:
    """Root to every resource and connections to their sources, with the columns that ``ROOT_ORDER`` sorts by."""
    # Only few resources and connections come of all ids, so these are not made distinct by script first.
    sources = _source_rows(facts_with_ids)
    resources = referenced_resources(_dataset_rows(refs, facts_with_ids, config), config).select("external_id")
    connections = sources.select(N.connection_id(F.col("source_id")).alias("external_id")).distinct()
    if config.excluded_resource is not None:
        connections = connections.where(F.col("external_id") != config.excluded_resource)
    top = resources.unionByName(connections).distinct().where(~F.col("external_id").isin(V.ROOT_LOWER, config.script_database))
    top_links = top.select(
        link(F.lit(V.ROOT_UPPER), F.col("external_id"), V.RESOURCE_PARENT_CHILD).alias("l"),
        F.lit(0).alias("part"),
        F.col("external_id").alias("place"),
    )
    own_links = _connection_links(sources, config).distinct().select(
        F.struct("source", "target", "association").alias("l"), F.lit(1).alias("part"), F.col("source").alias("place")
    )
    combined = top_links.unionByName(own_links)
    return combined.select("l.*", "part", (F.col("place") == "REFERENCE_DEFAULT_CONN").alias("is_default"), "place")


def root_links(
    refs: DataFrame, facts_with_ids: DataFrame, config: LineageConfig = LineageConfig()
) -> DataFrame:
    """Root to every resource, ids descending and the default connection last; then resource to source, alike."""
    placed = placed_root_links(kept_refs(refs), facts_with_ids, config)
    return placed.orderBy(*sort_columns(ROOT_ORDER)).select("source", "target", "association")


def ordered_script_links(root: DataFrame, links: DataFrame) -> DataFrame:
    """Each link of both once, with the columns that ``ROOT_ORDER`` sorts by; ``root`` comes from ``placed_root_links``.

    ``links`` may be repeated: this grouping is the one place where they meet. It only has to carry the part of a root
    link, from which its place follows: the resource of the first part, the connection of the second.
    """
    tagged = root.select("source", "target", "association", "part").unionByName(
        links.select("source", "target", "association", F.lit(None).cast("int").alias("part"))
    )
    # At most one of a link's parts is given.
    once = tagged.groupBy("source", "target", "association").agg(F.max("part").alias("part"))
    place = F.when(F.col("part") == 0, F.col("target")).when(F.col("part") == 1, F.col("source"))
    return once.select(
        "source", "target", "association", "part", (place == "REFERENCE_DEFAULT_CONN").alias("is_default"), place.alias("place")
    )


# ---------------------------------------------------------------- job-hierarchy export


def script_job_links(
    refs: DataFrame, facts_dotted: DataFrame, config: LineageConfig = LineageConfig()
) -> DataFrame:
    """The same statements and facts as database -> schema -> task -> statement -> calculation.

    ``facts_dotted`` comes from ``with_fact_ids(..., separator=".")``.
    """
    src, tgt = config.source_resource, config.target_resource
    schema_id = F.lit(config.script_path)
    fixed_links = F.array(
        link(F.lit(V.ROOT_LOWER), F.lit(src), V.RESOURCE_PARENT_CHILD),
        link(F.lit(V.ROOT_LOWER), F.lit(tgt), V.RESOURCE_PARENT_CHILD),
        link(F.lit(V.ROOT_LOWER), F.lit(config.script_database), V.RESOURCE_PARENT_CHILD),
        link(F.lit(src), F.lit(f"{src}.{config.source_schema}"), V.RESOURCE_PARENT_CHILD),
        link(F.lit(tgt), F.lit(f"{tgt}.{config.target_schema}"), V.RESOURCE_PARENT_CHILD),
        link(F.lit(config.script_database), schema_id, V.DATABASE_TO_SCHEMA),
    )
    own_task = F.array(link(schema_id, task_id(F.col("file"), config), V.SCHEMA_TO_TASK))
    per_file = explode_rows(refs, F.concat(fixed_links, own_task))

    sid = statement_id(F.col("file"), F.col("stmt_no"), config)
    usable = refs.where(F.col("state") == "usable")
    datasets = F.concat(
        F.transform("sources", lambda s: _path(src, s, ".")), F.array(_path(tgt, F.get("targets", 0), "."))
    )
    per_statement = explode_rows(
        usable,
        F.concat(
            F.array(link(task_id(F.col("file"), config), sid, V.TASK_TO_STATEMENT)),
            F.transform(datasets, lambda d: link(N.parent_id(d), d, V.DATASOURCE_PARENT_CHILD)),
            _dataset_edges(config, "."),
        ),
    )
    per_fact = explode_rows(
        facts_dotted,
        F.array(
            link(F.lit(src), F.col("src_source"), V.RESOURCE_PARENT_CHILD),
            link(F.lit(tgt), F.col("tgt_source"), V.RESOURCE_PARENT_CHILD),
            link(F.col("src_source"), F.col("src_dataset"), V.DATASOURCE_PARENT_CHILD),
            link(F.col("tgt_source"), F.col("tgt_dataset"), V.DATASOURCE_PARENT_CHILD),
            link(F.col("src_dataset"), F.col("src_element"), V.DATASET_ELEMENT),
            link(F.col("tgt_dataset"), F.col("tgt_element"), V.DATASET_ELEMENT),
            link(F.col("statement_id"), F.col("calculation_id"), V.STATEMENT_TO_CALCULATION),
            link(F.col("src_element"), F.col("calculation_id"), V.COLUMN_FLOW),
            link(F.col("calculation_id"), F.col("tgt_element"), V.COLUMN_FLOW),
        ),
    )
    return union_all([per_file, per_statement, per_fact]).distinct()


def script_stats(refs: DataFrame, facts: DataFrame, assets: DataFrame) -> DataFrame:
    """(metric, value): statements by state, statements with column facts, asset rows per class."""
    by_state = refs.groupBy(F.concat(F.lit("statements "), F.col("state")).alias("metric")).agg(
        F.count("*").alias("value")
    )
    with_facts = facts.select("task", "stmt_no").distinct().agg(F.count("*").alias("value")).select(
        F.lit("statements with column lineage").alias("metric"), "value"
    )
    per_class = assets.groupBy(F.concat(F.lit("rows "), F.col("class")).alias("metric")).agg(F.count("*").alias("value"))
    return union_all([by_state, with_facts, per_class])
