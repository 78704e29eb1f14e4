"""From a corpus to its graph of assets and links, and from a graph to its files.

Each frame of a graph is one pass over the corpus and stays lazy until it is written, but for
scripts, whose facts and ids are tables that are written on the way.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.config import LineageConfig
from lineweft.operators import calcviews, diagnostics, events, reports, scripts
from lineweft.operators import metadata as enrichment
from lineweft.session import cut_lineage
from lineweft.sinks import export
from lineweft.sources.calcviews import parse_calcviews, read_calcviews
from lineweft.sources.events import line_numbers, parse_events, scan_event_lines
from lineweft.sources.reports import read_report_layouts
from lineweft.sources.scripts import read_scripts

_NO_ATTRS = "array<struct<key:string,value:string>>"


@dataclass(frozen=True)
class Graph:
    """Assets and links of a corpus; ``reports`` are side tables such as problems or unparsed statements.

    ``link_order`` is the order of the links' export, by columns that ``links`` may have besides its own.
    """

    assets: DataFrame
    links: DataFrame
    layouts: dict[str, export.Layout]
    reports: dict[str, DataFrame] = field(default_factory=dict)
    quote_links: bool = False
    link_order: tuple[str, ...] = export.LINK_ORDER


def event_graph(spark: SparkSession, path: str, config: LineageConfig = LineageConfig()) -> Graph:
    """Events of the files in ``path``; only problems meet the count of lines that numbers them."""
    graph = event_graph_of(scan_event_lines(spark, path), config)
    return replace(graph, reports=graph.reports | {"problems": line_numbers(graph.reports["problems"], spark, path)})


def event_graph_of(lines: DataFrame, config: LineageConfig = LineageConfig()) -> Graph:
    """The same from an own (file, line_number, value) or (file, at, value) table."""
    parsed = parse_events(lines, config)
    derived = events.derive(parsed, config)
    side = {"problems": diagnostics.event_problems(parsed), "summary": diagnostics.file_summary(parsed)}
    return Graph(events.event_assets(derived), events.event_links(derived), export.EVENT_LAYOUTS, side)


def script_graph(
    spark: SparkSession,
    path: str,
    facts: DataFrame,
    config: LineageConfig = LineageConfig(),
    metadata: DataFrame | None = None,
) -> Graph:
    """Scripts in ``path`` with their column facts (task, stmt_no, src_*, tgt_*)."""
    return script_graph_of(read_scripts(spark, path), facts, config, metadata)


def script_graph_of(
    files: DataFrame,
    facts: DataFrame,
    config: LineageConfig = LineageConfig(),
    metadata: DataFrame | None = None,
) -> Graph:
    """The graph of scripts; with ``metadata`` (table, column) also the columns it states.

    Those meet the columns of the facts, whose spelling comes first, and grow along star
    facts until no table gains a column. Facts, star rounds and ids are written tables, so
    some jobs run while this graph is put together.
    """
    refs = scripts.table_refs(scripts.statements(files), config)
    known = scripts.prepare_facts(facts, config)
    columns = scripts.script_columns(known)
    more = None
    if metadata is not None:
        stated = enrichment.merge_metadata([enrichment.derived_metadata(known), metadata])
        grown = enrichment.star_fixpoint(stated.select("table", "column"), enrichment.star_edges(facts))
        more = cut_lineage(scripts.metadata_elements(refs, known, grown, config))
    reference = scripts.script_reference_assets(refs, known, config, more).withColumn("attrs", F.array().cast(_NO_ATTRS))
    assets = scripts.script_assets(refs, columns, config).unionByName(reference)
    kept = scripts.kept_refs(refs)
    root = scripts.placed_root_links(kept, known, config)
    links = scripts.ordered_script_links(root, scripts.script_link_rows(kept, known, columns, config, more))
    side = {
        "unparsed": scripts.unparsed_sql(refs, config),
        "stats": scripts.script_stats(refs, facts, assets.select("class")),
    }
    return Graph(assets, links, export.SCRIPT_LAYOUTS, side, link_order=scripts.ROOT_ORDER)


def view_graph(spark: SparkSession, path: str) -> Graph:
    return view_graph_of(read_calcviews(spark, path))


def view_graph_of(documents: DataFrame) -> Graph:
    views = calcviews.derive(parse_calcviews(documents))
    assets = calcviews.view_assets(views).unionByName(calcviews.view_reference_assets(views))
    return Graph(
        assets, calcviews.view_links(views), export.VIEW_LAYOUTS, {"stats": calcviews.view_stats(views)}
    )


def package_graph(spark: SparkSession, path: str, config: LineageConfig = LineageConfig()) -> Graph:
    return package_graph_of(read_calcviews(spark, path), config)


def package_graph_of(documents: DataFrame, config: LineageConfig = LineageConfig()) -> Graph:
    """The package-grouped model, where the first file of a repeated view id counts."""
    views = calcviews.dedupe_views(calcviews.derive(parse_calcviews(documents)))
    return Graph(
        calcviews.package_assets(views),
        calcviews.package_links(views, config.view_root_resource),
        export.PACKAGE_LAYOUTS,
        quote_links=True,
    )


def report_graph(
    spark: SparkSession, path: str, config: LineageConfig = LineageConfig(), distinct: bool = False
) -> Graph:
    layouts = read_report_layouts(spark, path)
    graph = report_graph_of(layouts, config, distinct)
    errors = layouts.where(F.col("error").isNotNull()).select("report_name", "error")
    return Graph(graph.assets, graph.links, graph.layouts, {"errors": errors})


def report_graph_of(
    layouts: DataFrame, config: LineageConfig = LineageConfig(), distinct: bool = False
) -> Graph:
    derived = reports.derive(reports.parse_layouts(layouts), config)
    assets = reports.catalog_assets(derived, config)
    return Graph(assets.distinct() if distinct else assets, reports.report_links(derived, distinct), export.REPORT_LAYOUTS)


def write_graph(graph: Graph, path: str, mode: str = "overwrite") -> None:
    """One CSV directory per class, the links, and the side tables next to them."""
    export.write_assets(graph.assets, graph.layouts, path, mode)
    export.write_links(graph.links, path, mode, graph.quote_links, graph.link_order)
    for name, table in graph.reports.items():
        if name == "unparsed":
            export.write_unparsed(table, f"{path}_side", mode)
        else:
            table.write.mode(mode).option("header", True).csv(f"{path}_side/{name}")
