"""Report layouts: one layout per customer, a section per order status, a visual container per order."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.adapters.tables import table, tasks
from lineweft.functions.rows import let, parse_once


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _quoted(json: Column) -> Column:
    """JSON text as a JSON string."""
    return let(
        F.to_json(F.struct(json.alias("v"))), lambda wrapped: F.substring(wrapped, F.lit(6), F.char_length(wrapped) - 6)
    )


def report_name(key: Column, nation: Column) -> Column:
    return _text("Sales & Stock #", key, " (v", nation, ")")


def _entity(name: Column | str) -> Column:
    return _text('{"SourceRef":{"Entity":"', name, '"}}')


def _select_items(key: Column, order_status: Column) -> Column:
    orders = _text("orders vw ", order_status)
    total = _text(
        '{"displayName":"Total Price","queryName":"Sum(orders.o_totalprice)","expr":{"Aggregation":{"Expression":'
        '{"Column":{"Expression":', _entity(orders), ',"Property":"o_totalprice"}},"Function":0}}}'
    )
    # Every fifth order nests the same column twenty levels deeper.
    deep = _text(
        '{"displayName":"Total Price","queryName":"Sum(orders.o_totalprice)","expr":{"Aggregation":{"Expression":',
        '{"Layer":{"Expression":' * 20, '{"Column":{"Expression":', _entity(orders), ',"Property":"o_totalprice"}}', "}}" * 20,
        ',"Function":0}}}',
    )
    total = F.when(key % 5 == 0, deep).otherwise(total)
    kind = F.when(key % 4 == 0, F.lit("Measure")).otherwise(F.lit("Column"))
    items = [
        total,
        _text('{"queryName":"orders.key ', key % 10, '","expr":{"', kind, '":{"Expression":', _entity(orders),
              ',"Property":"o_key ', key % 10, '"}}}'),
        _text('{"displayName":"ref only","queryRef":"x"}'),
        _text('{"displayName":"  ","queryName":"","expr":{"Column":{"Expression":', _entity(orders), ',"Property":"p"}}}'),
        _text('{"displayName":"Rows","queryName":"CountNonNull","expr":{"CountRows":{"Expression":',
              _entity(_text("dim-", key % 3)), "}}}"),
        _text('{"displayName":"Month","queryName":"date.month","expr":{"HierarchyLevel":{"Expression":{"Hierarchy":'
              '{"Expression":', _entity(orders), ',"Hierarchy":"Date"}},"Level":"M"}}}'),
        F.when(key % 2 == 0, total),
        F.lit('{"displayName":"Const","queryName":"c","expr":{"Literal":{"Value":"1"}}}'),
        _text('{"displayName":"Margin","queryName":"m.margin","expr":{"Measure":{"Expression":', _entity("Owned_Table"),
              ',"Property":"Margin %"}}}'),
    ]
    return _text('{"selects":[', F.array_join(F.array_compact(F.array(*items)), ","), "]}")


def _query(key: Column, order_status: Column) -> Column:
    source = lambda alias: '{"SourceRef":{"Source":"' + alias + '"}}'
    return _text(
        '{"From":[{"Name":"o","Entity":"orders vw ', order_status, '"},{"Name":"d","Entity":"dim-', key % 3,
        '"}],"Select":[{"Column":{"Expression":', source("o"), ',"Property":"o_totalprice"},"Name":"orders.total"},'
        '{"Aggregation":{"Expression":{"Column":{"Expression":', source("d"), ',"Property":"qty"}}},"Name":"Sum(dim.qty)"},'
        '{"Column":{"Expression":', source("zz"), ',"Property":"lost"},"Name":"lost.alias"},'
        '{"Measure":{"Expression":', source("o"), ',"Property":"m"}},'
        '{"Column":{"Expression":{},"Property":"x"},"Name":"nosrc"}]}'
    )


def _container(key: Column, order_status: Column, priority: Column) -> Column:
    kind = F.when(key % 3 == 0, F.lit("card")).when(key % 3 == 1, F.lit("table")).otherwise(F.lit("pivotTable"))
    query = F.when(priority == "3-MEDIUM", _query(key, order_status)).otherwise(F.lit('{"From":[],"Select":[]}'))
    # The query itself is once more JSON inside a string for every second order.
    query = F.when(key % 2 == 0, _quoted(query)).otherwise(query)
    full = _text('{"singleVisual":{"visualType":"', kind, '","prototypeQuery":', query, "}}")
    config = (
        F.when(priority == "5-LOW", F.lit('{"singleVisual":{"visualType":"image"}}'))
        .when(priority == "4-NOT SPECIFIED", F.lit("plain text"))
        .otherwise(full)
    )
    transforms = F.when(priority == "1-URGENT", _text(',"dataTransforms":', _quoted(_select_items(key, order_status)))).when(
        priority == "2-HIGH", _text(',"dataTransforms":', _select_items(key, order_status))
    )
    return _text('{"x":1,"config":', _quoted(config), F.coalesce(transforms, F.lit("")), "}")


def layout_docs(spark: SparkSession, folder: str) -> DataFrame:
    """(report_name, layout_json) of every customer.

    Customers meet the keys of their orders, and the text of a layout is written in its own row
    afterwards, so no shuffle or join holds texts.
    """
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    sections = orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.collect_list(F.struct("o_orderkey", "o_orderpriority")).alias("orders")
    )
    layouts = sections.groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderstatus", "orders")).alias("s"))
    customers = table(spark, folder, "customer", F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    # The planner takes the arrays for as short as one order, so it would send whole tables of them to the driver.
    joined = customers.join(layouts.hint("merge"), "o_custkey", "left")
    # Writing layouts is heavy on few bytes, so the size-based coalescing must not join these tasks.
    spread = joined.repartition(tasks(spark), "o_custkey")

    def section(order_status: Column, of_section: Column) -> Column:
        containers = F.transform(
            of_section,
            lambda o: F.struct(
                o["o_orderkey"].alias("o_orderkey"),
                _container(o["o_orderkey"], order_status, o["o_orderpriority"]).alias("container"),
            ),
        )
        return F.struct(
            order_status.alias("o_orderstatus"),
            _text(
                '{"name":"Section', order_status, '","displayName":"Status ', order_status, '","visualContainers":[',
                F.array_join(F.transform(F.sort_array(containers), lambda c: c["container"]), ","), "]}",
            ).alias("json"),
        )

    sections = F.sort_array(F.transform("s", lambda x: section(x["o_orderstatus"], x["orders"])))
    texts = F.transform(F.coalesce(sections, F.array()), lambda x: x["json"])
    return parse_once(
        spread, _text('{"id":0,"sections":[', F.array_join(texts, ","), "]}"), "layout_json"
    ).select(report_name(F.col("o_custkey"), F.col("c_nationkey")).alias("report_name"), "layout_json")


def report_containers(spark: SparkSession, folder: str) -> DataFrame:
    """(report_name, content): the layouts zipped; names that hold "(v3)" get a file without a layout."""
    return layout_docs(spark, folder).mapInPandas(_zip, "report_name string, content binary")


def _zip(batches: Iterator) -> Iterator:
    import io
    import zipfile

    import pandas as pd

    def packed(name: str, text: str) -> bytes:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("Version", "1.0")
            if "(v3)" not in name:
                archive.writestr("Report/Layout", text.encode("utf-16-le"))
        return buffer.getvalue()

    for batch in batches:
        content = [packed(n, t) for n, t in zip(batch["report_name"], batch["layout_json"])]
        yield pd.DataFrame({"report_name": batch["report_name"], "content": content})


def expected_fields(spark: SparkSession, folder: str) -> DataFrame:
    """(table, field, field_type) that a catalogue expects, derived from customers' keys and segments."""
    customers = table(spark, folder, "customer", "c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    name = F.when(k % 4 == 3, _text("model only ", k % 5)).otherwise(
        _text("orders vw ", F.substring(F.lit("FOP"), k.cast("int") % 3 + 1, 1))
    )
    field = F.when(k % 7 == 0, F.lit("o_totalprice")).otherwise(_text("o_key ", k % 12))
    kind = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Measure")).otherwise(F.lit("Source Column"))
    return customers.groupBy(name.alias("table"), field.alias("field")).agg(F.min(kind).alias("field_type"))


def expected_places(spark: SparkSession, folder: str) -> DataFrame:
    """(page, visual_type, table, field, field_type) that a catalogue expects on pages, some of them nowhere, derived from orders."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    k = F.col("o_orderkey")
    rows = orders.where(F.col("o_orderpriority").isin("1-URGENT", "4-NOT SPECIFIED")).select(
        F.when(k % 60 == 0, F.lit("Archive")).otherwise(_text("Status ", F.col("o_orderstatus"))).alias("page"),
        F.when(k % 7 == 0, F.lit("slicer")).when(k % 3 == 0, F.lit("card")).when(k % 3 == 1, F.lit("table")).alias("visual_type"),
        F.when(k % 11 == 0, F.lit("model only")).otherwise(_text("orders vw ", F.col("o_orderstatus"))).alias("table"),
        F.when(k % 5 == 0, F.lit("o_totalprice")).otherwise(_text("o_key ", k % 12)).alias("field"),
        F.when(k % 2 == 0, F.lit("Measure")).otherwise(F.lit("Source Column")).alias("field_type"),
    )
    return rows.groupBy("page", "visual_type", "table", "field").agg(F.min("field_type").alias("field_type"))
