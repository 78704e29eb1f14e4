"""Run-event documents: one JSON event per order, inputs from its line items."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.adapters.tables import table, tasks
from lineweft.functions.rows import parse_once


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    # Keys are dealt out once: line items are grouped and joined, and documents written, where they then lie.
    # Writing documents is heavy on few bytes, so the size-based coalescing must not join these tasks.
    dealt = tasks(spark)
    lines = (
        table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
        .withColumnRenamed("l_orderkey", "o_orderkey")
        .repartition(dealt, "o_orderkey")
        .groupBy("o_orderkey")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        F.col("l_linenumber").alias("n"),
                        F.col("l_partkey").alias("p"),
                        F.col("l_suppkey").alias("s"),
                        F.col("l_returnflag").alias("rf"),
                        F.col("l_linestatus").alias("ls"),
                    )
                )
            ).alias("lines")
        )
    )
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    customers = table(spark, folder, "customer", F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    return orders.join(customers, "o_custkey").repartition(dealt, "o_orderkey").join(lines, "o_orderkey", "left")


def _json(value: dict | list) -> str:
    return json.dumps(value, separators=(",", ":"))


def _object(*members: Column) -> Column:
    """JSON of an object from the texts of its members; a null one is left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _array(elements: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(elements, ","), F.lit("]"))


def _member(name: str, text: str | Column) -> Column:
    return F.concat(F.lit(f"{_json(name)}:"), F.lit(text) if isinstance(text, str) else text)


def _plain(name: str, text: Column) -> Column:
    """A member whose text holds nothing that JSON escapes."""
    return F.concat(F.lit(f'{_json(name)}:"'), text, F.lit('"'))


def _name(text: Column) -> Column:
    inside = F.to_json(F.struct(text.alias("name")))
    return F.when(text.isNotNull(), F.substring(inside, F.lit(2), F.char_length(inside) - 2))


def _line_namespace(line: Column) -> Column:
    return F.when(line["s"] % 11 == 0, F.lit("")).otherwise(
        F.concat(F.lit("db://host-"), (line["s"] % 7).cast("string"), F.lit(".x:5432"))
    )


def _line_name(line: Column) -> Column:
    part = F.concat(F.lit("part_"), (line["p"] % 50).cast("string"))
    return (
        F.when(line["n"] % 3 == 0, F.concat(F.lit("erp."), part))
        .when(line["n"] % 3 == 1, F.concat(F.lit("/landing.v1/"), part))
        .otherwise(part)
    )


def _line_schema(brand: str, returned: bool) -> str:
    detail: list[dict] = [{"name": "size"}, {"name": "retail"}]
    if returned:
        detail.append({"name": "when", "fields": [{"name": "time_stamp"}, {"name": "zone"}]})
    fields = [{"name": "partkey"}, {"name": brand}, {"name": "Time-Stamp"}, {"name": "detail", "fields": detail}]
    return _json({"schema": {"fields": fields}})


def _input(line: Column) -> Column:
    def of_brand(brand: str) -> Column:
        return F.when(line["rf"] == "R", F.lit(_line_schema(brand, True))).otherwise(F.lit(_line_schema(brand, False)))

    schema = F.when(line["ls"] == "O", of_brand('"brand"')).otherwise(of_brand("brand"))
    facets = F.when(~((line["rf"] == "N") & (line["ls"] == "F")), _member("facets", schema))
    return _object(_plain("namespace", _line_namespace(line)), _plain("name", _line_name(line)), facets)


#: Stands for a field's name in the text of the line items that feed it; nothing else there has this sign.
_FIELD = "@"


def _feeding(line: Column) -> Column:
    """A line item as an input field of a column, whose own name is left open."""
    transformations = (
        F.when(line["rf"] == "R", F.lit(_json([{"type": "direct"}])))
        .when(line["rf"] == "A", F.lit(_json([{"type": "INDIRECT"}])))
        .otherwise(F.lit("[]"))
    )
    return _object(
        _plain("namespace", _line_namespace(line)),
        _plain("name", _line_name(line)),
        F.lit(f'"field":{_json(_FIELD)}'),
        _member("transformations", transformations),
    )


def _lineage(feeding: Column) -> Column:
    def fed_by(field: str) -> Column:
        return F.replace(feeding, F.lit(_FIELD), F.lit(field))

    targets = {
        "partkey": fed_by("partkey"),
        "'retail'": fed_by("detail"),
        "loadDateTime": fed_by("detail"),
        "summary": fed_by("detail"),
        "brand name": fed_by("brand"),
        "updated": fed_by("`Time-Stamp`"),
        "orphan": F.lit("[]"),
    }
    return _object(_member("fields", _object(*[_member(t, _object(_member("inputFields", f))) for t, f in targets.items()])))


def _outputs(feeding: Column) -> Column:
    key = F.col("o_orderkey")
    segment = F.lower("c_mktsegment")
    fields = [{"name": n} for n in ("partkey", "`retail`", "loadDateTime", "summary", "brand name")]
    lineage = F.when(key % 7 != 0, _member("columnLineage", _lineage(feeding)))
    facets = _object(F.lit(f'"schema":{_json({"fields": fields})}'), lineage)
    main = _object(
        F.lit('"namespace":"s3://lake-house"'), _name(F.concat(F.lit("curated/"), segment)), _member("facets", facets)
    )
    audit = _object(F.lit('"namespace":""'), _name(F.concat(F.lit("audit."), segment)))
    return (
        F.when((F.col("o_orderstatus") == "P") & (key % 2 == 0), F.lit("[]"))
        .when(F.col("o_orderstatus") == "P", F.lit(None))
        .when(key % 5 == 0, F.concat(F.lit("["), main, F.lit(","), audit, F.lit("]")))
        .otherwise(F.concat(F.lit("["), main, F.lit("]")))
    )


def _head() -> Column:
    key = F.col("o_orderkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    app = F.concat(F.lit("etl app/"), (F.col("c_nationkey") % 5).cast("string"))
    spark_properties = F.when(key % 13 != 0, F.struct(F.struct(app.alias("spark.app.name")).alias("properties")))
    job = F.struct(
        F.when(key % 17 != 0, F.concat(F.lit("ns."), F.lower(F.left("c_mktsegment", F.lit(4))))).alias("namespace"),
        F.when(priority != "4-NOT SPECIFIED", F.concat(F.lit("load_"), F.lower("c_mktsegment"))).alias("name"),
        F.struct(
            F.when(priority != "5-LOW", F.struct(F.lit("SQL_JOB").alias("jobType"))).alias("jobType"),
            F.when(
                status == "F",
                F.struct(F.concat(F.lit("insert into t"), (key % 50).cast("string")).alias("query")),
            ).alias("sql"),
        ).alias("facets"),
    )
    return F.struct(
        F.lit("COMPLETE").alias("eventType"),
        F.struct(
            F.concat(F.lit("run-"), key.cast("string")).alias("runId"),
            F.struct(spark_properties.alias("spark_properties")).alias("facets"),
        ).alias("run"),
        F.when(key % 31 != 0, job).alias("job"),
    )


def _with_event(orders: DataFrame) -> DataFrame:
    """Adds ``_text``, an order's event; what repeats in it by line item and field is put together as text."""
    lines = F.coalesce(F.col("lines"), F.array())
    parts = parse_once(orders, F.to_json(_head()), "_head")
    parts = parse_once(parts, _array(F.transform(lines, _feeding)), "_feeding")
    stated = ~((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 19 == 0))
    inputs = F.when(stated, _member("inputs", _array(F.transform(lines, _input))))
    head = F.substring("_head", F.lit(2), F.char_length("_head") - 2)
    event = _object(head, inputs, _member("outputs", _outputs(F.col("_feeding"))))
    return parse_once(parts, event, "_text").drop("_head", "_feeding")


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(file, line_number, value): one line per order; the file is the customer's."""
    text = F.col("_text")
    return _with_event(_orders(spark, folder)).select(
        F.concat(F.lit("runs_"), F.col("o_custkey").cast("string"), F.lit(".ndjson")).alias("file"),
        (F.col("o_orderkey") + 1).alias("line_number"),
        F.when(F.col("o_orderkey") % 97 == 0, F.left(text, F.char_length(text) - 7)).otherwise(text).alias("value"),
    )


def event_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, text): a customer's events in order, a blank line after each order with status F."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderstatus")
    lines = event_lines(spark, folder).select("file", (F.col("line_number") - 1).alias("o_orderkey"), "value")
    with_blank = lines.join(orders, "o_orderkey").withColumn(
        "value", F.when(F.col("o_orderstatus") == "F", F.concat("value", F.lit("\n  "))).otherwise(F.col("value"))
    )
    per_file = with_blank.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "value"))).alias("l"))
    return per_file.select("file", F.array_join(F.transform("l", lambda x: x["value"]), "\n").alias("text"))
