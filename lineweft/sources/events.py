"""Run-event logs (JSON lines)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineweft.config import LineageConfig
from lineweft.functions.rows import let, parse_once
from lineweft.sources.files import split_lines

# Suffixes .jsonl and .ndjson in any case.
EVENT_FILES = "*.{[jJ][sS][oO][nN][lL],[nN][dD][jJ][sS][oO][nN]}"


def normalized(path: str) -> str:
    """Python form of ``names.normalize_path`` for a path argument."""
    return "/dbfs/" + path.removeprefix("dbfs:/") if path.startswith("dbfs:/") else path


def scan_event_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, value) of every ``.jsonl``/``.ndjson`` file directly in ``path``; ``at`` is where a line lies.

    Files are split among tasks and lines stay where they are read: what is derived from a
    line can carry ``at`` and be numbered later by ``line_numbers``, if it needs a number at all.
    """
    lines = split_lines(spark, normalized(path), EVENT_FILES).where(has_content("value"))
    return lines.select("file", F.struct("path", "block", "place").alias("at"), stripped("value").alias("value"))


def line_numbers(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """``rows`` derived from ``scan_event_lines`` of the same path, with ``line_number`` in the place of ``at``.

    A line's number is its place in its split plus the lines of the file's earlier splits. Splits
    are counted without their text, one row per split, and only ``rows`` meet the counts.
    """
    lines = split_lines(spark, normalized(path), EVENT_FILES)
    splits = lines.groupBy("path", "block").agg(F.min("place").alias("first"), F.count("*").alias("lines"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = splits.select(
        F.col("path").alias("_path"),
        F.col("block").alias("_block"),
        (F.coalesce(F.sum("lines").over(earlier), F.lit(0)) - F.col("first") + 1).alias("_shift"),
    )
    same = (F.col("at.path") == F.col("_path")) & (F.col("at.block") == F.col("_block"))
    number = (F.col("at.place") + F.col("_shift")).alias("line_number")
    return rows.join(shifts, same).select(*[number if c == "at" else c for c in rows.columns if c != "line_number"])


def read_event_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_number, value): the lines of ``scan_event_lines``, numbered at once."""
    return line_numbers(scan_event_lines(spark, path), spark, path)


def has_content(column: str) -> Column:
    """Whether there is more than white space of any kind."""
    return F.col(column).rlike(r"(?U)\S")


def stripped(column: str) -> Column:
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")


def number_lines(files: DataFrame) -> DataFrame:
    """(file, text) to (file, line_number, value); blank lines count but are dropped."""
    lines = files.select("file", F.posexplode(F.split("text", "\r?\n")).alias("pos", "value"))
    return lines.where(has_content("value")).select(
        "file", (F.col("pos") + 1).cast("bigint").alias("line_number"), stripped("value").alias("value")
    )


def _field_ddl(depth: int) -> str:
    inner = "string" if depth == 0 else _field_ddl(depth - 1)
    return f"array<struct<name:string,fields:{inner}>>"


def _dataset_ddl(role: str, max_depth: int) -> str:
    """Fields of an input or output data set."""
    schema = f"schema:struct<fields:{_field_ddl(max_depth)}>"
    if role == "inputs":
        return f"namespace:string,name:string,facets:struct<{schema}>"
    input_field = "struct<namespace:string,name:string,field:string,transformations:array<struct<type:string>>>"
    lineage = f"columnLineage:struct<fields:map<string,struct<inputFields:array<{input_field}>>>>"
    return f"namespace:string,name:string,facets:struct<{schema},{lineage}>"


def event_ddl(max_depth: int) -> str:
    return (
        "run struct<runId:string,facets:struct<spark_properties:struct<properties:struct<`spark.app.name`:string>>>>,"
        "job struct<namespace:string,name:string,facets:struct<jobType:struct<jobType:string>,"
        "sql:struct<query:string>,columnLineage:struct<fields:string>>>,"
        "eventType string,"
        f"inputs array<struct<{_dataset_ddl('inputs', max_depth)}>>,"
        f"outputs array<struct<{_dataset_ddl('outputs', max_depth)}>>"
    )


def _one_by_one(role: str, max_depth: int) -> Column:
    """(datasets, ill_typed): the data sets of a document, parsed as ``_variant``, read one at a time.

    What is no object is left out; an object with a field of an unexpected type keeps the others.
    """
    ddl = f"struct<{_dataset_ddl(role, max_depth)},_corrupt:string>"
    elements = F.try_variant_get("_variant", f"$.{role}", "array<variant>")

    def read(element: Column) -> Column:
        text = let(F.to_json(element), lambda json: F.when(json.startswith("{"), json))
        return F.from_json(text, ddl, {"columnNameOfCorruptRecord": "_corrupt"})

    def clean(dataset: Column) -> Column:
        return F.struct(*[dataset[c].alias(c) for c in ("namespace", "name", "facets")])

    return let(
        F.transform(elements, read),
        lambda all: F.struct(
            F.transform(F.filter(all, lambda d: d.isNotNull()), clean).alias("datasets"),
            F.size(F.filter(all, lambda d: d.isNull() | d["_corrupt"].isNotNull())).alias("ill_typed"),
        ),
    )


def parse_events(lines: DataFrame, config: LineageConfig = LineageConfig()) -> DataFrame:
    """(file, line_number, event, is_valid, ill_typed) of (file, line_number, value) or (file, at, value).

    A malformed line keeps its row with a null event. A data set of an unexpected type costs
    an event neither its other data sets nor its other parts; ``ill_typed`` counts those
    that were left out or lost a part. Events are parsed as a whole; only those in which something
    has an unexpected type are read again, data set by data set.
    """
    ddl = event_ddl(config.max_depth) + ",_corrupt string"
    parsed = parse_once(lines, F.from_json("value", ddl, {"columnNameOfCorruptRecord": "_corrupt"}), "_parsed")
    # A field of an unexpected type also counts as corrupt; only text that is no JSON at all is malformed.
    odd = F.col("_parsed").isNull() | F.col("_parsed._corrupt").isNotNull()
    parsed = parse_once(parsed, F.when(odd, F.try_parse_json("value")), "_variant")
    valid = F.col("value").isNotNull() & (~odd | F.col("_variant").isNotNull())
    again = F.struct(*[_one_by_one(role, config.max_depth).alias(role) for role in ("inputs", "outputs")])
    parsed = parsed.withColumn("_valid", valid)
    parsed = parse_once(parsed, F.when(odd & F.col("_valid"), again), "_again")
    event = F.struct(
        *[F.col(f"_parsed.{c}").alias(c) for c in ("run", "job", "eventType")],
        *[F.coalesce(F.col(f"_again.{c}.datasets"), F.col(f"_parsed.{c}")).alias(c) for c in ("inputs", "outputs")],
    )
    ill_typed = F.coalesce(F.col("_again.inputs.ill_typed"), F.lit(0)) + F.coalesce(F.col("_again.outputs.ill_typed"), F.lit(0))
    place = [c for c in ("line_number", "at") if c in lines.columns]
    return parsed.select(
        "file",
        *place,
        F.when(F.col("_valid"), event).alias("event"),
        F.col("_valid").alias("is_valid"),
        ill_typed.cast("bigint").alias("ill_typed"),
    )
