"""Which events cannot give lineage, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweft.functions import vocabulary as V
from lineweft.functions.names import reason_text

#: The rule of events with data sets of an unexpected type; the event's other data sets count.
ILL_TYPED = "Ill-typed data set"
ILL_TYPED_REASON = "A data set or a part of it has an unexpected type and was left out"


def _any_schema(datasets: Column) -> Column:
    return F.coalesce(
        F.exists(datasets, lambda d: F.coalesce(F.size(d["facets"]["schema"]["fields"]) > 0, F.lit(False))),
        F.lit(False),
    )


def with_flags(events: DataFrame) -> DataFrame:
    """Counts and facet flags of each event; null arrays count as empty."""
    event = F.col("event")
    lineage = F.exists(
        event["outputs"],
        lambda o: F.coalesce(F.size(o["facets"]["columnLineage"]["fields"]) > 0, F.lit(False)),
    )
    job_lineage = event["job"]["facets"]["columnLineage"]["fields"]
    return events.select(
        "file",
        *[c for c in ("line_number", "at", "ill_typed") if c in events.columns],
        "is_valid",
        event["run"]["runId"].alias("run_id"),
        event["job"]["name"].alias("job_name"),
        event["job"]["namespace"].alias("job_namespace"),
        event["eventType"].alias("event_type"),
        F.coalesce(F.size(event["inputs"]), F.lit(0)).cast("bigint").alias("inputs_count"),
        F.coalesce(F.size(event["outputs"]), F.lit(0)).cast("bigint").alias("outputs_count"),
        event["job"].isNotNull().alias("has_job"),
        (_any_schema(event["inputs"]) | _any_schema(event["outputs"])).alias("has_schema"),
        F.coalesce(lineage, F.lit(False)).alias("has_column_lineage"),
        (job_lineage.isNotNull() & ~job_lineage.isin("{}", "[]", "null")).alias("has_job_lineage_facet"),
    )


def _checks() -> Column:
    return F.array_compact(
        F.array(
            F.when(F.col("inputs_count") <= 0, F.lit(V.NO_INPUTS)),
            F.when(F.col("outputs_count") <= 0, F.lit(V.NO_OUTPUTS)),
            F.when(F.coalesce(F.col("job_name"), F.lit("")) == "", F.lit(V.NO_JOB)),
            F.when(~F.col("has_schema"), F.lit(V.NO_SCHEMA)),
            F.when(~F.col("has_column_lineage"), F.lit(V.NO_COLUMN_LINEAGE)),
        )
    )


def with_failed_checks(events: DataFrame) -> DataFrame:
    """Flags plus ``failed``: the failed rules, or the malformed-line rule alone."""
    return with_flags(events).withColumn(
        "failed", F.when(F.col("is_valid"), _checks()).otherwise(F.array(F.lit(V.INVALID_JSON)))
    )


def event_problems(events: DataFrame) -> DataFrame:
    """One row per failed rule, and one for data sets of an unexpected type; a malformed line is one row with N/A fields."""
    checked = with_failed_checks(events)
    failed = F.col("failed")
    if "ill_typed" in events.columns:
        failed = F.concat(failed, F.when(F.col("ill_typed") > 0, F.array(F.lit(ILL_TYPED))).otherwise(F.array()))
    exploded = checked.select("*", F.explode_outer(failed).alias("error_type"))
    reason = F.when(F.col("error_type") == ILL_TYPED, F.lit(ILL_TYPED_REASON)).otherwise(reason_text(F.col("error_type")))
    not_available = F.lit("N/A")
    return exploded.where(F.col("error_type").isNotNull()).select(
        "file",
        *[c for c in ("line_number", "at") if c in events.columns],
        *[F.coalesce(F.col(c), not_available).alias(c) for c in ("run_id", "job_name", "job_namespace", "event_type")],
        "error_type",
        "inputs_count",
        "outputs_count",
        "has_job",
        "has_schema",
        "has_column_lineage",
        reason.alias("reason_description"),
    )


def _percent(part: Column, whole: Column) -> Column:
    """Tenths of a percent by integer arithmetic, halves rounded up, so every engine agrees."""
    tenths = F.floor((part * F.lit(2000) + whole) / (whole * F.lit(2))).cast("bigint")
    whole_part = F.floor(tenths / F.lit(10)).cast("bigint").cast("string")
    text = F.concat(whole_part, F.lit("."), (tenths % 10).cast("string"), F.lit("%"))
    return F.when(whole > 0, text).otherwise(F.lit("N/A"))


def file_summary(events: DataFrame) -> DataFrame:
    """Per file: totals, hits per rule, ready events and two readiness percentages."""
    valid = F.col("is_valid")

    def hits(rule: str) -> Column:
        return F.count_if(valid & F.array_contains("failed", rule))

    no_flow = F.array_contains("failed", V.NO_INPUTS) | F.array_contains("failed", V.NO_OUTPUTS)
    counted = (
        with_failed_checks(events)
        .groupBy("file")
        .agg(
            F.count_if(valid).alias("total_events"),
            F.count_if(valid).alias("valid_events"),
            F.count_if(~valid).alias("invalid_json"),
            hits(V.NO_INPUTS).alias("events_with_no_inputs"),
            hits(V.NO_OUTPUTS).alias("events_with_no_outputs"),
            hits(V.NO_JOB).alias("events_with_no_job"),
            hits(V.NO_SCHEMA).alias("events_with_no_schema"),
            hits(V.NO_COLUMN_LINEAGE).alias("events_with_no_column_lineage"),
            F.count_if(valid & (F.size("failed") == 0)).alias("lineage_ready_events"),
            F.count_if(valid & ~no_flow).alias("_flow"),
        )
    )
    total = F.col("total_events")
    return counted.select(
        *[c for c in counted.columns if c != "_flow"],
        _percent(total - F.col("events_with_no_column_lineage"), total).alias(
            "can_generate_directional_lineage_percent"
        ),
        _percent(F.col("_flow"), total).alias("can_generate_dataset_dataflow_percent"),
    )


def corpus_compare(first: DataFrame, second: DataFrame, labels: tuple[str, str] = ("sample", "main")) -> DataFrame:
    """Events of two corpora by profile, counted side by side."""
    profile = ["event_type", "job_name", "inputs_count", "outputs_count", "has_schema", "has_column_lineage"]
    labelled = [
        with_flags(events).where("is_valid").select(F.lit(label).alias("corpus"), *profile)
        for events, label in zip((first, second), labels)
    ]
    counted = labelled[0].unionByName(labelled[1]).groupBy(*profile).pivot("corpus", list(labels)).count()
    return counted.select(*profile, *[F.coalesce(F.col(x), F.lit(0).cast("bigint")).alias(f"{x}_events") for x in labels])
