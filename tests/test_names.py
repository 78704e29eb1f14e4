from conftest import rows
from pyspark.sql import functions as F

from lineweft.functions import names as N


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.orderBy("i").select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]


def test_paths_and_quotes(spark):
    assert apply(spark, N.normalize_path, ["dbfs:/a/dbfs:/b", "/x/dbfs:/y", "s3://z"]) == [
        "/dbfs/a/dbfs:/b", "/x/dbfs:/y", "s3://z",
    ]
    assert apply(spark, N.strip_quotes, ["`a`", '"b"', "'c'", "`\"'d'\"`", "'`e`'", None]) == [
        "a", "b", "c", "d", "`e`", None,
    ]


def test_resources_and_datasets(spark):
    assert apply(spark, N.escape_resource, ["postgres://sales-db:5432", "", None, "a b\\c.d"]) == [
        "postgres___sales_db_5432", "dft_src", "dft_src", "a_b_c_d",
    ]
    df = spark.createDataFrame(
        [("s3://lake", "raw.orders"), ("s3://lake", "/raw/api"), (None, "bare"), ("", "v1.x/t.csv"), ("n", ""), ("n", None)],
        "ns string, name string",
    )
    got = [r[0] for r in df.select(N.dataset_key(F.col("ns"), F.col("name"))).collect()]
    assert got == [
        "s3___lake.raw/orders", "s3___lake./raw/api", "dft_src._default/bare", "dft_src.v1.x/t.csv",
        "n._default/_unknown", "n._default/_unknown",
    ]


def test_column_matching(spark):
    pairs = [
        ("orderId", "ORDER_ID", True), ("orderId", "a.b.order_id", True), ("sampledatetime", "x.event_timestamp", True),
        ("eventTimestamp", "loadDateTime", False), ("a", "b", False),
    ]
    df = spark.createDataFrame(pairs, "t string, s string, e boolean")
    assert df.where(N.is_column_match(F.col("t"), F.col("s")) != F.col("e")).count() == 0


def test_ids(spark):
    assert apply(spark, N.sanitize_upper, ["a/b-c.sql", "--", "x__y"]) == ["A_B_C_SQL", "UNNAMED", "X_Y"]
    assert apply(spark, N.transform_id, ["$resource", "r", "r/a", "r/a/b/c"]) == ["$resource", "r", "r/a", "r/a_b_c"]
    assert apply(spark, N.connection_id, ["r/lake/stage", "r/<default>"]) == [
        "REFERENCE_LAKE_STAGE_CONN", "REFERENCE_DEFAULT_CONN",
    ]
    assert apply(spark, N.parent_id, ["r.s/t/c"]) == ["r.s/t"]
    assert apply(spark, N.leaf_name, ["r.s/t/c"]) == ["c"]


def test_reports_and_views(spark):
    assert apply(spark, N.report_uid, ["Sample Sales Report"]) == ["Sample_Sales_Report_78752638"]
    assert apply(spark, N.classify_field_type, ["Column", "Aggregation", "CountRows", "Other", None]) == [
        "Source Column", "Measure", "Measure", "Calculated Column", "Calculated Column",
    ]
    assert apply(spark, N.node_type, ["Calculation:JoinView", "RankView", "Calculation:SqlScriptView", None]) == [
        "JOIN", "RANK", "SCRIPT_BASED", "SCRIPT_BASED",
    ]
    assert apply(spark, N.join_type, ["leftOuter", "LEFTOUTER", "odd", None]) == ["LEFT_OUTER", "LEFT_OUTER", "", ""]


def test_split_dataset_name(spark):
    df = spark.createDataFrame(
        [("c.s.t",), ("s.t",), ("/mnt/foo/bar",), ("/bar",), ("t",), ("",), ("`s`.`t`",)], "n string"
    )
    db, table = N.split_dataset_name(F.col("n"))
    assert [tuple(r) for r in df.select(db, table).collect()] == [
        ("s", "t"), ("s", "t"), ("foo", "bar"), ("_path", "bar"), ("_default", "t"), ("_default", "_unknown"), ("s", "t"),
    ]


def test_rows_helper(spark):
    assert rows(spark.range(2)) == [(0,), (1,)]
