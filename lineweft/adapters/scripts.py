"""SQL scripts per part, column facts per line item, metadata and star chains per part."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.adapters.tables import table


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def script_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, text): one script per part; which statements it has depends on the part's size."""
    # Scripts are long and slow to read for the few bytes of a part, which lie in few splits.
    parts = table(spark, folder, "part", "p_partkey", "p_size").repartition(3 * spark.sparkContext.defaultParallelism, "p_partkey")
    p, z = F.col("p_partkey"), F.col("p_size")
    always = _text(
        "CREATE VIEW lake.stg_", p % 20, ".v_", p, " SECURITY INVOKER AS\n\nSELECT *\n\nFROM\n\n  lake.raw_", p % 7, ".t_", p
    )
    optional = [
        (2, _text("INSERT INTO mart.agg_", p % 10, "\nSELECT a.brand, COUNT(*) AS c\nFROM stage_", p,
                  " a\nJOIN `ref`.`brands` b ON a.brand = b.brand -- from hidden.comment_table")),
        (3, _text("WITH recent AS (SELECT * FROM raw.ev_", p, "),\n  best AS (SELECT * FROM Recent, dim.cal d WHERE d.note = "
                  "'from lost.place')\nINSERT OVERWRITE TABLE mart.best_", p, " SELECT * FROM best")),
        (5, _text("CREATE OR REPLACE TEMPORARY VIEW run_date_", p, " AS SELECT CURRENT_DATE() AS run_date")),
        (7, _text("DROP TABLE IF EXISTS tmp_", p)),
        (11, _text("FROM raw.src_", p, " INSERT INTO out.a_", p, " SELECT x INSERT INTO out.b_", p, " SELECT y")),
        (13, _text("CREATE FUNCTION f_", p, "(x INT) RETURNS STRUCT(a INT, b INT) USING LANGUAGE python RETURN x")),
    ]
    pieces = [always] + [F.when(z % modulus == 0, text) for modulus, text in optional]
    body = F.array_join(F.array_compact(F.array(*pieces)), ";\n ; \n")
    return parts.select(_text("s_", p, ".sql").alias("file"), F.concat(body, F.lit(";\n\n")).alias("text"))


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """(name, current): a job manifest per part as parsed JSON, with transforms that carry no SQL."""
    from lineweft.sources.scripts import MANIFEST_DDL

    parts = table(spark, folder, "part", "p_partkey", "p_size", "p_brand")
    p, z = F.col("p_partkey"), F.col("p_size")
    transform = lambda sql: F.struct(sql.alias("sql"), F.lit("x").alias("note"))
    source = lambda t, v, columns: F.struct(
        t.cast("string").alias("table"), v.cast("string").alias("view"), columns.alias("columns")
    )
    document = F.struct(
        F.when(z % 4 != 0, _text("job_", p)).alias("name"),
        F.struct(
            F.array(
                source(_text("t_", p), F.lit(None), F.array(F.lit("id"), F.lit("old"))),
                source(_text("u_", p), F.when(z % 2 == 0, _text("v_", p)), F.array(F.lit("id"), F.col("p_brand"))),
                source(F.when(z % 3 == 0, _text("t_", p)), _text("w_", p), F.array(F.lit("Key"), F.lit("new"))),
            ).alias("sources"),
            F.array(
                transform(_text("select 1 from t_", p)),
                transform(F.lit(None).cast("string")),
                transform(_text("select ", z, " from u_", p)),
            ).alias("transforms"),
        ).alias("current"),
    )
    return parts.select(
        _text("m_", p, ".json").alias("file"), F.from_json(F.to_json(document), MANIFEST_DDL).alias("d")
    ).select("file", "d.*")


def lineage_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Column facts of the scripts, one per line item; lines 6 and 7 use ``*``."""
    lines = table(
        spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    k, p, s, n = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return lines.select(
        _text("s_", p, ".sql").alias("task"),
        F.when((n == 7) & (s % 2 == 0), F.lit(9)).otherwise(n % 3 + 1).cast("bigint").alias("stmt_no"),
        F.when(rf == "N", F.lit("<default>")).when(rf == "A", _text("lake.raw_", p % 7)).otherwise(F.lit("erp")).alias(
            "src_schema"
        ),
        F.when(rf == "A", _text("t_", p)).otherwise(_text("stage_", s % 5)).alias("src_table"),
        F.when(n >= 6, F.lit("*")).when(ls == "O", _text("C_", s % 4)).otherwise(_text("c_", s % 4)).alias("src_col"),
        F.when(ls == "O", F.lit("mart")).otherwise(F.lit("<default>")).alias("tgt_schema"),
        _text("agg_", p % 10).alias("tgt_table"),
        F.when(n == 7, F.lit("*")).when(n == 6, F.lit("cnt")).otherwise(_text("d_", k % 3)).alias("tgt_col"),
    )


def table_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """(table, pos, column) of tables that scripts name, two spellings of a column included."""
    # A part makes 15 rows, nearly all of them different, and its few bytes lie in few splits.
    parts = table(spark, folder, "part", "p_partkey", "p_size", "p_brand", "p_type").repartition(
        3 * spark.sparkContext.defaultParallelism, "p_partkey"
    )
    p = F.col("p_partkey")
    columns = F.array(F.lit("brand"), F.col("p_type"), F.lit("BRAND"), F.col("p_brand"), F.lit("c_1"))
    tables = F.array(_text("<default>.stage_", p), _text("lake.raw_", p % 7, ".t_", p), _text("erp.unused_", p))
    return parts.select(F.explode(tables).alias("table"), columns.alias("c")).select(
        "table", F.posexplode("c").alias("pos", "column")
    )


def star_chains(spark: SparkSession, folder: str) -> DataFrame:
    """(src_table, tgt_table): a chain of 1 to 6 ``SELECT *`` views per part, every fifth part closing a cycle."""
    parts = table(spark, folder, "part", "p_partkey", "p_size")
    p, z = F.col("p_partkey"), F.col("p_size")
    length = z % 6 + 1
    level = lambda i: F.when(i == 0, _text("base.t_", p)).otherwise(_text("view.v_", p, "_", i))
    steps = F.transform(
        F.sequence(F.lit(1), length), lambda i: F.struct(level(i - 1).alias("src_table"), level(i).alias("tgt_table"))
    )
    closing = F.when(
        z % 5 == 0, F.array(F.struct(level(length).alias("src_table"), level(F.lit(1)).alias("tgt_table")))
    ).otherwise(F.filter(steps, lambda s: F.lit(False)))
    return parts.select(F.explode(F.concat(steps, closing)).alias("e")).select("e.*")


def chain_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """(table, pos, column): columns of the chains' base tables, and one more on the second view."""
    parts = table(spark, folder, "part", "p_partkey", "p_size", "p_brand", "p_type")
    p = F.col("p_partkey")
    entry = lambda name, pos, column: F.struct(
        name.alias("table"), F.lit(pos).alias("pos"), column.alias("column")
    )
    base = _text("base.t_", p)
    entries = F.array(
        entry(base, 0, F.lit("Id")),
        entry(base, 1, F.col("p_type")),
        entry(base, 2, F.col("p_brand")),
        entry(_text("view.v_", p, "_2"), 0, F.lower("p_type")),
        entry(_text("view.v_", p, "_2"), 1, F.lit("extra")),
    )
    return parts.select(F.explode(entries).alias("e")).select("e.*")


def write_script_files(files: DataFrame, folder: str) -> None:
    """Write each (file, text) as a file of that name into ``folder``, which all tasks reach, as a script corpus lies in a folder."""

    def written(batches):
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            for name, text in zip(batch.column("file").to_pylist(), batch.column("text").to_pylist(), strict=True):
                with system.open_output_stream(f"{root}/{name}") as out:
                    out.write((text or "").encode())
            yield batch.select(["file"])

    files.select("file", "text").mapInArrow(written, "file string").write.format("noop").mode("overwrite").save()
