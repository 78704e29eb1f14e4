"""Calculation-view documents: one XML document per customer, its form chosen by market segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.adapters.tables import table

_HEAD = (
    '<?xml version="1.0" encoding="UTF-8"?>\n'
    '<Calculation:scenario xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" '
    'xmlns:Calculation="http://www.sap.com/ndb/BiModelCalculation.ecore" schemaVersion="2.3"'
)

_BODIES = {
    "BUILDING": """
 BEGIN
 var_out = WITH base AS (
  SELECT a.COL_A, A.KEY_F, COUNT(x.Z1) AS n, MAX(CASE WHEN (a.COL_B &gt; 1) THEN 1 END) AS m
  FROM &quot;{s}&quot;.&quot;{t}&quot; AS a
  WHERE a.COL_C IN (SELECT q.IDX FROM &quot;{s}&quot;.&quot;{w}&quot; q)
 ),
 enriched AS(SELECT b.KEY_F, {u}.NAME1 AS NAME_X FROM base b LEFT JOIN &quot;{r}&quot;.&quot;{u}&quot; ON b.KEY_F = {u}.KEY_F)
 SELECT * FROM enriched;
 END
""",
    "MACHINERY": "SELECT t.AMOUNT, t.KEY_F FROM &quot;{s}&quot;.&quot;{t}&quot; t, &quot;{r}&quot;.{u} WHERE t.KEY_F = 'x'",
    "HOUSEHOLD": """WITH calendar AS (SELECT ADD_DAYS(CURRENT_DATE, (1 + (2))) AS D FROM DUMMY),
 facts AS (SELECT f.KEY_F, F.AMOUNT FROM &quot;{s}&quot;.&quot;{t}&quot; f JOIN calendar c ON c.D = f.DAY_F),
 final AS (SELECT * FROM Facts) SELECT * FROM final""",
    "FURNITURE": "WITH only AS (SELECT e.QTY FROM &amp;quot;{s}&amp;quot;.&amp;quot;{t}&amp;quot; e INNER JOIN "
    "&amp;quot;{r}&amp;quot;.&amp;quot;{u}&amp;quot; AS g ON e.KEY_F = g.KEY_F) SELECT * FROM only",
}


def _script(segment: str, node: str) -> str:
    return (
        f'<calculationView xsi:type="Calculation:SqlScriptView" id="{node}"><descriptions/>'
        '<viewAttributes><viewAttribute datatype="NVARCHAR" id="KEY_F" length="4"/>'
        '<viewAttribute datatype="DECIMAL" id="AMOUNT" length="23" scale="2"/></viewAttributes>'
        f"<calculatedViewAttributes/><definition>{_BODIES[segment]}</definition></calculationView>"
    )


_PROJECTION = (
    '<calculationView xsi:type="Calculation:ProjectionView" id="Projection_1">'
    '<calculatedViewAttributes><calculatedViewAttribute datatype="INTEGER" id="CALC_1">'
    '<keyMapping columnName="X2"/></calculatedViewAttribute>'
    '<calculatedViewAttribute id="CALC_2"/></calculatedViewAttributes>'
    "<filter>KEY_F = 'A'</filter>"
    '<input node="#DS_A"><mapping target="KEY_F"/></input></calculationView>'
)
_NODES = {
    "BUILDING": _script("BUILDING", "Script_View"),
    "MACHINERY": _script("MACHINERY", "Script_View"),
    "AUTOMOBILE": _PROJECTION
    + '<calculationView xsi:type="Calculation:JoinView" id="Join_1" joinType="{join}">'
    '<input node="#Projection_1"/><input node="#DS_B"/></calculationView>'
    '<calculationView xsi:type="Calculation:AggregationView" id="Aggregation_1"><input node="#Join_1"/></calculationView>',
    "HOUSEHOLD": _script("HOUSEHOLD", "Script_View"),
    "FURNITURE": _PROJECTION + _script("FURNITURE", "Script_2"),
}
_SOURCE = '<DataSource id="{0}" type="DATA_BASE_TABLE"><resourceUri>{1}</resourceUri></DataSource>'
_SOURCES = {
    "BUILDING": "",
    "MACHINERY": _SOURCE.format("DS_1", "Z/{w}"),
    "AUTOMOBILE": _SOURCE.format("DS_A", "{s}/{t}") + _SOURCE.format("DS_B", "{r}/{u}"),
    "HOUSEHOLD": "",
    "FURNITURE": _SOURCE.format("DS_A", "{s}/{t}"),
}
_ATTRIBUTES = {
    "BUILDING": ["KEY_F", "col_b"],
    "MACHINERY": ["KEY_F"],
    "AUTOMOBILE": ["KEY_F"],
    "HOUSEHOLD": ["KEY_F", "D"],
    "FURNITURE": ["KEY_F", "Only"],
}
_MEASURES = {
    "BUILDING": ["COL_A"],
    "MACHINERY": ["AMOUNT"],
    "AUTOMOBILE": ["QTY"],
    "HOUSEHOLD": ["AMOUNT"],
    "FURNITURE": ["QTY"],
}


def _body(segment: str) -> str:
    attributes = "".join(
        f'<attribute id="{a}" order="{i}"><keyMapping columnObjectName="n" columnName="{a}"/></attribute>'
        for i, a in enumerate(_ATTRIBUTES[segment])
    )
    measures = "".join(f'<measure id="{m}" aggregationType="sum"/>' for m in _MEASURES[segment])
    return (
        f"<dataSources>{_SOURCES[segment]}</dataSources>\n"
        f"<calculationViews>{_NODES[segment]}</calculationViews>\n"
        f'<logicalModel id="n"><descriptions/><attributes>{attributes}</attributes><calculatedAttributes/>'
        f"<baseMeasures>{measures}</baseMeasures></logicalModel>\n</Calculation:scenario>"
    )


def calcview_docs(spark: SparkSession, folder: str) -> DataFrame:
    """(file, xml): one document per customer; every tenth repeats the id of the one before."""
    customers = table(spark, folder, "customer", "c_custkey", "c_nationkey", "c_mktsegment", "c_name")
    # Documents are long and slow to read for the few bytes of a customer, which lie in few splits.
    customers = customers.repartition(3 * spark.sparkContext.defaultParallelism, "c_custkey")
    k, n, segment = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    number = k - F.when(k % 10 == 9, 1).otherwise(0)

    def text(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    body = F.lit(None).cast("string")
    for name in _NODES:
        body = F.when(segment == name, F.lit(_body(name))).otherwise(body)
    values = {
        "{s}": text("S_", n % 4),
        "{r}": text("R_", n % 3),
        "{t}": text("T", k % 13),
        "{u}": text("U", k % 7),
        "{w}": text("pkg.sub/V", k % 5),
        "{join}": F.when(k % 3 == 0, F.lit("leftOuter")).when(k % 3 == 1, F.lit("inner")).otherwise(F.lit("weird")),
    }
    for mark, value in values.items():
        body = F.replace(body, F.lit(mark), value)
    attributes = F.concat(
        F.when(k % 17 != 0, text(' id="CV_', number, '"')).otherwise(F.lit("")),
        F.when(k % 4 == 0, text(' package="pkg.', F.lower(segment), '"')).otherwise(F.lit("")),
        F.when(segment != "BUILDING", F.lit(' dataCategory="DIMENSION"')).otherwise(F.lit("")),
        F.when(k % 5 == 0, F.lit(' defaultClient="$$client$$"')).otherwise(F.lit("")),
    )
    description = F.when(k % 3 != 0, text('<descriptions defaultDescription="View of ', F.col("c_name"), '"/>')).otherwise(
        F.lit("<descriptions/>")
    )
    return customers.select(
        text("v_", k, ".hdbcalculationview").alias("file"),
        F.concat(F.lit(_HEAD), attributes, F.lit(">\n<origin/>\n"), description, F.lit("\n"), body).alias("xml"),
    )
