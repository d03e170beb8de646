"""Panel staging tables derived from the lines, one definition for both engines.

The expressions are written in the dialect Spark SQL and DuckDB share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelwright.sources.rows import inline_rows

from .registry import table

# Lines with the dates of their order as text parts, so that every panel can spell periods its own way. The parts are
# cut once per order, before the join.
BASE = """
SELECT concat(l_orderkey, '') AS ordk, concat(l_partkey, '') AS partk, concat(l_suppkey, '') AS suppk,
  l_linenumber AS ln, l_returnflag AS rf, l_linestatus AS ls, os, op, yy, mm, dd, mon,
  CAST(l_quantity AS DECIMAL(18,4)) AS qty, CAST(l_extendedprice AS DECIMAL(18,4)) AS price,
  CAST(l_discount * 100 AS DECIMAL(18,4)) AS disc, l_shipdate AS loa
FROM {lineitem} JOIN (
  SELECT o_orderkey, o_orderstatus AS os, o_orderpriority AS op, concat(year(o_orderdate), '') AS yy,
    lpad(concat(month(o_orderdate), ''), 2, '0') AS mm, lpad(concat(day(o_orderdate), ''), 2, '0') AS dd,
    month(o_orderdate) AS mon FROM {orders}) AS o
ON l_orderkey = o_orderkey"""

# Portuguese month labels.
_PT_MONTHS = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]
_LABEL = "CASE mon " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(_PT_MONTHS, 1)) + " END"
_WIDE = {"SO_VALUES": "price", "SO_UNITS": "qty", "SO_KILOS": "disc"}
_PT = {"SOURCE_CODE": "rf", "LOA_DAT": "loa"}
_FLAG = "CASE rf WHEN 'A' THEN ' a ' WHEN 'N' THEN 'N' ELSE 'other' END"
_ES = {"KPI_FLG": _FLAG, "PER_DSC": "concat(yy, mm)", "KPI_VAL": "CASE WHEN ln <> 3 THEN qty END",
       "SRC_DSC_ORG": "concat('file ', ls)", "LOA_DAT": "loa"}
_TOTAL = "CASE WHEN ln = 7 THEN 'TOTAL' ELSE concat('Item ', ln) END"
_PANEL_D = {"GEO_COD": "op", "PDT_COD": "ordk", "CHL_COD": "concat(ln % 3, '')",
            "PER_DSC": "CASE WHEN os = 'F' THEN concat(yy, mm) ELSE concat(yy, mm, dd) END"}
_ANY = "concat('Pack ', ln, ' of ', ordk, ' ')"

STAGING: dict[str, dict[str, str]] = {
    "STG_PT_PANEL_A_FOOD": {
        "PDT_DSC": _TOTAL, "PDT_COD": "ordk", "PER_ALL": "concat(yy, mm)", "PER_INI": "concat(yy, '-', mm, '-', dd)",
        "PER_FIN": "concat(yy, '-', mm, '-', dd)", **_WIDE, **_PT},
    "STG_PT_PANEL_A_MILK": {
        "PDT_DSC": _TOTAL, "PDT_COD": "ordk", "PER_ALL": "concat(yy, mm)",
        "PER_INI": "CASE WHEN ln = 2 AND rf = 'R' THEN 'soon' ELSE concat(dd, '/', mm, '/', yy) END",
        "PER_FIN": "concat(dd, '/', mm, '/', yy)", **_WIDE, **_PT},
    "STG_PT_PANEL_B": {
        "GEO_DSC": "concat(' ', lower(op), ' ')",
        "PER_DSC": f"CASE WHEN ln = 5 THEN concat('xyz ', substr(yy, 3, 2)) WHEN ln = 6 THEN 'jan' "
                   f"ELSE concat({_LABEL}, ' ', substr(yy, 3, 2)) END",
        "PDT_PCK": "concat('Pack ', ln)", "PDT_COD": "ordk", "UPC_COD": "partk", "CNY_DSC": "os", "BRD_DSC": "rf",
        "SGM_DSC": "ls", "SSG_DSC": "ls", "SBR_DSC": "rf", "STG_DSC": "os", "CPC_DSC": "rf", **_WIDE, **_PT},
    "STG_PT_PANEL_C": {
        "PDT_COD": "ordk", "PDT_PCK": "concat('Pack ', ln)", "CTG_DSC": "os", "PER_DSC": "concat(mm, '/', dd, '/', yy)",
        **_WIDE, **_PT},
    "STG_ES_PANEL_F": {"MKT_DSC": "os", "GEO_DSC": "op", "CAT_DSC": "concat(' cat ', ln)", **_ES},
    "STG_ES_PANEL_G": {"MKT_DSC": "os", "GEO_DSC": "op", "PDT_DSC": "concat('Prod ', ln, ' ', suppk)", **_ES},
    "STG_ES_PANEL_H": {"CNY_DSC": "os", "PDT_DSC": "concat('Prod ', ln)", "PDT_PCK": _ANY, "GEO_COD": "op", **_ES},
    "STG_ES_PANEL_I": {
        "CNY_DSC": "os", "PDT_DSC": "concat('Prod ', ln)", "PDT_PCK": _ANY, "CAT_DSC": "op", "OTC_1_DSC": "os",
        "OTC_2_DSC": "op", "OTC_3_DSC": "os", "OTC_4_DSC": "CASE WHEN ln < 4 THEN 'low' END", **_ES},
    "STG_ES_PANEL_E_OTHERS": {
        "CHL_DSC": "CASE op WHEN '1-URGENT' THEN 'CHANNEL_ONLINE' WHEN '2-HIGH' THEN 'CHANNEL_HYPER' "
                   "WHEN '3-MEDIUM' THEN 'CHANNEL_SUPER' WHEN '5-LOW' THEN 'CHANNEL_DISCOUNT' ELSE 'TOTAL_MARKET' END",
        "PDT_PCK": "concat('pack ', ln)", "CAT_DSC": "CASE ln % 3 WHEN 0 THEN 'CATEGORY_A' WHEN 1 THEN 'CATEGORY_B' "
        "ELSE 'CATEGORY_C' END", "CNY_DSC": "os", "SGM_DSC": "os", "BRD_DSC": "op", "VRY_DSC": "os", "SVR_DSC": "os",
        "SBR_DSC": "op", "CPC_N01": "os", "CPC_N02": "op",
        "UPC_COD": "CASE WHEN ln = 6 THEN 'Not Available' ELSE ordk END", **_ES},
    "STG_ES_PANEL_E_PHARMA": {
        "MKT_DSC": "os", "GEO_DSC": "op", "TYP_MKT_DSC": "os", "SGM_DSC": "op", "SGM_SUB_DSC": "os", "CNY_DSC": "os",
        "PDT_DSC": "concat('Prod ', ln)", "PDT_PCK": _ANY, **_ES},
    "TRA_PT_PANEL_D": {**_PANEL_D, "SO_VALUES": "price", "SO_UNITS": "qty", **_PT},
    "D_PT_PANEL_D": {
        "GEO_COD": "op", "PDT_COD": "ordk", "PER_DSC": _PANEL_D["PER_DSC"], "CHL_COD": "concat(ln % 3, '')",
        "SAL_VAL": "CASE WHEN ln > 4 THEN qty ELSE price END", "SAL_UNT": "qty", "SAL_CUN": "disc",
        "SAL_PVA_VAL": "price", "SRC_DSC_ORG": "concat('file ', ls)", "LOA_DAT": "loa", "SAL_ORG_COD": "ls"},
}
# A panel D feed holds the lines of one return flag.
FEED_FLAGS = {"PANEL_D_MASS": "A", "PANEL_D_META": "N", "PANEL_D_PHARMA": "R"}

MAPPINGS: dict[str, tuple[str, list[tuple]]] = {
    "MAP_PT_CHANNEL": ("SRC_DSC string, CHL_SRC string, CHL_COD int", [
        ("PANEL_A_FOOD", " panel_a_food ", 11), ("PANEL_A_MILK", "PANEL_A_MILK", 12), ("PANEL_B", "panel_b", 13),
        ("PANEL_D_MASS", "0", 20), ("PANEL_D_MASS", "1", 21), ("PANEL_D_META", "1", 31), ("PANEL_D_PHARMA", "2", 42)]),
    "MAP_PT_SALES_TYPE": ("SRC_DSC string, SAL_TYP_SRC string, SAL_TYP_COD int", [
        ("PANEL_A_FOOD", "PANEL_A_FOOD", 101), ("PANEL_A_MILK", "someone else", 102), ("PANEL_B", "PANEL_B ", 103),
        ("PANEL_C", "panel_c", 104), ("PANEL_D_MASS", "2", 202), ("PANEL_D_PHARMA", "3", 203),
        ("PANEL_D_MASS", "1", 211), ("PANEL_D_META", "0", 220)]),
    "MAP_ES_CHANNEL": ("SRC_DSC string, CHL_SRC string, CHL_COD int", [
        ("PANEL_F", "panel_f", 51), ("PANEL_G", " Panel_G ", 52), ("PANEL_I", "PANEL_I", 53)]),
    "MAP_ES_SALES_TYPE": ("SRC_DSC string, SAL_TYP_SRC string, SAL_TYP_COD int", [
        ("PANEL_F", "PANEL_F", 61), ("PANEL_H", "PANEL_H", 62), ("PANEL_E", "panel_e", 63)]),
    "MAP_ES_UNITS": ("SRC_DSC string, KPI_FLG_SRC string, KPI_FLG_COD int", [
        (p, label, code) for p in ["PANEL_F", "PANEL_G", "PANEL_H", "PANEL_I", "PANEL_E_OTHERS", "PANEL_E_PHARMA"]
        for label, code in [("A", 1), (" n", 2)]]),
}


# Bytes of the lines' files that one task joins: about half a million lines. A panel's rows are many times as wide as the lines
# that are exchanged, so tasks merged by the bytes they read would sort several times as many.
LINES_A_TASK = 8 << 20


def tasks_for(spark: SparkSession, sf_dir: str) -> int | None:
    """In how many tasks lines and orders are joined; None where a few do, and Spark's own choice stays."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    tasks = -(-fs.getContentSummary(path).getLength() // LINES_A_TASK)
    return max(tasks, spark.sparkContext.defaultParallelism) if tasks > 2 else None


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    if tasks := tasks_for(spark, sf_dir):
        # an order has few lines, so tasks are even
        lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    return spark.sql(BASE, lineitem=lines, orders=orders)


def _flag(name: str) -> tuple[str, str | None]:
    for feed, flag in FEED_FLAGS.items():
        if name.endswith(feed):
            return name[: -len(feed)] + "PANEL_D", flag
    return name, None


def staging(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    definition, flag = _flag(name)
    rows = base(spark, sf_dir)
    if flag:
        rows = rows.filter(f"rf = '{flag}'")
    return rows.selectExpr(*[f"{e} AS {n}" for n, e in STAGING[definition].items()])


def mapping(spark: SparkSession, name: str) -> DataFrame:
    return inline_rows(spark, *MAPPINGS[name])


def sql_base() -> str:
    return "base AS (" + BASE.format(lineitem="lineitem", orders="orders") + ")"


def sql_staging(name: str) -> str:
    definition, flag = _flag(name)
    columns = ", ".join(f"{e} AS {n}" for n, e in STAGING[definition].items())
    return f"SELECT {columns} FROM base" + (f" WHERE rf = '{flag}'" if flag else "")


def sql_mapping(name: str) -> str:
    schema, rows = MAPPINGS[name]
    columns = ", ".join(c.split()[0] for c in schema.split(", "))
    values = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"{name} AS (SELECT * FROM (VALUES {values}) AS t({columns}))"
