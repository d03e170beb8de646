"""Product master, new products, key resolution and the gold facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.functions import keys
from panelwright.operators import feeds, resolve
from panelwright.plans import marts, mastering
from panelwright.schemas import PT_PRODUCT_COLUMNS

from .registry import add, table

# Parts with the last ship date as load stamp, in the dialect both engines share.
PARTS = """
SELECT p.*, m.loa FROM {part} AS p JOIN (SELECT l_partkey, max(l_shipdate) AS loa FROM {lineitem} GROUP BY l_partkey) AS m
ON p_partkey = l_partkey"""
_pair = "(p_partkey - p_partkey % 2)"
_codes = {
    "PNL_D_COD": "CASE WHEN p_size % 5 = 0 THEN 'na' ELSE concat(' d', p_partkey) END",
    "PNL_C_COD": f"CASE WHEN p_size % 3 = 0 THEN 'NA' ELSE concat('c', {_pair}, ' ') END",
    "PNL_A_COD": "concat('a', p_partkey)",
    "PNL_B_COD": "CASE WHEN p_size % 2 = 0 THEN 'Na' ELSE concat('b', p_partkey) END",
    "EAN_COD": "CASE WHEN p_size % 7 = 0 THEN 'na ' ELSE concat('e', p_partkey) END",
    "STS_COD": "concat(' s', p_size % 2)",
    "CAT_DSC": "concat(' ', lower(p_type))", "BRD_DSC": "p_brand", "PDT_DSC": "p_name", "PDT_PCK": "p_name",
    "ORG_DSC": "CASE WHEN p_size % 3 = 0 THEN 'panel_i' ELSE 'panel_f' END",
}
STAGED = {c: _codes.get(c, f"concat(' {c.lower()} ', p_size)") for c in PT_PRODUCT_COLUMNS}
STAGED |= {"SRC_DSC_ORG": "concat('file ', p_size)", "LOA_DAT": "loa"}


def product_staging(spark: SparkSession, sf: str) -> DataFrame:
    parts = spark.sql(PARTS, part=table(spark, sf, "part"), lineitem=table(spark, sf, "lineitem"))
    return parts.selectExpr(*[f"{e} AS {c}" for c, e in STAGED.items()])


def master(spark: SparkSession, sf: str) -> DataFrame:
    return mastering.product_master(product_staging(spark, sf))


SQL_STAGED = (f"parts AS ({PARTS.format(part='part', lineitem='lineitem')}), stg AS (SELECT "
              + ", ".join(f"{e} AS {c}" for c, e in STAGED.items()) + " FROM parts)")
_norm = ", ".join(f"trim({c}) AS {c}" if c == "STS_COD" else f"upper(trim({c})) AS {c}" for c in PT_PRODUCT_COLUMNS)
_fallback = ", ".join("'1'" if c == "STS_COD" else "'99'" if c.startswith(("PNL", "EAN")) else "'NOT_ASSIGNED'"
                      for c in PT_PRODUCT_COLUMNS)
SQL_MASTER = (f"{SQL_STAGED}, master AS (SELECT {_norm}, SRC_DSC_ORG, LOA_DAT FROM stg UNION ALL "
              f"SELECT {_fallback}, max(SRC_DSC_ORG), max(LOA_DAT) FROM stg)")

add("product_master", master, f"WITH {SQL_MASTER} SELECT * FROM master")


def fallback_member(spark, sf):
    """One extra member with the audit values of the orders."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return feeds.add_member(orders, {"o_orderkey": F.lit(99), "o_orderstatus": F.lit("NOT_ASSIGNED")}, ["o_orderdate"])


add("fallback_member", fallback_member, """
SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders UNION ALL
SELECT 99, 'NOT_ASSIGNED', max(o_orderdate) FROM orders""")

_cleaned = ", ".join(f"nullif({c}, 'NA') AS {c}" for c in mastering.PANEL_CODES)
_rest = [c for c in PT_PRODUCT_COLUMNS if c not in mastering.PANEL_CODES]
_order = ", ".join(f"{c} DESC NULLS LAST" for c in ["LOA_DAT", *PT_PRODUCT_COLUMNS, "SRC_DSC_ORG"])
_out = ["PDT_COD", *mastering.PANEL_CODES, *_rest, "SRC_DSC_ORG", "LOA_DAT"]
SQL_DIMENSION = f"""SELECT {', '.join(_out)} FROM (
SELECT *, row_number() OVER (PARTITION BY PDT_COD ORDER BY {_order}) AS rn FROM (
SELECT *, coalesce(PNL_C_COD, PNL_D_COD, PNL_B_COD) AS PDT_COD FROM (
SELECT {_cleaned}, {', '.join(_rest)}, SRC_DSC_ORG, LOA_DAT FROM master) AS a) AS b WHERE PDT_COD IS NOT NULL) AS c
WHERE rn = 1"""


def dimension(spark: SparkSession, sf: str) -> DataFrame:
    return mastering.product_dimension(master(spark, sf))


add("product_dimension", dimension, f"WITH {SQL_MASTER} {SQL_DIMENSION}")


# ---- gold facts --------------------------------------------------------------------

_fact_cols = ("l_linenumber AS CHL_COD, l_suppkey AS SAL_TYP_COD, '{0}' AS SRC_DSC, "
              "concat(year(l_shipdate), lpad(concat(month(l_shipdate), ''), 2, '0')) AS PER_DSC, "
              "l_extendedprice AS SAL_VAL, l_quantity AS SAL_UNT{1}, l_returnflag AS SRC_DSC_ORG, l_shipdate AS LOA_DAT")


def _panel_columns(name: str, code: str, weight: bool) -> str:
    return f"{code} AS PDT_COD, " + _fact_cols.format(name, ", l_tax AS SAL_WGT" if weight else "")


# panel C codes repeat over two parts; some of its rows carry a barcode, some an unknown code
PANELS = {
    "C": (_panel_columns("PANEL_C", "CASE l_linenumber WHEN 1 THEN concat('E', l_partkey) WHEN 2 THEN concat('X', "
                                    "l_partkey) ELSE concat('C', (l_partkey - l_partkey % 2)) END", True),
          "l_returnflag = 'A'"),
    "B": (_panel_columns("PANEL_B", "concat('B', l_partkey)", True), "l_returnflag = 'N'"),
    "D": (_panel_columns("PANEL_D", "concat('D', l_partkey)", False), "l_returnflag = 'R'"),
    "A_FOOD": (_panel_columns("PANEL_A_FOOD", "concat('A', l_partkey)", True), "l_returnflag = 'N'"),
    "A_MILK": (_panel_columns("PANEL_A_MILK", "concat('A', l_partkey)", True), "l_returnflag = 'R'"),
}


def panel(spark: SparkSession, sf: str, name: str) -> DataFrame:
    columns, where = PANELS[name]
    return spark.sql(f"SELECT {columns} FROM {{lineitem}} WHERE {where}", lineitem=table(spark, sf, "lineitem"))


def sql_panel(name: str) -> str:
    columns, where = PANELS[name]
    return f"SELECT {columns} FROM lineitem WHERE {where}"


GOLD = ("coalesce({0}, PDT_COD) AS PDT_COD, CHL_COD, SAL_TYP_COD, SRC_DSC, TRY_CAST(PER_DSC AS INTEGER) AS PER_DSC, "
        "SAL_VAL, SAL_UNT, {1} AS SAL_WGT, SRC_DSC_ORG, LOA_DAT")


def national(spark, sf, match):
    sources = {"PNL_C_COD": panel(spark, sf, "C"), "PNL_B_COD": panel(spark, sf, "B"),
               "PNL_D_COD": panel(spark, sf, "D")}
    return marts.national_fact(sources, dimension(spark, sf), match)


def _national_sql(key: str | None) -> str:
    arms = []
    for name, code in [("C", "PNL_C_COD"), ("B", "PNL_B_COD"), ("D", "PNL_D_COD")]:
        k = key or code
        gold = GOLD.format("m.PNL_C_COD, m.PNL_D_COD, m.PNL_B_COD", "NULL" if name == "D" else "SAL_WGT").replace(
            "PDT_COD) AS", "f.PDT_COD) AS")
        arms.append(
            f"SELECT {gold} FROM ({sql_panel(name)}) AS f LEFT JOIN (SELECT * FROM (SELECT {k} AS k, PNL_C_COD, PNL_D_COD,"
            f" PNL_B_COD, row_number() OVER (PARTITION BY {k} ORDER BY PNL_C_COD NULLS LAST, PNL_D_COD NULLS LAST, "
            f"PNL_B_COD NULLS LAST) AS rn FROM dim WHERE {k} IS NOT NULL) AS u WHERE rn = 1) AS m ON f.PDT_COD = m.k")
    return f"WITH {SQL_MASTER}, dim AS ({SQL_DIMENSION}) " + " UNION ALL ".join(arms)


add("cross_panel_mart", lambda spark, sf: national(spark, sf, "panel"), _national_sql(None))
add("cross_panel_mart_by_product", lambda spark, sf: national(spark, sf, "product"), _national_sql("PDT_COD"))


def cleaned_master(spark: SparkSession, sf: str) -> DataFrame:
    """The master with its "NA" codes cleared; several products may share a code."""
    return master(spark, sf).select(*[keys.clean_token(c).alias(c) for c in mastering.PANEL_CODES])


def top2(spark, sf, unique):
    return marts.top2_fact(panel(spark, sf, "C"), [panel(spark, sf, "A_FOOD"), panel(spark, sf, "A_MILK")],
                           cleaned_master(spark, sf), unique)


_p_cols = "EAN_COD, PNL_C_COD, PNL_A_COD, PNL_D_COD"
_gold2 = GOLD.format("m.EAN_COD, m.PNL_C_COD, m.PNL_A_COD, m.PNL_D_COD", "SAL_WGT").replace("PDT_COD) AS", "f.PDT_COD) AS")
_arms_a = " UNION ALL ".join(
    f"SELECT {_gold2} FROM ({sql_panel(n)}) AS f LEFT JOIN m ON f.PDT_COD = m.PNL_A_COD" for n in ["A_FOOD", "A_MILK"])
add("product_or_join", lambda spark, sf: top2(spark, sf, False), f"""
WITH {SQL_MASTER}, m AS (SELECT {_cleaned} FROM master)
SELECT {_gold2} FROM ({sql_panel('C')}) AS f LEFT JOIN m ON f.PDT_COD = m.PNL_C_COD OR f.PDT_COD = m.EAN_COD
UNION ALL {_arms_a}""")

_keyed = " UNION ALL ".join(f"SELECT {i} AS rnk, {c} AS k, {_p_cols} FROM m WHERE {c} IS NOT NULL"
                            for i, c in enumerate(["PNL_C_COD", "EAN_COD"]))
_nulls = ", ".join(f"{c} NULLS LAST" for c in _p_cols.split(", "))
add("product_or_join_unique", lambda spark, sf: top2(spark, sf, True), f"""
WITH {SQL_MASTER}, m AS (SELECT {_cleaned} FROM master),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY rnk, {_nulls}) AS rn FROM ({_keyed}) AS y)
  AS z WHERE rn = 1),
ua AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY PNL_A_COD ORDER BY {_nulls}) AS rn FROM m
  WHERE PNL_A_COD IS NOT NULL) AS z WHERE rn = 1)
SELECT {_gold2.replace('m.', 'u.')} FROM ({sql_panel('C')}) AS f LEFT JOIN u ON f.PDT_COD = u.k
UNION ALL {_arms_a.replace('LEFT JOIN m ', 'LEFT JOIN ua AS m ')}""")


def precedence(spark, sf):
    coded = resolve.with_mapped_key(cleaned_master(spark, sf), ["EAN_COD", "PNL_C_COD", "PNL_A_COD", "PNL_D_COD"],
                                    "product_key")
    return resolve.resolve_by_key(panel(spark, sf, "D").select("PDT_COD", "CHL_COD", "SAL_TYP_COD", "LOA_DAT"), "PDT_COD",
                                  coded, "PNL_D_COD", ["product_key"])


add("product_precedence_key", precedence, f"""
WITH {SQL_MASTER}, m AS (SELECT {_cleaned} FROM master)
SELECT f.PDT_COD, CHL_COD, SAL_TYP_COD, LOA_DAT, coalesce(EAN_COD, PNL_C_COD, PNL_A_COD, PNL_D_COD) AS product_key
FROM ({sql_panel('D')}) AS f LEFT JOIN m ON f.PDT_COD = m.PNL_D_COD""")


# ---- new products --------------------------------------------------------------------

SOLD = ("SELECT sha2(upper(p_name), 256) AS PDT_COD, upper(p_name) AS PDT_PCK, 1 + l_linenumber % 2 AS SRC_COD, "
        "l_returnflag AS SRC_DSC_ORG, date_trunc('month', l_shipdate) AS LOA_DAT "
        "FROM {lineitem} JOIN {part} ON l_partkey = p_partkey")
KNOWN = ("SELECT DISTINCT sha2(upper(p_name), 256) AS PDT_COD, p_type AS CAT_DSC, "
         "CASE WHEN p_name LIKE 'red%' OR p_size % 50 = 0 THEN 'PANEL_I' ELSE 'PANEL_F' END AS ORG_DSC FROM {part} "
         "UNION ALL SELECT CAST(NULL AS {text}), 'PROMO', 'PANEL_I'")
CATEGORIES = ("SELECT DISTINCT CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN 1 ELSE 2 END AS SRC_COD, "
              "p_type AS CAT_DSC FROM {part} WHERE p_type <> 'MEDIUM'")


def detected(spark: SparkSession, sf: str) -> DataFrame:
    t = {"lineitem": table(spark, sf, "lineitem"), "part": table(spark, sf, "part")}
    return mastering.new_products(
        spark.sql(SOLD, **t), spark.sql(KNOWN.replace("{text}", "STRING"), part=t["part"]),
        spark.sql(CATEGORIES, part=t["part"]), "PANEL_I")


def _duck(text: str) -> str:
    return text.format(lineitem="lineitem", part="part", text="VARCHAR").replace(
        "sha2(upper(p_name), 256)", "sha256(upper(p_name))").replace(
        "date_trunc('month', l_shipdate)", "CAST(date_trunc('month', l_shipdate) AS TIMESTAMP)")


SQL_DETECTED = f"""sold AS ({_duck(SOLD)}), master AS ({_duck(KNOWN)}), scope AS ({_duck(CATEGORIES)}),
unseen AS (SELECT DISTINCT s.* FROM sold s
  WHERE NOT EXISTS (FROM master k WHERE k.ORG_DSC = 'PANEL_I' AND k.PDT_COD = s.PDT_COD)
    AND EXISTS (FROM master k SEMI JOIN scope USING (CAT_DSC) WHERE k.PDT_COD = s.PDT_COD
                AND EXISTS (FROM scope c WHERE c.SRC_COD = s.SRC_COD AND c.CAT_DSC = k.CAT_DSC)))"""
add("new_products_not_in", detected, f"WITH {SQL_DETECTED} SELECT * FROM unseen")

DESCRIBED = ("SELECT concat('company ', p_brand) AS CNY_DSC, p_name AS PDT_DSC, concat(' ', p_name) AS PDT_PCK, "
             "p_type AS CAT_DSC, concat('n', p_size) AS OTC_N01, p_type AS OTC_N02, p_brand AS OTC_N03, "
             "p_type AS OTC_N04, concat('file ', p_size) AS SRC_DSC_ORG, loa AS LOA_DAT FROM {parts}")


def enriched(spark, sf):
    parts = spark.sql(PARTS, part=table(spark, sf, "part"), lineitem=table(spark, sf, "lineitem"))
    return mastering.new_product_attributes(spark.sql(DESCRIBED, parts=parts), detected(spark, sf))


_enriched = ["CNY_DSC", "PDT_DSC", "PDT_PCK", "CAT_DSC", "OTC_N01", "OTC_N02", "OTC_N03", "OTC_N04", "SRC_COD",
             "SRC_DSC_ORG", "LOA_DAT"]
_ties = ["LOA_DAT", "CNY_DSC", "PDT_DSC", "CAT_DSC", "OTC_N01", "OTC_N02", "OTC_N03", "OTC_N04", "SRC_DSC_ORG", "SRC_COD"]
add("new_products_enriched", enriched, f"""
WITH {SQL_DETECTED}, parts AS ({PARTS.format(part='part', lineitem='lineitem')}),
offers AS (SELECT a.*, u.SRC_COD FROM ({DESCRIBED.format(parts='parts')}) a
           JOIN (SELECT PDT_PCK, SRC_COD FROM unseen GROUP BY ALL) u ON u.PDT_PCK = upper(trim(a.PDT_PCK)))
SELECT {', '.join(f'best.{c}' for c in _enriched)}
FROM (SELECT arg_max(o, ROW({', '.join('o.' + c for c in _ties)})) AS best FROM offers o GROUP BY o.PDT_PCK)""")


def sales_types(spark, sf):
    """Sales types whose codes come from the suppliers."""
    rows = table(spark, sf, "supplier").selectExpr(
        "CAST(s_suppkey + 100 AS INT) AS SAL_TYP_COD", "s_name AS SAL_TYP_DSC", "'erp' AS SOURCE_CODE",
        "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS LOA_DAT")
    return mastering.sales_type_dimension(rows)


add("sales_type_parent", sales_types, """
SELECT CAST(left(CAST(s_suppkey + 100 AS VARCHAR), 1) AS INTEGER) AS CHL_COD, CAST(s_suppkey + 100 AS INTEGER) AS SAL_TYP_COD,
  s_name AS SAL_TYP_DSC, 'erp' AS SOURCE_CODE, TIMESTAMP '2020-01-01 00:00:00' AS LOA_DAT FROM supplier""")
