"""Star tables, calendars and checks over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.functions import dates
from panelwright.plans import calendars, measures, quality, reports, star

from .registry import add, table
from .star_view import (
    SQL_CALENDAR, SQL_COLUMNS, SQL_FORMAT, SQL_FROM, SQL_KG, SQL_LITRES, SQL_NET, SQL_UNITS, base_without_products, calendar,
    categories, dims, fact, mart, sql_wide, wide,
)

KEYS = ["period_id", "product_id", "channel_id", "sales_type_id", "category_id", "product_pack"]
_keys = ", ".join(f"{SQL_COLUMNS[k]} AS {k}" for k in KEYS)
SQL_FACT = "fact AS (" + " UNION ALL ".join(
    f"SELECT {_keys}, {flag} AS kpi_flag_id, CAST({value} AS DOUBLE) AS value FROM {SQL_FROM}"
    for flag, value in [(1, SQL_KG), (2, SQL_NET), (3, SQL_UNITS), (4, SQL_LITRES)]
) + ")"


def fact_rows(spark: SparkSession, sf: str) -> DataFrame:
    return fact(spark, sf).withColumn("value", F.col("value").cast("double"))


# ---- the tall fact ------------------------------------------------------------------

add("derived_measures_tall", fact_rows, f"WITH {SQL_FACT} SELECT * FROM fact")


def base_rows(spark, sf):
    return star.base_fact(mart(spark, sf)).withColumn("value", F.col("value").cast("double"))


add("star_base_fact", base_rows, f"WITH {SQL_FACT} SELECT * FROM fact WHERE kpi_flag_id <= 2")


def wide_to_tall(spark, sf):
    """Wide measure columns of a line as flag rows; a zero tax counts as not measured."""
    lines = table(spark, sf, "lineitem")
    tax = F.nullif(F.col("l_tax"), F.lit(0.0))
    flagged = {"VALUES": F.col("l_extendedprice"), "UNITS": F.col("l_quantity"), "TAX": tax}
    return star.tall_measures(lines, ["l_orderkey", "l_linenumber", "l_shipdate"], flagged)


add("wide_to_tall", wide_to_tall, """
SELECT l_orderkey, l_linenumber, l_shipdate, 'VALUES' AS KPI_FLG, l_extendedprice AS KPI_VAL FROM lineitem UNION ALL
SELECT l_orderkey, l_linenumber, l_shipdate, 'UNITS', l_quantity FROM lineitem UNION ALL
SELECT l_orderkey, l_linenumber, l_shipdate, 'TAX', l_tax FROM lineitem WHERE l_tax <> 0""")

# ---- wide and flat forms --------------------------------------------------------------

_names = {1: "Volumen Kg", 2: "Valor €", 3: "Unidades", 4: "Volumen L"}
_metric = "CASE kpi_flag_id " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _names.items()) + " END"
SQL_PRODUCTS = (
    "prod AS (SELECT " + ", ".join(
        f"{SQL_COLUMNS[c]} AS {c}" for c in ["product_id", "product", "brand", "sub_brand", "manufacturer",
                                             "business_area", "category", "sub_category", "etapas"])
    + f", {SQL_FORMAT} AS format, {SQL_COLUMNS['business_area']} || ' Market' AS market FROM part)"
)
SQL_CHANNELS = (
    f"chan AS (SELECT DISTINCT {SQL_COLUMNS['channel_id']} AS channel_id, c_mktsegment AS channel, "
    f"c_mktsegment || ' Sub' AS sub_channel, {SQL_COLUMNS['type_channel']} AS type_channel FROM customer)"
)
SQL_SALES_TYPES = f"styp AS (SELECT DISTINCT {SQL_COLUMNS['sales_type_id']} AS sales_type_id, o_orderstatus AS sales_type FROM orders)"
SQL_JOINED = ("fact LEFT JOIN prod USING (product_id) LEFT JOIN chan USING (channel_id) "
              "LEFT JOIN styp USING (sales_type_id) LEFT JOIN cal USING (period_id)")


def _wide_rows(spark, sf):
    return star.wide_fact(fact_rows(spark, sf), dims(spark, sf))


def _doubles(rows: DataFrame) -> DataFrame:
    return rows.withColumn("value", F.col("value").cast("double"))


add("wide_fact", _wide_rows, f"""
WITH {SQL_FACT}, {SQL_PRODUCTS}, {SQL_CHANNELS}, {SQL_SALES_TYPES}, {SQL_CALENDAR}
SELECT period_id, CAST(year(cal.date) AS INTEGER) AS year, CAST(month(cal.date) AS INTEGER) AS month_number,
  strftime(cal.date, '%B') AS month_long, strftime(cal.date, '%Y-%m') AS period_name, cal.date AS date, cal.pidx,
  product, brand, sub_brand, manufacturer, business_area, category, sub_category, format, etapas, market, channel,
  sub_channel, type_channel, sales_type, {_metric} AS metric, value FROM {SQL_JOINED}""")
add("flat_extract", lambda spark, sf: _doubles(star.wide_from_base(base_without_products(spark, sf), dims(spark, sf), star.FLAT_COLUMNS)), f"""
WITH {SQL_FACT}, {SQL_PRODUCTS}, {SQL_CHANNELS}, {SQL_SALES_TYPES}, {SQL_CALENDAR}
SELECT period_id, cal.date AS date, CAST(year(cal.date) AS INTEGER) AS year,
  CAST(quarter(cal.date) AS INTEGER) AS quarter, strftime(cal.date, '%B') AS month_long,
  strftime(cal.date, '%Y-%m') AS period_name, product, brand, sub_brand, manufacturer, business_area, category,
  sub_category, market, format, etapas, channel, sub_channel, type_channel, {_metric} AS metric, value
FROM {SQL_JOINED}""")


def star_report(spark, sf):
    """A report over the star itself: metric slicer on the fact, joined dimensions only."""
    rows = _doubles(star.wide_from_base(base_without_products(spark, sf), dims(spark, sf), ["metric", "manufacturer", "year", "value"]))
    rows = reports.apply_filters(rows, "Unidades")
    return rows.groupBy("manufacturer", "year").agg(F.sum("value").alias("units"))


add("star_metric_slicer", star_report, f"""
WITH {SQL_FACT}, {SQL_PRODUCTS} SELECT manufacturer, CAST(period_id // 100 AS INTEGER) AS year, sum(value) AS units
FROM fact JOIN prod USING (product_id) WHERE kpi_flag_id = 3 GROUP BY 1, 2""")


def units_use(spark, sf):
    """The measure catalogue with the rows and total of each measure (the fallback member has none)."""
    used = fact(spark, sf).groupBy("kpi_flag_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("value").cast("double").alias("total"))
    units = star.units_catalogue(spark)
    return units.join(used, F.col("KPI_FLG_COD") == F.col("kpi_flag_id"), "left").select(
        "KPI_FLG_COD", "KPI_FLG_DSC", "UNT_LBL", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
        F.round("total", 4).alias("total"))


# The measure catalogue.
add("units_catalogue_use", units_use, f"""
WITH {SQL_FACT}, u AS (SELECT * FROM (VALUES (1, 'Volume', 'Kg'), (2, 'Value', 'EUR'), (3, 'Units', 'Uds'),
  (4, 'Volume', 'L'), (99, 'Not Assigned', 'NA')) AS u(KPI_FLG_COD, KPI_FLG_DSC, UNT_LBL)),
s AS (SELECT kpi_flag_id, count(*) AS n, sum(CAST(value AS DECIMAL(18,4))) AS v FROM fact GROUP BY 1)
SELECT KPI_FLG_COD, KPI_FLG_DSC, UNT_LBL, coalesce(n, 0) AS n_rows, round(CAST(v AS DOUBLE), 4) AS total
FROM u LEFT JOIN s ON KPI_FLG_COD = kpi_flag_id""")

# ---- sources ----------------------------------------------------------------------------

_source_id = f"({SQL_COLUMNS['category_id']}) % 3 + 1"


def two_hop(spark, sf):
    """Volume rows of sell-in categories, over category → source."""
    rows = star.with_source(wide(spark, sf, ["category_id", "period_id"], "Volumen Kg"), categories(spark, sf))
    return rows.filter("source_id = 1").groupBy("period_id").agg(F.sum("value").cast("double").alias("volume"))


add("two_hop_source_filter", two_hop, f"""
WITH {sql_wide('Volumen Kg')} SELECT period_id, CAST(sum(value) AS DOUBLE) AS volume FROM wf
WHERE category_id % 3 + 1 = 1 GROUP BY 1""")


def loaded_rows(spark, sf):
    return wide(spark, sf, ["period_id", "category_id", "category"], "Volumen Kg")


_mmyyyy = "lpad(CAST({0} % 100 AS VARCHAR), 2, '0') || '/' || CAST({0} // 100 AS VARCHAR)"
_last = """SELECT max(period_id) AS last_period, max(period_id) FILTER (WHERE category_id % 3 + 1 = 1) AS sell_in,
  max(period_id) FILTER (WHERE category_id % 3 + 1 <> 1) AS sell_out FROM wf"""
add("last_loaded_by_source",
    lambda spark, sf: reports.last_loaded_by_source(loaded_rows(spark, sf), categories(spark, sf)), f"""
WITH {sql_wide()}, x AS ({_last}) SELECT last_period, sell_in, sell_out,
  {_mmyyyy.format('last_period')} AS last_period_label, {_mmyyyy.format('sell_in')} AS sell_in_label,
  {_mmyyyy.format('sell_out')} AS sell_out_label FROM x""")
add("loaded_periods", lambda spark, sf: reports.loaded_periods(loaded_rows(spark, sf), calendar(spark, sf)), f"""
WITH {sql_wide()}, {SQL_CALENDAR} SELECT period_id, CAST(year(cal.date) AS INTEGER) AS year,
  CAST(month(cal.date) AS INTEGER) AS month_number, strftime(cal.date, '%Y-%m') AS period_name, pidx
FROM cal WHERE period_id IN (SELECT period_id FROM wf)""")
add("last_loaded_period", lambda spark, sf: reports.last_loaded(loaded_rows(spark, sf), calendar(spark, sf)), f"""
WITH {sql_wide()}, {SQL_CALENDAR} SELECT max(strftime(cal.date, '%Y-%m')) AS period, count(*) AS loaded_periods
FROM cal WHERE period_id IN (SELECT period_id FROM wf)""")


def texts(spark, sf):
    out = measures.text_measures(loaded_rows(spark, sf), calendar(spark, sf), categories(spark, sf), 200012)
    names = ["fecha_l6m", "fecha_l6m_1", "ultimo", "ultimo_sell_in", "ultimo_sell_out", "seleccion", "segmento"]
    return out.toDF(*names)


add("text_measures", texts, f"""
WITH {sql_wide()}, {SQL_CALENDAR}, x AS ({_last})
SELECT 'Ventas: 07/2000 - 12/2000' AS fecha_l6m, 'Ventas: 01/2000 - 06/2000' AS fecha_l6m_1,
  'Último Período Cargado: ' || strftime((SELECT max(date) FROM cal), '%m/%Y') AS ultimo,
  'Último Período Cargado (Sell In): ' || {_mmyyyy.format('sell_in')} AS ultimo_sell_in,
  'Último Período Cargado (Sell Out): ' || {_mmyyyy.format('sell_out')} AS ultimo_sell_out,
  (SELECT max(date) FROM cal) AS seleccion,
  (SELECT CASE WHEN count(DISTINCT category) = 1 THEN min(category) ELSE 'SELECCIÓN MULTIPLE' END FROM wf) AS segmento
FROM x""")


def segment_text(spark, sf):
    return measures.selected_label(reports.apply_filters(loaded_rows(spark, sf), category=["PROMO"]), "category")


add("single_selection_label", segment_text,
    f"WITH {sql_wide()} SELECT CASE WHEN count(DISTINCT category) = 1 THEN min(category) ELSE 'SELECCIÓN MULTIPLE' END "
    "AS label FROM wf WHERE category IN ('PROMO')")


# ---- calendars --------------------------------------------------------------------------

_STAMP = "TIMESTAMP '2020-01-01 00:00:00'"
_SPARK_STAMP = "TIMESTAMP_NTZ '2020-01-01 00:00:00'"


def daily(spark, sf):
    """The whole daily calendar, with the orders of each day."""
    orders = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("_day")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    days = calendars.daily_calendar(spark, loaded_at=F.expr(_SPARK_STAMP))
    return days.join(orders, F.col("DAT_COD") == F.col("_day"), "left").drop("_day").withColumn(
        "n_orders", F.coalesce("n_orders", F.lit(0)).cast("bigint"))


add("dim_calendar_daily", daily, f"""
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1),
k AS (SELECT CAST(g AS DATE) AS d FROM (SELECT unnest(generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2070-12-31',
  INTERVAL 1 DAY)) AS g) AS s)
SELECT d AS DAT_COD, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DAT_KEY, CAST(strftime(d, '%Y%m') AS INTEGER) AS PER_KEY,
  CAST(year(d) AS INTEGER) AS YEA_COD, CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS SEM_COD,
  CASE WHEN month(d) <= 4 THEN 1 WHEN month(d) <= 8 THEN 2 ELSE 3 END AS QUA_COD, CAST(quarter(d) AS INTEGER) AS QUA_DSC,
  year(d) || '-Q' || quarter(d) AS YEA_QUA, CAST(month(d) AS INTEGER) AS MON_NUM, strftime(d, '%b') AS MON_SHR,
  strftime(d, '%B') AS MON_LNG, CAST(day(d) AS INTEGER) AS DAY_NUM, CAST(isodow(d) AS INTEGER) AS DAY_WEK_NUM,
  strftime(d, '%a') AS DAY_WEK_NAM, CAST(week(d) AS INTEGER) AS WEK_YEA,
  isoyear(d) || '-W' || lpad(CAST(week(d) AS VARCHAR), 2, '0') AS YEA_WEK_ISO, strftime(d, '%Y-%m') AS YEA_MON,
  strftime(d, '%b-%Y') AS PER_NAM, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS WEK_END,
  CASE WHEN day(d) = 1 THEN 1 ELSE 0 END AS MON_BGN, CASE WHEN last_day(d) = d THEN 1 ELSE 0 END AS MON_END,
  CASE WHEN date_trunc('quarter', d) = d THEN 1 ELSE 0 END AS QUA_BGN,
  CASE WHEN last_day(d) = d AND month(d) % 3 = 0 THEN 1 ELSE 0 END AS QUA_END,
  CASE WHEN date_trunc('year', d) = d THEN 1 ELSE 0 END AS YEA_BGN,
  CASE WHEN strftime(d, '%m-%d') = '12-31' THEN 1 ELSE 0 END AS YEA_END,
  'SHARED_CALENDAR' AS SRC_DSC_ORG, {_STAMP} AS LOA_DAT, coalesce(n, 0) AS n_orders
FROM k LEFT JOIN o ON k.d = o.day""")


def national(spark, sf):
    """National calendar of a fact with 6- and 8-digit periods."""
    orders = table(spark, sf, "orders")
    period = F.when(F.col("o_orderstatus") == "F", dates.month_int("o_orderdate")).otherwise(dates.date_int("o_orderdate"))
    return calendars.national_calendar(
        orders.select(period.alias("PER_DSC")), as_of=F.lit("2001-03-10").cast("date"), loaded_at=F.expr(_SPARK_STAMP))


_pt_short = "['JAN','FEV','MAR','ABR','MAI','JUN','JUL','AGO','SET','OUT','NOV','DEZ'][month(d)]"
_pt_long = ("['JANEIRO','FEVEREIRO','MARÇO','ABRIL','MAIO','JUNHO','JULHO','AGOSTO','SETEMBRO','OUTUBRO','NOVEMBRO',"
            "'DEZEMBRO'][month(d)]")
add("dim_calendar_month", national, f"""
WITH p AS (SELECT CASE WHEN o_orderstatus = 'F' THEN date_trunc('month', o_orderdate) ELSE o_orderdate END AS d FROM orders),
k AS (SELECT CAST(g AS DATE) AS d FROM (SELECT unnest(generate_series(date_trunc('month', min(d)),
  date_trunc('month', max(d)), INTERVAL 1 MONTH)) AS g FROM p) AS s)
SELECT d AS DAT_COD, CAST(d - INTERVAL 12 MONTH AS DATE) AS DAT_LSY, CAST(strftime(d, '%Y%m') AS INTEGER) AS PER_DSC,
  CAST(year(d) AS INTEGER) AS YEA_DSC, CAST(year(d) - 1 AS INTEGER) AS YEA_LSY, CAST(month(d) AS INTEGER) AS MON_NUM,
  {_pt_short} AS MON_SHR, {_pt_long} AS MON_LNG, CAST(quarter(d) AS INTEGER) AS QUA_DSC,
  year(d) || '-Q' || quarter(d) AS YEA_QUA, year(d) || ' ' || {_pt_short} AS PER_NAM,
  CASE WHEN d = DATE '2001-03-01' THEN 1 ELSE 0 END AS CUR_MON,
  CASE WHEN month(d) = (SELECT month(max(d)) FROM k) THEN 'Mes Actual' ELSE 'Otros Meses' END AS MAX_MON,
  CASE WHEN year(d) = (SELECT year(max(d)) FROM k) THEN 'Año Actual' ELSE 'Otros Años' END AS MAX_YEA,
  'GOLD_CALENDAR' AS SRC_DSC_ORG, {_STAMP} AS LOA_DAT FROM k""")

add("star_calendar", lambda spark, sf: calendar(spark, sf), f"""
WITH {SQL_CALENDAR} SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(month(date) AS INTEGER) AS month_number, strftime(date, '%b') AS month_short, strftime(date, '%B') AS month_long,
  period_id, strftime(date, '%Y-%m') AS period_name, year(date) || '-Q' || quarter(date) AS year_quarter,
  CAST(year(date) - 1 AS INTEGER) AS year_ly, CAST(date - INTERVAL 12 MONTH AS DATE) AS date_ly,
  CASE WHEN year(date) = 2001 THEN 1 ELSE 0 END AS current_year,
  CASE WHEN date = DATE '2001-08-01' THEN 1 ELSE 0 END AS current_month, pidx FROM cal""")


# ---- quality ----------------------------------------------------------------------------

def dq(spark, sf):
    """Referential checks of the lines against whole dimensions."""
    return quality.referential_report(
        table(spark, sf, "lineitem"),
        {
            "order": ("l_orderkey", table(spark, sf, "orders"), "o_orderkey"),
            "part": ("l_partkey", table(spark, sf, "part"), "p_partkey"),
            "supplier": ("l_suppkey", table(spark, sf, "supplier"), "s_suppkey"),
        },
        "l_quantity",
    )


_checks = []
for _n, _k, _d in [("order", "l_orderkey", "SELECT o_orderkey FROM orders"),
                   ("part", "l_partkey", "SELECT p_partkey FROM part"),
                   ("supplier", "l_suppkey", "SELECT s_suppkey FROM supplier")]:
    _checks.append(f"SELECT 'orphan_{_n}' AS check_name, count(*) AS rows_failing FROM lineitem "
                   f"WHERE {_k} IS NOT NULL AND {_k} NOT IN ({_d})")
    _checks.append(f"SELECT 'null_{_k}', count(*) FROM lineitem WHERE {_k} IS NULL")
_checks.append("SELECT 'null_l_quantity', count(*) FROM lineitem WHERE l_quantity IS NULL")
_checks.append("SELECT 'negative_l_quantity', count(*) FROM lineitem WHERE l_quantity < 0")
add("dq_referential", dq, " UNION ALL ".join(_checks))
