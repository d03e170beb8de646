"""The star over the driver tables: a wide fact, its calendar and its tall form.

Every column names the table it comes from, so a query joins only what it uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.plans import calendars, star
from panelwright.sources.rows import inline_rows

from .registry import table

METRICS = ["Volumen Kg", "Valor €", "Unidades", "Volumen L"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
SALES_TYPES = ["F", "O", "P"]


def _position(c: str, values: list[str]) -> str:
    """A listed member's number; 99 for others, as in all lookups."""
    place = f"array_position(array({', '.join(repr(v) for v in values)}), {c})"
    return f"CAST(COALESCE(NULLIF({place}, 0), 99) AS INT)"


FORMAT = ("CASE WHEN p_size <= 10 THEN '1kg' WHEN p_size <= 20 THEN '500g' WHEN p_size <= 30 THEN '250ml' "
          "WHEN p_size <= 40 THEN 'Single' ELSE 'Multipack' END")
AREA = "CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'Core' ELSE 'Range' END"

# Star column → (table, Spark SQL expression).
COLUMNS: dict[str, tuple[str, str]] = {
    "product_id": ("part", "CAST(p_partkey AS INT)"),
    "product": ("part", "p_name"),
    "manufacturer": ("part", "p_brand"),
    "brand": ("part", "p_brand"),
    "sub_brand": ("part", "concat(p_brand, ' ', split_part(p_name, ' ', 1))"),
    "category": ("part", "p_type"),
    "category_id": ("part", _position("p_type", CATEGORIES)),
    "sub_category": ("part", "concat(p_type, ' ', split_part(p_name, ' ', 1))"),
    "business_area": ("part", AREA),
    "product_pack": ("part", "split_part(p_name, ' ', 2)"),
    "format": ("part", FORMAT),
    "etapas": ("part", "CASE WHEN p_size <= 25 THEN 'Growth' ELSE 'Mature' END"),
    "channel": ("customer", "c_mktsegment"),
    "channel_id": ("customer", _position("c_mktsegment", SEGMENTS)),
    "type_channel": ("customer", "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Offline' ELSE 'Online' END"),
    "sub_channel": ("orders", "o_orderpriority"),
    "sales_type": ("orders", "o_orderstatus"),
    "sales_type_id": ("orders", _position("o_orderstatus", SALES_TYPES)),
    "period_id": ("orders", "year(o_orderdate) * 100 + month(o_orderdate)"),
    "year": ("orders", "year(o_orderdate)"),
    "month_number": ("orders", "month(o_orderdate)"),
    "pidx": ("orders", "year(o_orderdate) * 12 + month(o_orderdate)"),
    "source": ("lineitem", "l_returnflag"),
    "geo": ("supplier", "n_name"),
    "market": ("supplier", "r_name"),
}
# Prices and discounts have two decimals: counted in cents and per cent, the net value is an exact whole number of
# ten-thousandths. That is cheaper per row than turning doubles into decimals.
KG = "CAST(CAST(l_quantity * 10000 AS BIGINT) AS DECIMAL(18,0))"
NET = ("CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) "
       "AS DECIMAL(18,0))")
TEN_THOUSANDTH = "CAST(0.0001 AS DECIMAL(5,4))"


def _exact(ten_thousandths: str) -> str:
    return f"CAST({ten_thousandths} * {TEN_THOUSANDTH} AS DECIMAL(18,4))"


def _in_months(months: tuple[int, int]) -> str:
    """A month range as a range of order dates, which reaches the scan's row-group statistics."""
    (y, m), (v, n) = (divmod(p - 1, 12) for p in (months[0], months[1] + 1))
    return (f"o_orderdate >= TIMESTAMP_NTZ '{y:04d}-{m + 1:02d}-01 00:00:00' "
            f"AND o_orderdate < TIMESTAMP_NTZ '{v:04d}-{n + 1:02d}-01 00:00:00'")


def lines(spark: SparkSession, sf_dir: str, columns: list[str], values: dict[str, str],
          with_format: bool = False, months: tuple[int, int] | None = None) -> DataFrame:
    """Lines with star columns and line values.

    Every table derives its columns before the join: dates are taken apart once
    per order, not once per line, and only what is asked for is shuffled.
    Tables that supply nothing are not joined.
    """
    by_table: dict[str, list[str]] = {}
    for c in columns:
        source, expression = COLUMNS[c]
        by_table.setdefault(source, []).append(f"{expression} AS {c}")
    if with_format:
        by_table.setdefault("part", []).extend([f"{FORMAT} AS _format", "p_size AS _size"])

    def side(name: str, *keys: str) -> DataFrame:
        rows = table(spark, sf_dir, name)
        if name == "orders" and months is not None:
            rows = rows.filter(_in_months(months))
        return rows.selectExpr(*keys, *by_table.get(name, []))

    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        *keys, *by_table.get("lineitem", []), *[f"{e} AS {n}" for n, e in values.items()]
    )
    if "part" in by_table:
        rows = rows.join(side("part", "p_partkey"), F.expr("l_partkey = p_partkey"))
    if "supplier" in by_table:
        nations = table(spark, sf_dir, "nation").join(
            table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
        )
        suppliers = table(spark, sf_dir, "supplier").join(nations, F.expr("s_nationkey = n_nationkey"))
        rows = rows.join(suppliers.selectExpr("s_suppkey", *by_table["supplier"]), F.expr("l_suppkey = s_suppkey"))
    if "orders" in by_table or "customer" in by_table:
        if "customer" in by_table:
            orders = side("orders", "o_orderkey", "o_custkey").join(
                side("customer", "c_custkey"), F.expr("o_custkey = c_custkey")
            )
        else:
            orders = side("orders", "o_orderkey")
        rows = rows.join(orders, F.expr("l_orderkey = o_orderkey"))
    return rows


def wide(spark: SparkSession, sf_dir: str, columns: list[str], metric: str = "Valor €",
         months: tuple[int, int] | None = None) -> DataFrame:
    """Fact rows of one metric with the asked columns and ``value``; of a range of months only, if given (the columns
    then include one of the period)."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    derived = metric in ("Unidades", "Volumen L")
    source = {"value": NET if metric == "Valor €" else KG}
    rows = lines(spark, sf_dir, columns, source, with_format=derived, months=months)
    exact = F.expr(_exact("value"))
    if metric == "Unidades":
        exact = star.derived_units(exact, star.unit_weight("_format")).cast("decimal(18,4)")
    elif metric == "Volumen L":
        factor = F.expr("CAST(1 + CAST(_size AS DECIMAL(5,2)) / 100 AS DECIMAL(9,4))")
        exact = star.derived_litres(exact, factor).cast("decimal(18,4)")
    return rows.select(*columns, exact.alias("value"))


def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "CAST(min(o_orderdate) AS DATE) AS min_date", "CAST(max(o_orderdate) AS DATE) AS max_date"
    )


def calendar(spark: SparkSession, sf_dir: str, as_of: str = "2001-08-15") -> DataFrame:
    """Months from the first to the last order."""
    return calendars.month_calendar(order_dates(spark, sf_dir), F.lit(as_of).cast("date"))


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar's two columns the windows need."""
    return calendars.month_index(order_dates(spark, sf_dir))


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consolidated gold mart: a volume and a value row per line, in one pass."""
    names = {"PER_DSC": "period_id", "PDT_COD": "product_id", "CHL_COD": "channel_id",
             "SAL_TYP_COD": "sales_type_id", "CTG_COD": "category_id", "PDT_PCK": "product_pack"}
    rows = lines(spark, sf_dir, list(names.values()), {"kg": KG, "net": NET})
    kinds = f"inline(array(('VOL', {_exact('kg')}), ('VAL', {_exact('net')}))) AS (KPI, SO_VALUE)"
    return rows.selectExpr(*[f"{c} AS {n}" for n, c in names.items()], kinds)


def base_without_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rows of the star that know their product by its number only: ``part`` is left to the product dimension."""
    rows = lines(spark, sf_dir, ["period_id", "channel_id", "sales_type_id"], {"product_id": "CAST(l_partkey AS INT)", "kg": KG, "net": NET})
    kinds = f"inline(array((1, {_exact('kg')}), (2, {_exact('net')}))) AS (kpi_flag_id, value)"
    return rows.selectExpr("period_id", "product_id", "channel_id", "sales_type_id", kinds)


def _of(table_name: str, *columns: str) -> list[str]:
    assert all(COLUMNS[c][0] == table_name for c in columns)
    return [f"{COLUMNS[c][1]} AS {c}" for c in columns]


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension with the columns the star names."""
    described = _of("part", "product_id", "product", "brand", "sub_brand", "manufacturer", "business_area", "category",
                    "category_id", "sub_category", "format", "etapas", "product_pack")
    return table(spark, sf_dir, "part").selectExpr(
        *described, "1 + p_size / 100D AS conversor_lkg", f"concat({AREA}, ' Market') AS market"
    )


def members(spark: SparkSession, schema: str, values: list[str], *more) -> DataFrame:
    """A small dimension of listed members and the one for others, as constant rows: their size is known to every plan."""
    return inline_rows(spark, schema, [(i, v, *[f(v) for f in more]) for i, v in [*enumerate(values, 1), (99, "NOT_ASSIGNED")]])


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(spark, "channel_id int, channel string, type_channel string, sub_channel string", SEGMENTS,
                   lambda v: "Offline" if v in ("BUILDING", "MACHINERY") else "Online", lambda v: f"{v} Sub")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = members(spark, "category_id int, category_name string", CATEGORIES)
    return rows.withColumn("source_id", F.expr("CAST(category_id % 3 + 1 AS INT)"))


def sales_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(spark, "sales_type_id int, sales_type string", SALES_TYPES)


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "DIM_PROD": products(spark, sf_dir),
        "DIM_CHANNEL": channels(spark, sf_dir),
        "DIM_SALES_TYPE": sales_types(spark, sf_dir),
        "DIM_UNITS": star.units_dimension(spark),
        "DIM_CALENDAR": calendar(spark, sf_dir),
        "DIM_CATEGORY": categories(spark, sf_dir),
    }


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tall star fact with the derived measures."""
    return star.tall_fact(star.base_fact(mart(spark, sf_dir)), products(spark, sf_dir))


# ---- SQL twins -------------------------------------------------------------------

SQL_KG = "CAST(l_quantity AS DECIMAL(18,4))"
SQL_NET = (
    "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))"
)
SQL_FORMAT = (
    "CASE WHEN p_size <= 10 THEN '1kg' WHEN p_size <= 20 THEN '500g' WHEN p_size <= 30 THEN '250ml' "
    "WHEN p_size <= 40 THEN 'Single' ELSE 'Multipack' END"
)
SQL_WEIGHT = (
    "CASE WHEN p_size <= 10 THEN 1.0 WHEN p_size <= 20 THEN 0.5 WHEN p_size <= 30 THEN 0.25 "
    "WHEN p_size <= 40 THEN 0.3 ELSE 1.2 END"
)
SQL_UNITS = f"CAST(round(l_quantity / CAST({SQL_WEIGHT} AS DOUBLE)) AS DECIMAL(18,4))"
SQL_LITRES = (
    f"CAST(round({SQL_KG} * CAST(1 + CAST(p_size AS DECIMAL(5,2)) / 100 AS DECIMAL(9,4)), 2) AS DECIMAL(18,4))"
)
SQL_VALUES = {"Volumen Kg": SQL_KG, "Valor €": SQL_NET, "Unidades": SQL_UNITS, "Volumen L": SQL_LITRES}


def _sql_position(c: str, values: list[str]) -> str:
    return "CASE " + c + " " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(values, 1)) + " ELSE 99 END"


SQL_COLUMNS = {
    "product_id": "CAST(p_partkey AS INTEGER)",
    "product": "p_name",
    "manufacturer": "p_brand",
    "brand": "p_brand",
    "sub_brand": "p_brand || ' ' || split_part(p_name, ' ', 1)",
    "category": "p_type",
    "category_id": _sql_position("p_type", CATEGORIES),
    "sub_category": "p_type || ' ' || split_part(p_name, ' ', 1)",
    "business_area": "CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'Core' ELSE 'Range' END",
    "product_pack": "split_part(p_name, ' ', 2)",
    "format": SQL_FORMAT,
    "etapas": "CASE WHEN p_size <= 25 THEN 'Growth' ELSE 'Mature' END",
    "channel": "c_mktsegment",
    "channel_id": _sql_position("c_mktsegment", SEGMENTS),
    "type_channel": "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Offline' ELSE 'Online' END",
    "sub_channel": "o_orderpriority",
    "sales_type": "o_orderstatus",
    "sales_type_id": _sql_position("o_orderstatus", SALES_TYPES),
    "period_id": "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER)",
    "year": "CAST(year(o_orderdate) AS INTEGER)",
    "month_number": "CAST(month(o_orderdate) AS INTEGER)",
    "pidx": "CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER)",
    "source": "l_returnflag",
    "geo": "n_name",
    "market": "r_name",
}
SQL_FROM = (
    "lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey "
    "JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)


def sql_wide(metric: str = "Valor €") -> str:
    """The ``wf`` common table."""
    columns = ", ".join(f"{e} AS {n}" for n, e in SQL_COLUMNS.items())
    return f"wf AS (SELECT {columns}, {SQL_VALUES[metric]} AS value FROM {SQL_FROM})"


SQL_CALENDAR = (
    "cal AS (SELECT CAST(d AS DATE) AS date, CAST(year(d) * 12 + month(d) AS INTEGER) AS pidx, "
    "CAST(year(d) * 100 + month(d) AS INTEGER) AS period_id FROM (SELECT unnest(generate_series("
    "date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS d "
    "FROM orders) AS days)"
)
