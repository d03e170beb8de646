"""The star: constant dimensions, the tall fact with derived measures, wide and flat forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import dates, keys
from ..operators import dictionary, feeds
from ..schemas import STAR_COLUMNS, star_schema
from ..sources.layers import Warehouse
from ..sources.rows import inline_rows

# The four measures of the star.
UNITS = [
    (1, "Volume", "Kg", "Volumen Kg"),
    (2, "Value", "EUR", "Valor €"),
    (3, "Units", "Uds", "Unidades"),
    (4, "Volume", "L", "Volumen L"),
]
# The measure catalogue of the warehouse, with the fallback member.
UNITS_CATALOGUE = [
    (1, "Volume", "Kg"),
    (2, "Value", "EUR"),
    (3, "Units", "Uds"),
    (4, "Volume", "L"),
    (99, "Not Assigned", "NA"),
]
# Weight of one unit by format.
UNIT_WEIGHTS = {
    "1kg": "1.0", "500g": "0.5", "200g": "0.2", "1l": "1.0", "250ml": "0.25", "500ml": "0.5",
    "single": "0.3", "multipack": "1.2",
}
OTHER_WEIGHT = "0.5"
# The columns of the flat extract, in order.
FLAT_COLUMNS = [
    "period_id", "date", "year", "quarter", "month_long", "period_name", "product", "brand", "sub_brand",
    "manufacturer", "business_area", "category", "sub_category", "market", "format", "etapas", "channel",
    "sub_channel", "type_channel", "metric", "value",
]
# The columns of the wide fact, in order.
WIDE_COLUMNS = [
    "period_id", "year", "month_number", "month_long", "period_name", "date", "pidx", "product", "brand",
    "sub_brand", "manufacturer", "business_area", "category", "sub_category", "format", "etapas", "market",
    "channel", "sub_channel", "type_channel", "sales_type", "metric", "value",
]
# Which dimension a fact key leads to.
RELATIONS = {
    "DIM_PROD": "product_id",
    "DIM_CHANNEL": "channel_id",
    "DIM_SALES_TYPE": "sales_type_id",
    "DIM_UNITS": "kpi_flag_id",
    "DIM_CALENDAR": "period_id",
    "DIM_CATEGORY": "category_id",
}


def units_dimension(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, star_schema("DIM_UNITS"), UNITS)


def product_dimension(products: DataFrame, numbers: DataFrame, category_numbers: DataFrame) -> DataFrame:
    """Products under their numbers, and the member for what is not assigned. The master has no litres per kilogram: 1."""
    numbered = dictionary.number_of(products, numbers.withColumnRenamed("number", "product_id"), "member", "product_id", "PDT_COD")
    numbered = dictionary.number_of(numbered, category_numbers.withColumnRenamed("number", "category_id"), "member", "category_id", "CAT_DSC")
    described = {
        "product_id": F.col("product_id"), "product_name": F.col("PDT_DSC"), "brand": F.col("BRD_DSC"), "business_area": F.col("NET_ARE"),
        "business_sub_area": F.col("SUB_NET_ARE"), "category": F.col("CAT_DSC"), "category_id": F.col("category_id"), "format": F.col("FOR_WGH"),
        "etapas": F.col("ETP_COD"), "ep": F.col("VOL_QTY").try_cast("double"), "cunits": F.col("UNT_PCK").try_cast("int"),
        "conversor_lkg": F.lit(1.0), "product_pack": F.col("PDT_PCK"), "manufacturer": F.col("CNY_DSC"), "market": F.col("GLB_REP"),
        "sub_category": F.col("SUB_CAT_DSC"), "sub_brand": F.col("SUB_BRD_DSC"), "product": F.col("PDT_DSC"),
    }
    rows = numbered.select(*[described[name].cast(kind).alias(name) for _, name, kind in STAR_COLUMNS["DIM_PROD"]])
    return rows.unionByName(_not_assigned(products.sparkSession, "DIM_PROD", "product_id").withColumn("conversor_lkg", F.lit(1.0)))


def category_dimension(products: DataFrame, numbers: DataFrame, source_numbers: DataFrame) -> DataFrame:
    """Categories under their numbers, with the first of their sources."""
    first = products.where("CAT_DSC is not null").groupBy("CAT_DSC").agg(F.min("ORG_DSC").alias("ORG_DSC"))
    with_source = dictionary.number_of(first, source_numbers.withColumnRenamed("number", "source_id"), "member", "source_id", "ORG_DSC")
    named = dictionary.number_of(with_source, numbers.withColumnRenamed("number", "category_id"), "member", "category_id", "CAT_DSC")
    rows = named.select("category_id", F.col("CAT_DSC").alias("category_name"), "source_id")
    return rows.unionByName(_not_assigned(products.sparkSession, "DIM_CATEGORY", "category_id"))


def source_dimension(numbers: DataFrame) -> DataFrame:
    rows = numbers.select(F.col("number").alias("source_id"), F.col("member").alias("source_name"))
    return rows.unionByName(_not_assigned(numbers.sparkSession, "DIM_SOURCE", "source_id"))


def channel_dimension(mapping: DataFrame) -> DataFrame:
    """A member per channel code, named by the first of the labels that lead to it."""
    name = F.min(keys.norm("CHL_SRC"))
    rows = mapping.where("CHL_COD is not null AND CHL_COD <> 99").groupBy(F.col("CHL_COD").alias("channel_id")).agg(name.alias("channel_name"))
    online = F.col("channel_name").contains("ONLINE")
    rows = rows.select("channel_id", "channel_name", F.col("channel_name").alias("channel"), F.col("channel_name").alias("sub_channel"),
                       F.when(online, "Online").otherwise("Offline").alias("type_channel"))
    return rows.unionByName(_not_assigned(mapping.sparkSession, "DIM_CHANNEL", "channel_id"))


def sales_type_dimension(mapping: DataFrame) -> DataFrame:
    """A member per sales-type code, named by the first of the labels that lead to it."""
    rows = mapping.where("SAL_TYP_COD is not null AND SAL_TYP_COD <> 99").groupBy(F.col("SAL_TYP_COD").alias("sales_type_id")).agg(
        F.min(keys.norm("SAL_TYP_SRC")).alias("sales_type"))
    return rows.unionByName(_not_assigned(mapping.sparkSession, "DIM_SALES_TYPE", "sales_type_id"))


def _not_assigned(spark: SparkSession, table: str, key: str) -> DataFrame:
    """The member for what is not assigned: its number and labels, NULL for amounts."""
    cells = tuple(dictionary.NOT_ASSIGNED if name == key or name.endswith("_id") else keys.NOT_ASSIGNED_LABEL if kind == "string" else None
                  for _, name, kind in STAR_COLUMNS[table])
    return inline_rows(spark, star_schema(table), [cells])


def units_catalogue(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, "KPI_FLG_COD int, KPI_FLG_DSC string, UNT_LBL string", UNITS_CATALOGUE)


def create_star_tables(warehouse: Warehouse) -> None:
    """Declared, empty dimensions and the constant one."""
    for table in ["DIM_SOURCE", "DIM_CATEGORY", "DIM_SALES_TYPE", "DIM_CHANNEL", "DIM_PROD"]:
        warehouse.create_empty(star_schema(table), "GOLD_STAR", table)
    warehouse.replace(units_dimension(warehouse.spark), "GOLD_STAR", "DIM_UNITS")


def unit_weight(format_: Column | str) -> Column:
    """Weight per unit of a format, case-insensitive."""
    text = F.lower(F.col(format_) if isinstance(format_, str) else format_)
    expr = None
    for name, weight in UNIT_WEIGHTS.items():
        value = F.lit(weight).cast("decimal(4,2)")
        expr = F.when(text == name, value) if expr is None else expr.when(text == name, value)
    return expr.otherwise(F.lit(OTHER_WEIGHT).cast("decimal(4,2)"))


def derived_units(kg: Column, weight: Column) -> Column:
    return F.round(F.try_divide(kg, F.nullif(weight, F.lit(0).cast("decimal(4,2)"))), 0)


def derived_litres(kg: Column, factor: Column) -> Column:
    return F.round(kg * factor, 2)


def _factors(products: DataFrame, *wanted: str) -> DataFrame:
    """What the derived measures need of a product, and the asked columns."""
    return products.select(
        F.col("product_id").alias("_product"),
        unit_weight("format").alias("_weight"),
        F.col("conversor_lkg").cast("decimal(9,4)").alias("_litres_per_kg"),
        *wanted,
    )


def _with_derived(joined: DataFrame, keep: list[str]) -> DataFrame:
    """Each base row with its product's factors turns into itself and, for a volume row of a known product, its two derived
    rows."""
    kg = F.col("value").cast("decimal(18,4)")
    derivable = (F.col("kpi_flag_id") == 1) & F.col("_product").isNotNull()

    def entry(flag: Column, value: Column) -> Column:
        return F.struct(flag.cast("int").alias("kpi_flag_id"), value.cast("decimal(18,4)").alias("value"))

    own = entry(F.col("kpi_flag_id"), kg)
    derived = [entry(F.lit(3), derived_units(kg, F.col("_weight"))), entry(F.lit(4), derived_litres(kg, F.col("_litres_per_kg")))]
    # a choice of arrays is compiled; a filter over one array is interpreted row by row
    rows = F.when(derivable, F.array(own, *derived)).otherwise(F.array(own))
    return joined.select(*keep, F.inline(rows))


def tall_fact(base: DataFrame, products: DataFrame, deal_by: str | None = None) -> DataFrame:
    """The star fact: base measures plus units (3) and litres (4) derived from the volume, in one pass over ``base``.

    With ``deal_by``, rows are dealt to writers by that column before the derived ones are made: half the rows to exchange."""
    joined = base.join(_factors(products), base["product_id"] == F.col("_product"), "left")
    if deal_by:
        joined = joined.hint("rebalance", deal_by)
    keys_ = [name for _, name, _ in STAR_COLUMNS["FACT_TABLE"] if name not in ("kpi_flag_id", "value")]
    return _with_derived(joined, keys_).select(*[name for _, name, _ in STAR_COLUMNS["FACT_TABLE"]])


def wide_from_base(base: DataFrame, dims: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """The wide rows of the base measures and those derived from them.

    The same as ``wide_fact(tall_fact(base, ...), dims)``, but the star is joined before the derived rows are made: a base
    row is joined once, and the product dimension, the one that may be large, serves factors and columns in one join. What
    ``base`` lacks of the asked columns, its keys aside, comes from the dimensions.
    """
    columns = columns or WIDE_COLUMNS
    needed = needed_dimensions(columns, {*base.columns, "kpi_flag_id", "value"})
    after = needed.pop("DIM_UNITS", [])
    out = base.join(_factors(dims["DIM_PROD"], *needed.pop("DIM_PROD", [])), F.col("product_id") == F.col("_product"), "left")
    for table, wanted in needed.items():
        out = out.join(dims[table].select(RELATIONS[table], *wanted), RELATIONS[table], "left")
    keep = [c for c in columns if c not in after and c not in ("kpi_flag_id", "value", "pidx")]
    if "pidx" in columns and "period_id" not in keep:
        keep.append("period_id")
    out = _with_derived(out, keep)
    if after:
        out = out.join(dims["DIM_UNITS"].select(RELATIONS["DIM_UNITS"], *after), RELATIONS["DIM_UNITS"], "left")
    if "pidx" in columns:
        out = out.withColumn("pidx", dates.pidx_of_period("period_id"))
    return out.select(*columns)


def base_fact(mart: DataFrame) -> DataFrame:
    """Consolidated gold mart → base rows of the star fact (volume is 1, anything else 2)."""
    return mart.select(
        F.col("PER_DSC").cast("int").alias("period_id"),
        F.col("PDT_COD").cast("int").alias("product_id"),
        F.col("CHL_COD").cast("int").alias("channel_id"),
        F.col("SAL_TYP_COD").cast("int").alias("sales_type_id"),
        F.when(F.col("KPI") == "VOL", 1).otherwise(2).alias("kpi_flag_id"),
        F.col("CTG_COD").cast("int").alias("category_id"),
        F.col("PDT_PCK").alias("product_pack"),
        F.col("SO_VALUE").cast("decimal(18,4)").alias("value"),
    )


def _dimension_of(column: str) -> str:
    for table in RELATIONS:
        if column != RELATIONS[table] and any(column == name for _, name, _ in STAR_COLUMNS[table]):
            return table
    raise ValueError(f"no dimension has a column {column}")


def needed_dimensions(columns: list[str], own: set[str]) -> dict[str, list[str]]:
    """Dimension → the asked columns that it supplies."""
    needed: dict[str, list[str]] = {}
    for column in columns:
        if column not in own and column != "pidx":
            needed.setdefault(_dimension_of(column), []).append(column)
    return needed


def wide_fact(fact: DataFrame, dims: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Star join. Only the dimensions that supply an asked column are joined.

    A left join to a dimension cannot be dropped by the optimizer when nothing
    of it is used (the key might repeat), so it is not built in the first place.
    No join is hinted here: dimensions are broadcast when their size allows it,
    but for those that come with a hint (``lookup.without_large_broadcast``).
    """
    columns = columns or WIDE_COLUMNS
    out = fact
    for table, wanted in needed_dimensions(columns, set(fact.columns)).items():
        key = RELATIONS[table]
        out = out.join(dims[table].select(key, *wanted), key, "left")
    if "pidx" in columns:
        out = out.withColumn("pidx", dates.pidx_of_period("period_id"))
    return out.select(*columns)


def write_colocated(spark: SparkSession, fact: DataFrame, dims: dict[str, DataFrame], database: str, path: str, buckets: int) -> None:
    """The fact and the product dimension as catalog tables in equal buckets of the product, the small dimensions with
    statistics: the star join then needs no exchange of the fact, whatever the sizes. A product with most of the rows makes
    one bucket large; its files are read by one task each, so choose buckets by the largest product."""
    for table, rows in (("FACT_TABLE", fact), ("DIM_PROD", dims["DIM_PROD"])):
        bucketed = rows.repartition(buckets, "product_id").sortWithinPartitions("product_id")
        bucketed.write.mode("overwrite").bucketBy(buckets, "product_id").sortBy("product_id").option("path", f"{path}/{table}").saveAsTable(
            f"{database}.{table}")
    for table in RELATIONS:
        if table != "DIM_PROD":
            dims[table].coalesce(1).write.mode("overwrite").option("path", f"{path}/{table}").saveAsTable(f"{database}.{table}")
            spark.sql(f"ANALYZE TABLE {database}.{table} COMPUTE STATISTICS")


def read_colocated(spark: SparkSession, database: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    return spark.table(f"{database}.FACT_TABLE"), {t: spark.table(f"{database}.{t}") for t in RELATIONS}


def flat_extract(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The denormalised extract, 21 columns."""
    return wide_fact(fact, dims, FLAT_COLUMNS)


def with_source(fact: DataFrame, categories: DataFrame) -> DataFrame:
    """Source of a fact row over its category (the two-hop arm)."""
    return fact.join(categories.select("category_id", "source_id"), "category_id", "left")


def context_fact(series: DataFrame, calendar: DataFrame) -> DataFrame:
    """Monthly context series, tied to the model through the calendar only."""
    months = calendar.select("period_id", "year", F.upper("month_short").alias("month_short"))
    return series.join(months, "period_id").select("year", "month_short", "value", "period_id")


def context_series(context: DataFrame, calendar: DataFrame) -> DataFrame:
    """The context series with readable labels; months the calendar lacks keep their row."""
    labels = calendar.select("period_id", "month_long", "period_name")
    return context.join(labels, "period_id", "left").select("period_id", "year", "month_long", "period_name", "value")


def tall_measures(wide: DataFrame, ids: list[str], measures: dict[str, Column]) -> DataFrame:
    """Wide measure columns → (measure flag, value) rows, as the flag-based panels keep them."""
    return feeds.wide_to_tall(wide, ids, measures, "KPI_FLG", "KPI_VAL")
