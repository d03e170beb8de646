"""Panel loads, deduplication, reloads and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.functions import dates, keys
from panelwright.operators import dedup, feeds, incremental, lookup
from panelwright.plans import panels

from .registry import add, table
from .staging import MAPPINGS, STAGING, base, mapping, sql_base, sql_mapping, sql_staging, staging

CUT = "TIMESTAMP '2000-12-31 00:00:00'"
EPOCH = "TIMESTAMP '1900-01-01 00:00:00'"


# ---- SQL twins of a panel load -----------------------------------------------------

# Fixed values, written out a second time so that the twins don't follow the library: what tells versions of a row apart,
# and the columns of each fact.
KEYS = {
    "PANEL_A_FOOD": ["PDT_DSC", "PDT_COD", "PER_ALL", "PER_INI", "PER_FIN", "SO_UNITS", "SO_VALUES", "SO_KILOS"],
    "PANEL_A_MILK": ["PDT_DSC", "PDT_COD", "PER_ALL", "PER_INI", "PER_FIN"],
    "PANEL_B": ["GEO_DSC", "PER_DSC", "PDT_PCK", "PDT_COD", "UPC_COD", "CNY_DSC", "BRD_DSC", "SGM_DSC", "SSG_DSC",
        "SBR_DSC", "STG_DSC", "CPC_DSC", "SO_VALUES", "SO_UNITS", "SO_KILOS"],
    "PANEL_C": ["PDT_COD", "PDT_PCK", "CTG_DSC", "SO_VALUES", "SO_UNITS", "SO_KILOS", "PER_DSC"],
    "PANEL_D_UNION": ["GEO_COD", "PDT_COD", "CHL_COD", "SRC_DSC", "PER_DSC", "SO_VALUES", "SO_UNITS"],
    "PANEL_F": ["MKT_DSC", "GEO_DSC", "CAT_DSC", "PER_DSC", "KPI_FLG"],
    "PANEL_G": ["MKT_DSC", "GEO_DSC", "PDT_DSC", "PER_DSC", "KPI_FLG"],
    "PANEL_H": ["CNY_DSC", "PDT_DSC", "PDT_PCK", "GEO_COD", "PER_DSC", "KPI_FLG"],
    "PANEL_I": ["CNY_DSC", "PDT_DSC", "PDT_PCK", "CAT_DSC", "OTC_1_DSC", "OTC_2_DSC", "OTC_3_DSC", "OTC_4_DSC",
        "KPI_FLG", "PER_DSC"],
    "PANEL_E_OTHERS": ["CHL_DSC", "PDT_PCK", "CAT_DSC", "CNY_DSC", "SGM_DSC", "BRD_DSC", "VRY_DSC", "SVR_DSC",
        "SBR_DSC", "CPC_N01", "CPC_N02", "UPC_COD", "KPI_FLG", "PER_DSC"],
    "PANEL_E_PHARMA": ["MKT_DSC", "GEO_DSC", "TYP_MKT_DSC", "SGM_DSC", "SGM_SUB_DSC", "CNY_DSC", "PDT_DSC", "PDT_PCK",
        "KPI_FLG", "PER_DSC"],
    "PANEL_D_UNION_TRA": ["GEO_COD", "PDT_COD", "CHL_COD", "SRC_DSC", "PER_DSC", "SAL_VAL", "SAL_UNT"],
}
OUTPUT = {
    "PANEL_A_FOOD": ["PDT_COD", "CHL_COD", "SAL_TYP_COD", "SRC_DSC", "PER_DSC", "SO_VALUES", "SO_UNITS", "SO_KILOS",
        "SOURCE_CODE", "LOA_DAT"],
    "PANEL_A_MILK": ["PDT_COD", "CHL_COD", "SAL_TYP_COD", "SRC_DSC", "PER_DSC", "SO_VALUES", "SO_UNITS", "SO_KILOS",
        "SOURCE_CODE", "LOA_DAT"],
    "PANEL_B": ["GEO_COD", "GEO_DSC", "PDT_COD", "CHL_COD", "SAL_TYP_COD", "SRC_DSC", "PER_DSC", "SO_VALUES",
        "SO_UNITS", "SO_KILOS", "SOURCE_CODE", "LOA_DAT"],
    "PANEL_C": ["PDT_COD", "CHL_COD", "SAL_TYP_COD", "SRC_DSC", "PER_DSC", "SO_VALUES", "SO_UNITS", "SO_KILOS",
        "SOURCE_CODE", "LOA_DAT"],
    "PANEL_D_UNION": ["GEO_COD", "PDT_COD", "PER_DSC", "SRC_DSC", "SO_VALUES", "SO_UNITS", "CHL_COD", "SAL_TYP_COD",
        "SOURCE_CODE", "LOA_DAT"],
    "PANEL_F": ["PDT_COD", "PDT_PCK", "CHL_COD", "SAL_TYP_COD", "KPI_FLG_COD", "KPI_VAL", "PER_DSC", "SRC_COD",
        "SRC_DSC_ORG", "LOA_DAT"],
    "PANEL_G": ["PDT_COD", "PDT_PCK", "CHL_COD", "SAL_TYP_COD", "KPI_FLG_COD", "KPI_VAL", "PER_DSC", "SRC_COD",
        "SRC_DSC_ORG", "LOA_DAT"],
    "PANEL_H": ["PDT_COD", "PDT_PCK", "CHL_COD", "SAL_TYP_COD", "KPI_FLG_COD", "KPI_VAL", "PER_DSC", "SRC_COD",
        "SRC_DSC_ORG", "LOA_DAT"],
    "PANEL_I": ["PDT_COD", "PDT_PCK", "CHL_COD", "SAL_TYP_COD", "KPI_FLG_COD", "KPI_VAL", "PER_DSC", "SRC_COD",
        "SRC_DSC_ORG", "LOA_DAT"],
    "PANEL_E_OTHERS": ["PDT_COD", "PDT_PCK", "CHL_DSC", "CAT_DSC", "CNY_DSC", "SGM_DSC", "BRD_DSC", "VRY_DSC",
        "SVR_DSC", "SBR_DSC", "CPC_N01", "CPC_N02", "UPC_COD", "CHL_COD", "PER_DSC", "SRC_COD", "SAL_TYP_COD",
        "KPI_FLG_COD", "KPI_VAL", "LOA_DAT", "SRC_DSC_ORG"],
    "PANEL_E_PHARMA": ["PDT_COD", "PDT_PCK", "CHL_COD", "SAL_TYP_COD", "KPI_FLG_COD", "KPI_VAL", "PER_DSC", "SRC_COD",
        "SRC_DSC_ORG", "LOA_DAT"],
    "PANEL_D_UNION_TRA": ["GEO_COD", "PDT_COD", "PER_DSC", "SRC_DSC", "SAL_TYP_COD", "CHL_COD", "SAL_VAL", "SAL_UNT",
        "SAL_CUN", "SAL_PVA_VAL", "SRC_DSC_ORG", "LOA_DAT", "SAL_ORG_COD"],
}

def _columns(stage: str) -> list[str]:
    return list(STAGING[stage])


def sql_latest(source: str, keys_: list[str], columns: list[str], where: str) -> str:
    """Latest version per key; ties by every other column, greatest first."""
    ties = [c for c in columns if c not in keys_ and c != "LOA_DAT"]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["LOA_DAT", *ties])
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys_)} ORDER BY {order}) AS rn "
            f"FROM {source} WHERE {where}) AS v WHERE rn = 1")


ISO = "TRY_CAST(strftime(try_strptime({0}, '{1}'), '%Y%m%d') AS INTEGER)"
# Portuguese month labels.
LABEL = ("'20' || nullif(regexp_extract(PER_DSC, '([0-9]{2})\\s*$', 1), '') || CASE substr(lower(PER_DSC), 1, 3) "
         + " ".join(f"WHEN '{m}' THEN '{i:02d}'" for i, m in enumerate(
             ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"], 1))
         + " ELSE '00' END")


def _fixed_code(mapping_name: str, label: str, code: str, source: str) -> str:
    return (f"coalesce((SELECT max({code}) FROM {mapping_name} WHERE SRC_DSC = '{source}' "
            f"AND upper(trim({label})) = '{source}'), 99) AS {code}")


def _pt_sql(name: str, period: str, geo: bool = False) -> str:
    shown = "sha256(upper(trim(GEO_DSC))) AS GEO_COD, GEO_DSC, " if geo else ""
    return (f"SELECT {shown}PDT_COD, {_fixed_code('MAP_PT_CHANNEL', 'CHL_SRC', 'CHL_COD', name)}, "
            f"{_fixed_code('MAP_PT_SALES_TYPE', 'SAL_TYP_SRC', 'SAL_TYP_COD', name)}, '{name}' AS SRC_DSC, "
            f"{period} AS PER_DSC, SO_VALUES, SO_UNITS, SO_KILOS, SOURCE_CODE, LOA_DAT FROM latest")


PT_MAPS = f"{sql_mapping('MAP_PT_CHANNEL')}, {sql_mapping('MAP_PT_SALES_TYPE')}"
ES_MAPS = f"{sql_mapping('MAP_ES_CHANNEL')}, {sql_mapping('MAP_ES_SALES_TYPE')}, {sql_mapping('MAP_ES_UNITS')}"
WIDE_PANELS = {
    "PANEL_A_FOOD": (ISO.format("PER_INI", "%Y-%m-%d"), "PDT_DSC <> 'TOTAL'"),
    "PANEL_A_MILK": (ISO.format("PER_INI", "%d/%m/%Y"), "PDT_DSC <> 'TOTAL'"),
    "PANEL_B": (LABEL, "true"),
    "PANEL_C": (ISO.format("PER_DSC", "%m/%d/%Y"), "true"),
}


def _load(spark: SparkSession, sf: str, name: str, watermark=None, before: str | None = None) -> DataFrame:
    panel = panels.PANELS[name]
    names = list(panel.feed_sources.values()) or [panel.staging]
    tables = {n: staging(spark, sf, n) for n in names}
    if before:
        tables = {n: t.filter(f"LOA_DAT <= {before}") for n, t in tables.items()}
    return panels.load(panel, tables, {m: mapping(spark, m) for m in MAPPINGS}, watermark)


def _doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines show one type."""
    return df.withColumns(
        {f.name: F.col(f.name).cast("double") for f in df.schema.fields if f.dataType.typeName() == "decimal"})


def _sql_doubles(body: str, columns: list[str]) -> str:
    shown = ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" if c.startswith(("SO_V", "SO_U", "SO_K", "KPI_V", "SAL_V", "SAL_UN", "SAL_CU",
                                                       "SAL_P", "SAL_W")) else c for c in columns)
    return f"SELECT {shown} FROM ({body}) AS out_rows"


for name, (period, where) in WIDE_PANELS.items():
    panel = panels.PANELS[name]
    body = _pt_sql(name, period, geo=name == "PANEL_B")
    add(f"load_{name.lower()}", lambda spark, sf, name=name: _doubles(_load(spark, sf, name)), f"""
WITH {sql_base()}, stg AS ({sql_staging(panel.staging)}), {PT_MAPS},
latest AS ({sql_latest('stg', KEYS[name], _columns(panel.staging), where + f" AND LOA_DAT > {EPOCH}")})
{_sql_doubles(body, OUTPUT[name])}""")


# ---- the whole incremental reload: first load, then the newer slice replaces its periods ----

def reload_panel(spark: SparkSession, sf: str, name: str) -> DataFrame:
    panel = panels.PANELS[name]
    target = _load(spark, sf, name, before=CUT)
    watermark = incremental.high_watermark(target)
    batch = _load(spark, sf, name, watermark)
    slice_ = panels.staged(panel, {panel.staging: staging(spark, sf, panel.staging)}, watermark)
    return _doubles(incremental.reload_periods(target, batch, periods=panel.periods(slice_)))


for name in ["PANEL_A_FOOD", "PANEL_A_MILK", "PANEL_B", "PANEL_C"]:
    panel = panels.PANELS[name]
    period, where = WIDE_PANELS[name]
    geo = name == "PANEL_B"
    columns = _columns(panel.staging)
    first = sql_latest("stg", KEYS[name], columns, f"{where} AND LOA_DAT > {EPOCH} AND LOA_DAT <= {CUT}")
    second = sql_latest("stg", KEYS[name], columns, f"{where} AND LOA_DAT > (SELECT max(LOA_DAT) FROM target)")
    body = _pt_sql(name, period, geo)
    result = f"""SELECT * FROM target WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.PER_DSC = target.PER_DSC)
UNION ALL SELECT * FROM batch"""
    add(f"reload_{name.lower()}", lambda spark, sf, name=name: reload_panel(spark, sf, name), f"""
WITH {sql_base()}, stg AS ({sql_staging(panel.staging)}), {PT_MAPS},
old_rows AS ({first}), target AS ({body.replace('FROM latest', 'FROM old_rows')}),
new_rows AS ({second}), batch AS ({body.replace('FROM latest', 'FROM new_rows')}),
gone AS (SELECT DISTINCT {period} AS PER_DSC FROM stg WHERE LOA_DAT > (SELECT max(LOA_DAT) FROM target))
{_sql_doubles(result, OUTPUT[name])}""")


# ---- tall panels ---------------------------------------------------------------------

def _es_sql(name: str, product: str, source_code: int, output: list[str], channel: str | None = None,
            sales_source: str | None = None) -> str:
    sales = sales_source or name
    columns = {
        "PDT_COD": f"sha256(upper(trim({product}))) AS PDT_COD",
        "PDT_PCK": f"upper(trim({product})) AS PDT_PCK",
        "CHL_COD": f"{channel} AS CHL_COD" if channel else _fixed_code("MAP_ES_CHANNEL", "CHL_SRC", "CHL_COD", name),
        "SAL_TYP_COD": _fixed_code("MAP_ES_SALES_TYPE", "SAL_TYP_SRC", "SAL_TYP_COD", sales),
        "KPI_FLG_COD": "coalesce(u.KPI_FLG_COD, 99) AS KPI_FLG_COD",
        "KPI_VAL": "coalesce(KPI_VAL, 0) AS KPI_VAL",
        "SRC_COD": f"{source_code} AS SRC_COD",
    }
    shown = ", ".join(columns.get(c, c) for c in output)
    return (f"SELECT {shown} FROM latest LEFT JOIN (SELECT upper(trim(KPI_FLG_SRC)) AS label, KPI_FLG_COD FROM "
            f"MAP_ES_UNITS WHERE SRC_DSC = '{name}') AS u ON u.label = upper(trim(KPI_FLG))")


# The channel codes of panel E.
E_CHANNEL = "CASE " + " ".join(
    f"WHEN CAT_DSC = 'CATEGORY_{c}' AND CHL_DSC = 'CHANNEL_{d}' THEN {code}"
    for c, d, code in [("A", "ONLINE", 2), ("A", "HYPER", 3), ("A", "SUPER", 4), ("A", "DISCOUNT", 5),
                       ("B", "ONLINE", 6), ("B", "HYPER", 7), ("B", "SUPER", 8), ("B", "DISCOUNT", 9)]) + " ELSE 99 END"
TALL_PANELS = {
    "PANEL_F": ("CAT_DSC", 2, None, None, "true"),
    "PANEL_G": ("PDT_DSC", 5, None, None, "true"),
    "PANEL_H": ("PDT_PCK", 6, None, None, "true"),
    "PANEL_I": ("PDT_PCK", 1, None, None, "true"),
    "PANEL_E_OTHERS": ("PDT_PCK", 3, E_CHANNEL, "PANEL_E", "CHL_DSC <> 'TOTAL_MARKET'"),
    "PANEL_E_PHARMA": ("PDT_PCK", 4, "1", "PANEL_E", "true"),
}
for name, (product, source_code, channel, sales, where) in TALL_PANELS.items():
    panel = panels.PANELS[name]
    body = _es_sql(name, product, source_code, OUTPUT[name], channel, sales)
    if name == "PANEL_E_OTHERS":
        body += " WHERE UPC_COD <> 'Not Available'"
    add(f"load_{name.lower()}", lambda spark, sf, name=name: _doubles(_load(spark, sf, name)), f"""
WITH {sql_base()}, stg AS ({sql_staging(panel.staging)}), {ES_MAPS},
latest AS ({sql_latest('stg', KEYS[name], _columns(panel.staging), where + f" AND LOA_DAT > {EPOCH}")})
{_sql_doubles(body, OUTPUT[name])}""")


def append_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Append-only panel: what is there, plus the slice newer than its watermark."""
    target = _load(spark, sf, "PANEL_F", before=CUT)
    batch = _load(spark, sf, "PANEL_F", incremental.high_watermark(target))
    return _doubles(incremental.append_rows(target, batch))


_panel = panels.PANELS["PANEL_F"]
_body = _es_sql("PANEL_F", "CAT_DSC", 2, OUTPUT["PANEL_F"])
_first = sql_latest("stg", KEYS["PANEL_F"], _columns(_panel.staging), f"LOA_DAT <= {CUT}")
_second = sql_latest("stg", KEYS["PANEL_F"], _columns(_panel.staging), "LOA_DAT > (SELECT max(LOA_DAT) FROM target)")
add("append_incremental", append_panel, f"""
WITH {sql_base()}, stg AS ({sql_staging(_panel.staging)}), {ES_MAPS},
old_rows AS ({_first}), target AS ({_body.replace('FROM latest', 'FROM old_rows')}),
new_rows AS ({_second}), batch AS ({_body.replace('FROM latest', 'FROM new_rows')})
{_sql_doubles('SELECT * FROM target UNION ALL SELECT * FROM batch', OUTPUT["PANEL_F"])}""")


# ---- panel D: three feeds ----------------------------------------------------------------

def _union_sql(prefix: str) -> str:
    return " UNION ALL ".join(
        f"SELECT *, '{f}' AS SRC_DSC FROM ({sql_staging(prefix + f)}) AS {f.lower()}" for f in ["PANEL_D_MASS", "PANEL_D_META", "PANEL_D_PHARMA"])


_d_latest = sql_latest("stg", KEYS["PANEL_D_UNION"], [*_columns("TRA_PT_PANEL_D"), "SRC_DSC"], f"LOA_DAT > {EPOCH}")
_feed_label = "CASE SRC_DSC WHEN 'PANEL_D_MASS' THEN '2' WHEN 'PANEL_D_PHARMA' THEN '3' WHEN 'PANEL_D_META' THEN '4' END"
_d_body = ("SELECT GEO_COD, PDT_COD, substr(PER_DSC, 1, 6) AS PER_DSC, l.SRC_DSC, SO_VALUES, SO_UNITS, CHL_COD, "
           "m.SAL_TYP_COD, SOURCE_CODE, LOA_DAT FROM (SELECT *, " + _feed_label + " AS label FROM latest) AS l "
           "LEFT JOIN MAP_PT_SALES_TYPE AS m ON m.SRC_DSC = l.SRC_DSC AND m.SAL_TYP_SRC = l.label")
add("load_panel_d_union", lambda spark, sf: _doubles(_load(spark, sf, "PANEL_D_UNION")), f"""
WITH {sql_base()}, stg AS ({_union_sql('TRA_PT_')}), {PT_MAPS}, latest AS ({_d_latest})
{_sql_doubles(_d_body, OUTPUT["PANEL_D_UNION"])}""")


def reload_feeds(spark: SparkSession, sf: str) -> DataFrame:
    panel = panels.PANELS["PANEL_D_UNION"]
    target = _load(spark, sf, "PANEL_D_UNION", before=CUT)
    watermark = incremental.high_watermark(target)
    batch = _load(spark, sf, "PANEL_D_UNION", watermark)
    tables = {t: staging(spark, sf, t) for t in panel.feed_sources.values()}
    slice_ = panels.staged(panel, tables, watermark)
    return _doubles(incremental.reload_periods(target, batch, periods=panel.periods(slice_)))


_columns_d = [*_columns("TRA_PT_PANEL_D"), "SRC_DSC"]
_first = sql_latest("stg", KEYS["PANEL_D_UNION"], _columns_d, f"LOA_DAT <= {CUT}")
_second = sql_latest("stg", KEYS["PANEL_D_UNION"], _columns_d, "LOA_DAT > (SELECT max(LOA_DAT) FROM target)")
_kept = """SELECT * FROM target WHERE PER_DSC NOT IN (SELECT PER_DSC FROM gone) UNION ALL SELECT * FROM batch"""
add("reload_panel_d_union", reload_feeds, f"""
WITH {sql_base()}, stg AS ({_union_sql('TRA_PT_')}), {PT_MAPS},
old_rows AS ({_first}), target AS ({_d_body.replace('FROM latest', 'FROM old_rows')}),
new_rows AS ({_second}), batch AS ({_d_body.replace('FROM latest', 'FROM new_rows')}),
gone AS (SELECT DISTINCT substr(PER_DSC, 1, 6) AS PER_DSC FROM stg WHERE LOA_DAT > (SELECT max(LOA_DAT) FROM target))
{_sql_doubles(_kept, OUTPUT["PANEL_D_UNION"])}""")

_t_latest = sql_latest("stg", KEYS["PANEL_D_UNION_TRA"], [*_columns("D_PT_PANEL_D"), "SRC_DSC"], "true")
_t_body = ("SELECT GEO_COD, PDT_COD, substr(PER_DSC, 1, 6) AS PER_DSC, l.SRC_DSC, st.SAL_TYP_COD, ch.CHL_COD, SAL_VAL, "
           "SAL_UNT, SAL_CUN, SAL_PVA_VAL, SRC_DSC_ORG, LOA_DAT, SAL_ORG_COD FROM latest AS l "
           "LEFT JOIN MAP_PT_SALES_TYPE AS st ON st.SRC_DSC = l.SRC_DSC AND st.SAL_TYP_SRC = l.CHL_COD "
           "LEFT JOIN MAP_PT_CHANNEL AS ch ON ch.SRC_DSC = l.SRC_DSC AND ch.CHL_SRC = l.CHL_COD")
add("load_panel_d_union_tra", lambda spark, sf: _doubles(_load(spark, sf, "PANEL_D_UNION_TRA")), f"""
WITH {sql_base()}, stg AS ({_union_sql('D_PT_')}), {PT_MAPS}, latest AS ({_t_latest})
{_sql_doubles(_t_body, OUTPUT["PANEL_D_UNION_TRA"])}""")


# ---- operators on their own ------------------------------------------------------------------

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate"]
_line_order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
               "l_linestatus"]


def dedup_lines(spark, sf):
    return dedup.latest_version(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


_ties = ", ".join(f"{c} DESC" for c in ["l_shipdate", *_line_order])
SQL_LATEST_LINES = (
    f"SELECT {', '.join(LINE)} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    f"ORDER BY {_ties}) AS rn FROM lineitem) AS v WHERE rn = 1")
add("dedup_latest_lineitem", dedup_lines, SQL_LATEST_LINES)


def dedup_expression(spark, sf):
    """Key computed by precedence: the part, or the supplier where the part code is "NA"; no key, no row."""
    lines = table(spark, sf, "lineitem").withColumns({
        "part_code": F.expr("CASE WHEN l_returnflag = 'R' THEN ' na ' ELSE concat('p', l_partkey) END"),
        "supp_code": F.expr("CASE WHEN l_linestatus = 'F' THEN 'NA' ELSE concat('s', l_suppkey) END"),
    })
    key = keys.first_key(keys.clean_token("part_code"), keys.clean_token("supp_code"))
    usable = lines.filter(key.isNotNull())
    latest = dedup.latest_version(usable, {"key": key}, "l_shipdate")
    return latest.select(key.alias("product_key"), *LINE)


add("dedup_expr_key_qualify", dedup_expression, f"""
SELECT product_key, {', '.join(LINE)} FROM (SELECT *, coalesce(
  nullif(upper(trim(CASE WHEN l_returnflag = 'R' THEN ' na ' ELSE concat('p', l_partkey) END)), 'NA'),
  nullif(upper(trim(CASE WHEN l_linestatus = 'F' THEN 'NA' ELSE concat('s', l_suppkey) END)), 'NA')) AS product_key
  FROM lineitem) AS k WHERE product_key IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY product_key ORDER BY l_shipdate DESC, l_orderkey DESC, l_partkey DESC,
  l_suppkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
  l_returnflag DESC, l_linestatus DESC) = 1""")


def hwm_slice(spark, sf):
    lines = table(spark, sf, "lineitem")
    loaded = lines.filter(f"l_shipdate <= {CUT}")
    return incremental.incremental_slice(lines, loaded, "l_shipdate")


add("hwm_slice", hwm_slice, f"""
SELECT * FROM lineitem WHERE l_shipdate > coalesce((SELECT max(l_shipdate) FROM lineitem WHERE l_shipdate <= {CUT}),
  {EPOCH})""")
add("hwm_first_load",
    lambda spark, sf: incremental.incremental_slice(
        table(spark, sf, "lineitem"), table(spark, sf, "lineitem").filter("l_quantity < 0"), "l_shipdate"),
    f"SELECT * FROM lineitem WHERE l_shipdate > {EPOCH}")


def reload_lines(spark, sf, times=1):
    """Lines by ship month; the months of the newer half are replaced by its deduplicated rows."""
    lines = table(spark, sf, "lineitem").withColumn("period", dates.month_int("l_shipdate"))
    target = lines.filter("l_shipdate <= TIMESTAMP '2000-06-15 00:00:00'")
    newer = lines.filter("l_shipdate > TIMESTAMP '2000-06-15 00:00:00'")
    batch = dedup.latest_version(newer, ["l_orderkey", "l_linenumber"], "l_shipdate")
    for _ in range(times):
        target = incremental.reload_periods(target, batch, "period")
    return target


_reload_sql = f"""
WITH t AS (SELECT *, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS period FROM lineitem),
b AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ties})
  AS rn FROM t WHERE l_shipdate > TIMESTAMP '2000-06-15 00:00:00') AS v WHERE rn = 1)
SELECT * FROM t WHERE l_shipdate <= TIMESTAMP '2000-06-15 00:00:00' AND period NOT IN (SELECT period FROM b)
UNION ALL SELECT * FROM b"""
add("reload_periods", reload_lines, _reload_sql)
add("reload_idempotent", lambda spark, sf: reload_lines(spark, sf, 2), _reload_sql)

# lookups
_flags = [("PANEL_X", " a", 1), ("PANEL_X", "N ", 2), ("PANEL_Y", "R", 3)]
_flag_schema = "SRC_DSC string, CHL_SRC string, CHL_COD int"


def _flag_map(spark):
    from panelwright.sources.rows import inline_rows

    return inline_rows(spark, _flag_schema, _flags)


def map_fallback(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
    return lookup.map_code(lines, _flag_map(spark), "PANEL_X", "l_returnflag", "CHL_SRC", "CHL_COD")


add("map_code_fallback99", map_fallback, """
SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 99 END AS CHL_COD FROM lineitem""")


def map_pair(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag",
        F.expr("CASE WHEN l_linestatus = 'F' THEN 'PANEL_X' ELSE 'PANEL_Y' END").alias("feed"))
    return lookup.map_code_pair(lines, _flag_map(spark), ["PANEL_X", "PANEL_Y"], "feed", "l_returnflag", "CHL_SRC",
                                "CHL_COD")


add("map_code_composite", map_pair, """
SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag,
  CASE WHEN l_linestatus = 'F' THEN 'PANEL_X' ELSE 'PANEL_Y' END AS feed,
  CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 1 WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN 2
    WHEN l_linestatus <> 'F' AND l_returnflag = 'R' THEN 3 END AS CHL_COD FROM lineitem""")


def decision(spark, sf):
    rules = [({"o_orderpriority": "1-URGENT", "o_orderstatus": s}, i) for i, s in enumerate(["F", "O"], 2)] + [
        ({"o_orderpriority": "2-HIGH", "o_orderstatus": "P"}, 7)]
    return table(spark, sf, "orders").select(
        "o_orderkey", keys.decide(rules).alias("channel_code"),
        keys.label_code("o_orderstatus", {"F": "2", "O": "3"}).alias("feed_code"))


add("decision_table_channel", decision, """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 2
  WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 3
  WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN 7 ELSE 99 END AS channel_code,
  CASE o_orderstatus WHEN 'F' THEN '2' WHEN 'O' THEN '3' END AS feed_code FROM orders""")

add("hash_key_product",
    lambda spark, sf: table(spark, sf, "part").select(
        "p_partkey", keys.hash_key(F.concat(F.lit("  "), F.initcap("p_name"), F.lit(" "))).alias("product_key")),
    "SELECT p_partkey, sha256(upper(p_name)) AS product_key FROM part")
add("hash_key_geo",
    lambda spark, sf: table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey")).select(
        "c_custkey", keys.hash_key(F.lower("n_name")).alias("geo_key")),
    "SELECT c_custkey, sha256(upper(trim(lower(n_name)))) AS geo_key FROM customer JOIN nation ON c_nationkey = n_nationkey")


# period parsers over the text forms of the order dates
def _parsed(make):
    def query(spark, sf):
        rows = base(spark, sf).select("ordk", "ln", "loa", "yy", "mm", "dd", "mon", "os", "rf")
        return make(rows).select("ordk", "ln", "loa", "text", "period")

    return query


_parse_sql = "WITH " + sql_base() + " SELECT ordk, ln, loa, text, {0} AS period FROM (SELECT *, {1} AS text FROM base) AS b"
_bad = "CASE WHEN rf = 'R' THEN 'pending' ELSE {0} END"
for _name, _text, _fmt, _strp in [
    ("iso", "concat(yy, '-', mm, '-', dd)", "yyyy-MM-dd", "%Y-%m-%d"),
    ("dmy", "concat(dd, '/', mm, '/', yy)", "dd/MM/yyyy", "%d/%m/%Y"),
    ("mdy", "concat(mm, '/', dd, '/', yy)", "MM/dd/yyyy", "%m/%d/%Y"),
]:
    _t_text = _bad.format(_text)
    add(f"period_parse_{_name}",
        _parsed(lambda rows, text=_t_text, fmt=_fmt: rows.withColumn("text", F.expr(text)).withColumn(
            "period", dates.date_text_to_int("text", fmt))),
        _parse_sql.format(ISO.format("text", _strp), _t_text))
_label_text = STAGING["STG_PT_PANEL_B"]["PER_DSC"]
add("period_parse_localized",
    _parsed(lambda rows: rows.withColumn("text", F.expr(_label_text)).withColumn(
        "period", dates.month_label_to_period("text"))),
    _parse_sql.format(LABEL.replace("PER_DSC", "text"), _label_text))
_digits_text = "CASE WHEN os = 'F' THEN concat(yy, mm) WHEN os = 'O' THEN concat(yy, mm, dd) ELSE yy END"
add("period_parse_6_or_8",
    _parsed(lambda rows: rows.withColumn("text", F.expr(_digits_text)).withColumn("period", dates.code_to_date("text"))),
    _parse_sql.format("CASE length(text) WHEN 6 THEN CAST(strptime(text || '01', '%Y%m%d') AS DATE) "
                      "WHEN 8 THEN CAST(strptime(text, '%Y%m%d') AS DATE) END", _digits_text))
add("period_month_of_code",
    _parsed(lambda rows: rows.withColumn("text", F.expr(_digits_text)).withColumn("period", dates.month_of_code("text"))),
    _parse_sql.format("substr(text, 1, 6)", _digits_text))


# unions
def union_tagged(spark, sf):
    lines = table(spark, sf, "lineitem")
    parts = {f"FEED_{s}": lines.filter(F.col("l_linestatus") == s).select("l_orderkey", "l_linenumber", "l_shipdate")
             for s in ["F", "O"]}
    return feeds.union_feeds(parts)


add("union_feeds_tagged", union_tagged,
    "SELECT l_orderkey, l_linenumber, l_shipdate, 'FEED_' || l_linestatus AS SRC_DSC FROM lineitem "
    "WHERE l_linestatus IN ('F', 'O')")


def union_null(spark, sf):
    lines = table(spark, sf, "lineitem")
    with_tax = lines.filter("l_linestatus = 'F'").select("l_orderkey", "l_linenumber", "l_shipdate", "l_tax")
    without = lines.filter("l_linestatus = 'O'").select("l_orderkey", "l_linenumber", "l_shipdate")
    return feeds.union_aligned([with_tax, without])


add("union_null_aligned", union_null,
    "SELECT l_orderkey, l_linenumber, l_shipdate, CASE WHEN l_linestatus = 'F' THEN l_tax END AS l_tax FROM lineitem "
    "WHERE l_linestatus IN ('F', 'O')")


def periods_over_feeds(spark, sf):
    lines = table(spark, sf, "lineitem").select(dates.month_int("l_shipdate").alias("period"))
    orders = table(spark, sf, "orders").select(dates.month_int("o_orderdate").alias("period"))
    return feeds.feed_periods([lines, orders], "period")


add("feed_periods_union", periods_over_feeds,
    "SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS period FROM lineitem UNION "
    "SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) FROM orders")
