"""Declared schemas, as DDL text. Nothing is inferred: inference reads "2022-01" as a timestamp."""

from __future__ import annotations


def _strings(*names: str) -> str:
    return ", ".join(f"{n} string" for n in names)


_WIDE = "SO_VALUES decimal(18,4), SO_UNITS decimal(18,4), SO_KILOS decimal(18,4)"
_PT = "SOURCE_CODE string, LOA_DAT timestamp"
_ES = "KPI_FLG string, PER_DSC string, KPI_VAL decimal(18,4), SRC_DSC_ORG string, LOA_DAT timestamp"
_PANEL_A = _strings("PDT_DSC", "PDT_COD", "PER_ALL", "PER_INI", "PER_FIN") + f", {_WIDE}, {_PT}"
_PANEL_D = (
    "GEO_COD string, PDT_COD string, CHL_COD string, PER_DSC string, "
    "SO_VALUES decimal(18,4), SO_UNITS decimal(18,4), SOURCE_CODE string, LOA_DAT timestamp"
)
_PANEL_D_RAW = (
    "GEO_COD string, PDT_COD string, PER_DSC string, CHL_COD string, SAL_VAL decimal(18,4), "
    "SAL_UNT decimal(18,4), SAL_CUN decimal(18,4), SAL_PVA_VAL decimal(18,4), SRC_DSC_ORG string, "
    "LOA_DAT timestamp, SAL_ORG_COD string"
)

# The columns of the Portuguese product master, in order.
PT_PRODUCT_COLUMNS = [
    "PNL_D_COD", "PNL_C_COD", "PNL_A_COD", "PNL_B_COD", "EAN_COD", "STS_COD", "NET_ARE", "SUB_NET_ARE",
    "CAT_DSC", "SUB_CAT_DSC", "CNY_DSC", "BRD_DSC", "SUB_BRD_DSC", "PDT_DSC", "PDT_PCK", "GAM_DSC", "ETP_COD",
    "VOL_QTY", "SAL_QTY", "PMN_DSC", "STG_DSC", "UNT_PCK", "FOR_WGH", "UNT_DSC", "INC_COD", "GLB_REP", "ORG_DSC",
]

# Staging tables, as the panels deliver them.
STAGING: dict[str, str] = {
    "STG_PT_PANEL_A_FOOD": (_PANEL_A),
    "STG_PT_PANEL_A_MILK": (_PANEL_A),
    "STG_PT_PANEL_B": (
        _strings("GEO_DSC", "PER_DSC", "PDT_PCK", "PDT_COD", "UPC_COD", "CNY_DSC", "BRD_DSC", "SGM_DSC",
                 "SSG_DSC", "SBR_DSC", "STG_DSC", "CPC_DSC") + f", {_WIDE}, {_PT}"
    ),
    "STG_PT_PANEL_C": (_strings("PDT_COD", "PDT_PCK", "CTG_DSC", "PER_DSC") + f", {_WIDE}, {_PT}"),
    "TRA_PT_PANEL_D_MASS": (_PANEL_D),
    "TRA_PT_PANEL_D_META": (_PANEL_D),
    "TRA_PT_PANEL_D_PHARMA": (_PANEL_D),
    "D_PT_PANEL_D_MASS": (_PANEL_D_RAW),
    "D_PT_PANEL_D_META": (_PANEL_D_RAW),
    "D_PT_PANEL_D_PHARMA": (_PANEL_D_RAW),
    "STG_ES_PANEL_F": (_strings("MKT_DSC", "GEO_DSC", "CAT_DSC") + f", {_ES}"),
    "STG_ES_PANEL_G": (_strings("MKT_DSC", "GEO_DSC", "PDT_DSC") + f", {_ES}"),
    "STG_ES_PANEL_H": (_strings("CNY_DSC", "PDT_DSC", "PDT_PCK", "GEO_COD") + f", {_ES}"),
    "STG_ES_PANEL_I": (
        _strings("CNY_DSC", "PDT_DSC", "PDT_PCK", "CAT_DSC", "OTC_1_DSC", "OTC_2_DSC", "OTC_3_DSC", "OTC_4_DSC")
        + f", {_ES}"
    ),
    "STG_ES_PANEL_I_NP": (
        _strings("CNY_DSC", "PDT_DSC", "PDT_PCK", "CAT_DSC", "OTC_N01", "OTC_N02", "OTC_N03", "OTC_N04",
                 "SRC_DSC_ORG") + ", LOA_DAT timestamp"
    ),
    "STG_ES_PANEL_E_OTHERS": (
        _strings("CHL_DSC", "PDT_PCK", "CAT_DSC", "CNY_DSC", "SGM_DSC", "BRD_DSC", "VRY_DSC", "SVR_DSC",
                 "SBR_DSC", "CPC_N01", "CPC_N02", "UPC_COD") + f", {_ES}"
    ),
    "STG_ES_PANEL_E_PHARMA": (
        _strings("MKT_DSC", "GEO_DSC", "TYP_MKT_DSC", "SGM_DSC", "SGM_SUB_DSC", "CNY_DSC", "PDT_DSC", "PDT_PCK")
        + f", {_ES}"
    ),
    "STG_PT_PRODUCT": (_strings(*PT_PRODUCT_COLUMNS, "SRC_DSC_ORG") + ", LOA_DAT timestamp"),
}

MAPPINGS: dict[str, str] = {
    "MAP_PT_CHANNEL": ("SRC_DSC string, CHL_SRC string, CHL_COD int"),
    "MAP_ES_CHANNEL": ("SRC_DSC string, CHL_SRC string, CHL_COD int"),
    "MAP_PT_SALES_TYPE": ("SRC_DSC string, SAL_TYP_SRC string, SAL_TYP_COD int"),
    "MAP_ES_SALES_TYPE": ("SRC_DSC string, SAL_TYP_SRC string, SAL_TYP_COD int"),
    "MAP_ES_UNITS": ("SRC_DSC string, KPI_FLG_SRC string, KPI_FLG_COD int"),
}

# Star tables: CSV header name → (column name here, type). Fixed values.
STAR_COLUMNS: dict[str, list[tuple[str, str, str]]] = {
    "DIM_CALENDAR": [
        ("Date", "date", "date"), ("Year", "year", "int"), ("Quarter", "quarter", "int"),
        ("Month Number", "month_number", "int"), ("Month Short", "month_short", "string"),
        ("Month Long", "month_long", "string"), ("Period ID", "period_id", "int"),
        ("Period Name", "period_name", "string"), ("Year Quarter", "year_quarter", "string"),
        ("Year LY", "year_ly", "int"), ("Date LY", "date_ly", "date"),
        ("Current Year", "current_year", "int"), ("Current Month", "current_month", "int"),
    ],
    "DIM_PROD": [
        ("Product ID", "product_id", "int"), ("Product Name", "product_name", "string"),
        ("Brand", "brand", "string"), ("Business Area", "business_area", "string"),
        ("Business Sub Area", "business_sub_area", "string"), ("Category", "category", "string"),
        ("Category ID", "category_id", "int"), ("Format", "format", "string"), ("Etapas", "etapas", "string"),
        ("EP", "ep", "double"), ("CUnits", "cunits", "int"), ("Conversor LKG", "conversor_lkg", "double"),
        ("Product Pack", "product_pack", "string"), ("Manufacturer", "manufacturer", "string"),
        ("Market", "market", "string"), ("Sub Category", "sub_category", "string"),
        ("Sub Brand", "sub_brand", "string"), ("Product", "product", "string"),
    ],
    "DIM_CHANNEL": [
        ("Channel ID", "channel_id", "int"), ("Channel Name", "channel_name", "string"),
        ("Channel", "channel", "string"), ("SubChannel", "sub_channel", "string"),
        ("Type Channel", "type_channel", "string"),
    ],
    "DIM_CATEGORY": [
        ("Category ID", "category_id", "int"), ("Category Name", "category_name", "string"),
        ("Source ID", "source_id", "int"),
    ],
    "DIM_SOURCE": [("Source ID", "source_id", "int"), ("Source Name", "source_name", "string")],
    "DIM_SALES_TYPE": [("Sales Type ID", "sales_type_id", "int"), ("Sales Type Name", "sales_type", "string")],
    "DIM_UNITS": [
        ("KPI Flag ID", "kpi_flag_id", "int"), ("KPI Flag Name", "kpi_flag_name", "string"),
        ("Unit Label", "unit_label", "string"), ("KPI Flag", "metric", "string"),
    ],
    "FACT_TABLE": [
        ("Period ID", "period_id", "int"), ("Product ID", "product_id", "int"), ("Channel ID", "channel_id", "int"),
        ("Sales Type ID", "sales_type_id", "int"), ("KPI Flag ID", "kpi_flag_id", "int"),
        ("Category ID", "category_id", "int"), ("Product Pack", "product_pack", "string"),
        ("KPI Value", "value", "double"),
    ],
    "FACT_BIRTH_RATE": [
        ("Year", "year", "int"), ("Month Short", "month_short", "string"), ("KPI Value", "value", "double"),
        ("Period ID", "period_id", "int"),
    ],
}


def star_csv_schema(table: str) -> str:
    """Schema of a star CSV as written, with its header names."""
    return ", ".join(f"`{header}` {kind}" for header, _, kind in STAR_COLUMNS[table])


def star_schema(table: str) -> str:
    """Schema of a star table with the names used here."""
    return ", ".join(f"{name} {kind}" for _, name, kind in STAR_COLUMNS[table])
