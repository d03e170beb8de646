"""Panel loads: one function, twelve specs.

Every panel goes through the same steps: newer-than-watermark slice, latest
version per key, keys and period, code lookups, projection. What differs is
data, and sits in a :class:`Panel`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, keys
from ..operators import dedup, feeds, incremental, lookup
from ..sources.layers import Warehouse, stamp_text
from ..sources.versions import Receipt


@dataclass(frozen=True)
class Code:
    """A lookup. ``fixed`` is a label shared by all rows, else ``column`` holds the label."""

    mapping: str
    label: str
    code: str
    source: str
    fixed: str | None = None
    column: str | None = None


@dataclass(frozen=True)
class Panel:
    name: str
    staging: str
    target_layer: str
    target: str
    keys: list[str]
    columns: dict[str, Callable[[], Column] | str]
    output: list[str]
    codes: list[Code] = field(default_factory=list)
    feed_codes: list[tuple[str, str, str, str]] = field(default_factory=list)  # mapping, label, code, key column
    feed_sources: dict[str, str] = field(default_factory=dict)  # feed tag → staging table
    where: str | None = None
    where_after: str | None = None
    period_text: Callable[[], Column] | None = None
    incremental: bool = True
    reload: bool = False
    staging_layer: str = "BRONZE_STG"

    def periods(self, staged: DataFrame) -> DataFrame:
        """Periods delivered by a slice, rows that are filtered out later included."""
        return staged.select(self.period_text().alias("PER_DSC")).distinct()

    def emptied(self, staged: DataFrame) -> DataFrame | None:
        """Delivered periods all of whose rows are filtered out. One narrow aggregate, no deduplication."""
        if self.where is None:
            return None
        kept = staged.select(self.period_text().alias("PER_DSC"), F.expr(f"COALESCE({self.where}, false) AS kept"))
        return kept.groupBy("PER_DSC").agg(F.max("kept").alias("kept")).filter("NOT kept").select("PER_DSC")


# Output columns of the three fact shapes, in order.
PT_WIDE = ["PDT_COD", "CHL_COD", "SAL_TYP_COD", "SRC_DSC", "PER_DSC", "SO_VALUES", "SO_UNITS", "SO_KILOS",
           "SOURCE_CODE", "LOA_DAT"]
PT_GEO_WIDE = ["GEO_COD", "GEO_DSC", *PT_WIDE]
ES_TALL = ["PDT_COD", "PDT_PCK", "CHL_COD", "SAL_TYP_COD", "KPI_FLG_COD", "KPI_VAL", "PER_DSC", "SRC_COD",
           "SRC_DSC_ORG", "LOA_DAT"]




def _pt_codes(source: str) -> list[Code]:
    return [
        Code("MAP_PT_CHANNEL", "CHL_SRC", "CHL_COD", source, fixed=source),
        Code("MAP_PT_SALES_TYPE", "SAL_TYP_SRC", "SAL_TYP_COD", source, fixed=source),
    ]


def _es_codes(source: str, units_source: str | None = None, channel: bool = True) -> list[Code]:
    codes = [
        Code("MAP_ES_SALES_TYPE", "SAL_TYP_SRC", "SAL_TYP_COD", source, fixed=source),
        Code("MAP_ES_UNITS", "KPI_FLG_SRC", "KPI_FLG_COD", units_source or source, column="KPI_FLG"),
    ]
    if channel:
        codes.insert(0, Code("MAP_ES_CHANNEL", "CHL_SRC", "CHL_COD", source, fixed=source))
    return codes


def _pt_wide(name: str, keys_: list[str], period: Callable[[], Column], where: str | None = None,
             geo: bool = False) -> Panel:
    columns: dict = {
        "PDT_COD": lambda: F.col("PDT_COD").cast("string"),
        "SRC_DSC": lambda: F.lit(name),
        "PER_DSC": period,
    }
    if geo:
        columns["GEO_COD"] = lambda: keys.hash_key("GEO_DSC")
    return Panel(
        name=name, staging=f"STG_PT_{name}", target_layer="SILVER_DWH", target=f"FACT_PT_{name}", keys=keys_,
        columns=columns, output=PT_GEO_WIDE if geo else PT_WIDE, codes=_pt_codes(name), where=where,
        period_text=period, reload=True,
    )


def _es_tall(name: str, keys_: list[str], product: str, source_code: int, *, staging: str | None = None,
             target: tuple[str, str] | None = None, codes: list[Code] | None = None, extra: dict | None = None,
             output: list[str] | None = None, where: str | None = None, where_after: str | None = None) -> Panel:
    layer, table = target or ("SILVER_DWH", f"FACT_ES_{name}")
    columns: dict = {
        "PDT_COD": lambda: keys.hash_key(product),
        "PDT_PCK": lambda: keys.norm(product),
        "KPI_VAL": lambda: F.coalesce(F.col("KPI_VAL"), F.lit(0).cast("decimal(18,4)")),
        "SRC_COD": lambda: F.lit(source_code),
        **(extra or {}),
    }
    return Panel(
        name=name, staging=staging or f"STG_ES_{name}", target_layer=layer, target=table, keys=keys_,
        columns=columns, output=output or ES_TALL, codes=_es_codes(name) if codes is None else codes, where=where,
        where_after=where_after, period_text=lambda: F.col("PER_DSC"),
    )


# Channel of a (category, channel description) pair in panel E.
PANEL_E_CHANNELS = [
    ({"CAT_DSC": "CATEGORY_A", "CHL_DSC": "CHANNEL_ONLINE"}, 2),
    ({"CAT_DSC": "CATEGORY_A", "CHL_DSC": "CHANNEL_HYPER"}, 3),
    ({"CAT_DSC": "CATEGORY_A", "CHL_DSC": "CHANNEL_SUPER"}, 4),
    ({"CAT_DSC": "CATEGORY_A", "CHL_DSC": "CHANNEL_DISCOUNT"}, 5),
    ({"CAT_DSC": "CATEGORY_B", "CHL_DSC": "CHANNEL_ONLINE"}, 6),
    ({"CAT_DSC": "CATEGORY_B", "CHL_DSC": "CHANNEL_HYPER"}, 7),
    ({"CAT_DSC": "CATEGORY_B", "CHL_DSC": "CHANNEL_SUPER"}, 8),
    ({"CAT_DSC": "CATEGORY_B", "CHL_DSC": "CHANNEL_DISCOUNT"}, 9),
]

# Sales-type label of a panel D feed.
PANEL_D_SALES_TYPES = {"PANEL_D_MASS": "2", "PANEL_D_PHARMA": "3", "PANEL_D_META": "4"}
PANEL_D_FEEDS = ["PANEL_D_MASS", "PANEL_D_META", "PANEL_D_PHARMA"]

PANELS: dict[str, Panel] = {
    p.name: p
    for p in [
        _pt_wide(
            "PANEL_A_FOOD",
            ["PDT_DSC", "PDT_COD", "PER_ALL", "PER_INI", "PER_FIN", "SO_UNITS", "SO_VALUES", "SO_KILOS"],
            lambda: dates.date_text_to_int("PER_INI", "yyyy-MM-dd"),
            where="PDT_DSC <> 'TOTAL'",
        ),
        _pt_wide(
            "PANEL_A_MILK",
            ["PDT_DSC", "PDT_COD", "PER_ALL", "PER_INI", "PER_FIN"],
            lambda: dates.date_text_to_int("PER_INI", "dd/MM/yyyy"),
            where="PDT_DSC <> 'TOTAL'",
        ),
        _pt_wide(
            "PANEL_B",
            ["GEO_DSC", "PER_DSC", "PDT_PCK", "PDT_COD", "UPC_COD", "CNY_DSC", "BRD_DSC", "SGM_DSC", "SSG_DSC",
             "SBR_DSC", "STG_DSC", "CPC_DSC", "SO_VALUES", "SO_UNITS", "SO_KILOS"],
            lambda: dates.month_label_to_period("PER_DSC"),
            geo=True,
        ),
        _pt_wide(
            "PANEL_C",
            ["PDT_COD", "PDT_PCK", "CTG_DSC", "SO_VALUES", "SO_UNITS", "SO_KILOS", "PER_DSC"],
            lambda: dates.date_text_to_int("PER_DSC", "MM/dd/yyyy"),
        ),
        Panel(
            name="PANEL_D_UNION", staging="TRA_PT_PANEL_D", staging_layer="SILVER_TRA", target_layer="SILVER_DWH",
            target="FACT_PT_PANEL_D_UNION",
            keys=["GEO_COD", "PDT_COD", "CHL_COD", "SRC_DSC", "PER_DSC", "SO_VALUES", "SO_UNITS"],
            columns={
                "PER_DSC": lambda: dates.month_of_code("PER_DSC"),
                "_sales_type": lambda: keys.label_code("SRC_DSC", PANEL_D_SALES_TYPES),
            },
            output=["GEO_COD", "PDT_COD", "PER_DSC", "SRC_DSC", "SO_VALUES", "SO_UNITS", "CHL_COD", "SAL_TYP_COD",
                    "SOURCE_CODE", "LOA_DAT"],
            feed_codes=[("MAP_PT_SALES_TYPE", "SAL_TYP_SRC", "SAL_TYP_COD", "_sales_type")],
            feed_sources={f: f"TRA_PT_{f}" for f in PANEL_D_FEEDS},
            period_text=lambda: dates.month_of_code("PER_DSC"), reload=True,
        ),
        _es_tall("PANEL_F", ["MKT_DSC", "GEO_DSC", "CAT_DSC", "PER_DSC", "KPI_FLG"], "CAT_DSC", 2),
        _es_tall("PANEL_G", ["MKT_DSC", "GEO_DSC", "PDT_DSC", "PER_DSC", "KPI_FLG"], "PDT_DSC", 5),
        _es_tall("PANEL_H", ["CNY_DSC", "PDT_DSC", "PDT_PCK", "GEO_COD", "PER_DSC", "KPI_FLG"], "PDT_PCK", 6),
        _es_tall(
            "PANEL_I",
            ["CNY_DSC", "PDT_DSC", "PDT_PCK", "CAT_DSC", "OTC_1_DSC", "OTC_2_DSC", "OTC_3_DSC", "OTC_4_DSC",
             "KPI_FLG", "PER_DSC"],
            "PDT_PCK", 1,
        ),
        _es_tall(
            "PANEL_E_OTHERS",
            ["CHL_DSC", "PDT_PCK", "CAT_DSC", "CNY_DSC", "SGM_DSC", "BRD_DSC", "VRY_DSC", "SVR_DSC", "SBR_DSC",
             "CPC_N01", "CPC_N02", "UPC_COD", "KPI_FLG", "PER_DSC"],
            "PDT_PCK", 3, target=("SILVER_TRA", "TRA_ES_PANEL_E_OTHERS"),
            codes=_es_codes("PANEL_E", "PANEL_E_OTHERS", channel=False),
            extra={"CHL_COD": lambda: keys.decide(PANEL_E_CHANNELS)},
            where="CHL_DSC <> 'TOTAL_MARKET'",
            where_after="UPC_COD <> 'Not Available'",
            output=["PDT_COD", "PDT_PCK", "CHL_DSC", "CAT_DSC", "CNY_DSC", "SGM_DSC", "BRD_DSC", "VRY_DSC",
                    "SVR_DSC", "SBR_DSC", "CPC_N01", "CPC_N02", "UPC_COD", "CHL_COD", "PER_DSC", "SRC_COD",
                    "SAL_TYP_COD", "KPI_FLG_COD", "KPI_VAL", "LOA_DAT", "SRC_DSC_ORG"],
        ),
        _es_tall(
            "PANEL_E_PHARMA",
            ["MKT_DSC", "GEO_DSC", "TYP_MKT_DSC", "SGM_DSC", "SGM_SUB_DSC", "CNY_DSC", "PDT_DSC", "PDT_PCK",
             "KPI_FLG", "PER_DSC"],
            "PDT_PCK", 4, target=("SILVER_TRA", "TRA_ES_PANEL_E_PHARMA"),
            codes=_es_codes("PANEL_E", "PANEL_E_PHARMA", channel=False),
            extra={"CHL_COD": lambda: F.lit(1)},
        ),
        Panel(
            name="PANEL_D_UNION_TRA", staging="D_PT_PANEL_D", staging_layer="SILVER_TRA", target_layer="SILVER_TRA",
            target="TRA_PT_PANEL_D_UNION",
            keys=["GEO_COD", "PDT_COD", "CHL_COD", "SRC_DSC", "PER_DSC", "SAL_VAL", "SAL_UNT"],
            columns={"PER_DSC": lambda: dates.month_of_code("PER_DSC"), "_channel": lambda: F.col("CHL_COD")},
            output=["GEO_COD", "PDT_COD", "PER_DSC", "SRC_DSC", "SAL_TYP_COD", "CHL_COD", "SAL_VAL", "SAL_UNT",
                    "SAL_CUN", "SAL_PVA_VAL", "SRC_DSC_ORG", "LOA_DAT", "SAL_ORG_COD"],
            feed_codes=[
                ("MAP_PT_SALES_TYPE", "SAL_TYP_SRC", "SAL_TYP_COD", "_channel"),
                ("MAP_PT_CHANNEL", "CHL_SRC", "CHL_COD", "_channel"),
            ],
            feed_sources={f: f"D_PT_{f}" for f in PANEL_D_FEEDS},
            period_text=lambda: dates.month_of_code("PER_DSC"), incremental=False,
        ),
    ]
}


def staged(panel: Panel, tables: dict[str, DataFrame], watermark: Column | dt.datetime | None) -> DataFrame:
    """The rows a load looks at: the feeds' union, newer than the watermark."""
    if panel.feed_sources:
        rows = feeds.union_feeds({tag: tables[t] for tag, t in panel.feed_sources.items()})
    else:
        rows = tables[panel.staging]
    if panel.incremental:
        rows = incremental.newer_than(rows, incremental.EPOCH if watermark is None else watermark)
    return rows


def load(
    panel: Panel,
    tables: dict[str, DataFrame],
    mappings: dict[str, DataFrame],
    watermark: Column | dt.datetime | None = None,
) -> DataFrame:
    """The fact rows of one load."""
    return load_rows(panel, staged(panel, tables, watermark), mappings)


def load_rows(panel: Panel, rows: DataFrame, mappings: dict[str, DataFrame]) -> DataFrame:
    """The fact rows made of staged ones; those of a union of feeds carry their feed's tag."""
    if panel.where:
        rows = rows.filter(panel.where)
    rows = dedup.latest_version(rows, panel.keys)
    if panel.where_after:
        rows = rows.filter(panel.where_after)
    rows = rows.withColumns({name: make() for name, make in panel.columns.items()})
    for code in panel.codes:
        if code.fixed is not None:
            scalar = lookup.constant_code(mappings[code.mapping], code.source, code.fixed, code.label, code.code)
            rows = rows.withColumn(code.code, scalar)
        else:
            rows = lookup.map_code(rows, mappings[code.mapping], code.source, code.column, code.label, code.code)
    sources = list(panel.feed_sources)
    for mapping, label, code_name, key in panel.feed_codes:
        rows = lookup.map_code_pair(rows, mappings[mapping], sources, "SRC_DSC", key, label, code_name)
    return rows.select(*panel.output)


def quality_metrics(panel: Panel) -> dict[str, Column]:
    """What is counted while a load is written: rows, rows whose keys are missing or unmapped, first and last stamp."""
    codes = [c for c in panel.output if c.endswith("_COD") and c not in ("GEO_COD", "SRC_COD", "SAL_ORG_COD")]
    counted = {"rows": F.count(F.lit(1)), "without_period": F.count_if(F.col("PER_DSC").isNull())}
    for c in codes:
        counted[f"{c}_missing"] = F.count_if(F.col(c).isNull())
        counted[f"{c}_unmapped"] = F.count_if(F.col(c).cast("string") == "99")
    return counted | {"first_stamp": F.min("LOA_DAT").cast("string"), "last_stamp": F.max("LOA_DAT").cast("string")}


def run(panel: Panel, warehouse: Warehouse, mapping_layer: str = "SILVER_DWH") -> None:
    """Load a panel into its target table, and with the same commit log how far it has looked.

    The slice runs from the logged stamp to the highest one staged now, so all steps see the same rows even while files
    arrive. Below a root path the log is part of the table's commit and no load reads the target; a load that another one
    has overtaken is refused, so that nothing is appended twice. In a catalog, an append also looks at the stamps held. A
    target from before the log starts at its own highest stamp.
    """
    from ..schemas import MAPPINGS, STAGING

    names = list(panel.feed_sources.values()) or [panel.staging]
    tables = {n: warehouse.read(panel.staging_layer, n, STAGING.get(n)) for n in names}
    needed = {c.mapping for c in panel.codes} | {f[0] for f in panel.feed_codes}
    mappings = {m: warehouse.read(mapping_layer, m, MAPPINGS[m]) for m in needed}
    watermark, newest, receipt = None, None, None
    metrics = quality_metrics(panel)
    if panel.incremental:
        logged = warehouse.staged_to(panel.target_layer, panel.target)
        # A reload may be repeated; an append whose log entry was lost must not be, and its own stamps tell.
        apart = warehouse.versioned(panel.target_layer, panel.target) is None and not panel.reload
        target = warehouse.read_or_none(panel.target_layer, panel.target) if logged is None or apart else None
        held = incremental.watermark_value(target) if logged is None or apart else None
        watermark = max(x for x in (logged, held) if x is not None)
        newest = staged(panel, tables, watermark).agg(F.max("LOA_DAT")).first()[0]
        if newest is None:
            if logged is None and target is None:
                warehouse.append(load(panel, tables, mappings, watermark), panel.target_layer, panel.target, "PER_DSC")
            return
        tables = {n: incremental.up_to(t, newest) for n, t in tables.items()}
        receipt = Receipt(staged_from=stamp_text(logged) if logged else None, staged_to=stamp_text(newest))
    batch = load(panel, tables, mappings, watermark)
    if panel.reload:
        emptied = panel.emptied(staged(panel, tables, watermark))
        warehouse.reload(batch, panel.target_layer, panel.target, "PER_DSC", emptied, receipt, metrics)
    else:
        warehouse.append(batch, panel.target_layer, panel.target, "PER_DSC", receipt, metrics)
    if newest is not None and warehouse.versioned(panel.target_layer, panel.target) is None:
        warehouse.record_load(panel.target_layer, panel.target, newest)
