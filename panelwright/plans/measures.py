"""The measure registry: a name → what to compute from window sums.

All measures asked for together are served by one aggregation. Names are the
model's (Spanish) measure names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, keys, ratios
from ..operators.totals import with_totals
from . import periods
from .periods import Block

# Window name → (kind, variant, empty window counts as 0).
WINDOWS: dict[str, tuple[str, str, bool]] = {
    "Mes": ("MES", "current", False),
    "Mes-1": ("MES", "prev", False),
    "Mes LY": ("MES", "ly", False),
    "L3M": ("L3M", "current", True),
    "L3M LY": ("L3M", "ly", False),
    "L4M": ("L4M", "current", True),
    "L4M-1": ("L4M", "prev", True),
    "L6M": ("L6M", "current", False),
    "L6M-1": ("L6M", "prev", True),
    "YTD": ("YTD", "current", True),
    "YTD-1": ("YTD", "prev", True),
    "TAM": ("TAM", "current", False),
    "TAM-1": ("TAM", "prev", False),
}

# Breakdown field → column. Metric, year and month have no "all members" total.
FIELDS: dict[str, str] = {
    "Área de Negocio": "business_area",
    "Compañía": "manufacturer",
    "Categoría": "category",
    "SubCategoría": "sub_category",
    "Entorno": "type_channel",
    "Canal": "channel",
    "SubCanal": "sub_channel",
    "Marca": "brand",
    "Sub Marca": "sub_brand",
    "Producto": "product",
    "Product Pack": "product_pack",
    "Formato": "format",
    "Market": "market",
    "Etapa": "etapas",
}
OTHER_FIELDS: dict[str, str] = {"Métrica": "metric", "Año": "year", "Mes": "month_long"}
FIELD_GROUPS = {"1. Producto": list(FIELDS), "2. Métrica": ["Métrica"], "3. Calendario": ["Año", "Mes"]}


def field_column(name: str) -> str:
    """Column of a breakdown field; unknown names are refused."""
    known = FIELDS | OTHER_FIELDS
    if name not in known:
        raise ValueError(f"unknown field {name}")
    return known[name]


def sales(window: str) -> str:
    """SQL text of a window's sales; some windows count as 0 when empty."""
    column = f"`s_{window}`"
    return ratios.zero(column) if WINDOWS[window][2] else ratios.as_double(column)


def share(window: str) -> str:
    return ratios.share(sales(window), f"`m_{window}`")


def whole(window: str) -> str:
    """Sales with the breakdown field's own filter removed; the total is NULL for fields without one."""
    column = f"`w_{window}`"
    return f"CASE WHEN _has_whole THEN {ratios.zero(column) if WINDOWS[window][2] else ratios.as_double(column)} END"


@dataclass(frozen=True)
class Measure:
    name: str
    folder: str
    windows: tuple[str, ...]
    sql: str
    market: bool = False  # needs the total over companies
    whole: bool = False  # needs the total over the breakdown field


SALES, SHARES, POINTS = "1. Ventas", "2. Market Share y %", "3. BPS"


def _registry() -> dict[str, Measure]:
    found: dict[str, Measure] = {}

    def add(name, folder, windows, sql, **needs):
        found[name] = Measure(name, folder, tuple(windows), sql, **needs)

    add("Ventas", SALES, [], ratios.as_double("s_all"))
    add("Market Share", SHARES, [], ratios.share("s_all", "m_all"), market=True)
    for w in WINDOWS:
        add(f"Ventas {w}", SALES, [w], sales(w))
    for w in ["L3M", "L3M LY", "L4M", "L4M-1", "Mes", "Mes LY", "Mes-1", "TAM", "TAM-1", "YTD", "YTD-1"]:
        add(f"Market Share {w}", SHARES, [w], share(w), market=True)
    for w in ["L4M", "L4M-1", "Mes", "Mes LY", "Mes-1", "TAM", "TAM-1", "YTD", "YTD-1"]:
        add(f"Ventas Globales {w} Switch", SALES, [w], whole(w), whole=True)
        add(f"%Peso {w}", SHARES, [w], ratios.share(sales(w), whole(w)), whole=True)

    # Measure suffix → (window, the window it is compared with).
    pairs = {
        "L4M": ("L4M", "L4M-1"), "Mes": ("Mes", "Mes-1"), "Mes LY": ("Mes", "Mes LY"), "TAM": ("TAM", "TAM-1"),
        "YTD": ("YTD", "YTD-1"),
    }
    for name, (cur, prev) in (pairs | {"L6M": ("L6M", "L6M-1")}).items():
        add(f"Crecimiento {name}", SALES, [cur, prev], ratios.growth(sales(cur), sales(prev)))
    for name, (cur, prev) in (pairs | {"L6M": ("L6M", "L6M-1"), "L3M": ("L3M", "L3M LY")}).items():
        add(f"%Crecimiento {name}", SHARES, [cur, prev], ratios.pct_growth(sales(cur), sales(prev)))
    for name, (cur, prev) in (pairs | {"L3M LY": ("L3M", "L3M LY")}).items():
        add(f"BPS {name}", POINTS, [cur, prev], ratios.bps(share(cur), share(prev), f"`p_{prev}`"), market=True)
    return found


MEASURES = _registry()

# Switch measure → the measure each period type stands for.
SWITCHES: dict[str, dict[str, str]] = {
    "%Crecimiento Período L3M LY Switch": {
        "MES": "%Crecimiento Mes LY", "L4M": "%Crecimiento L3M", "YTD": "%Crecimiento YTD", "TAM": "%Crecimiento TAM"},
    "%Crecimiento Período LY Switch": {
        "MES": "%Crecimiento Mes LY", "L4M": "%Crecimiento L4M", "YTD": "%Crecimiento YTD", "TAM": "%Crecimiento TAM"},
    "%Crecimiento Período Switch": {
        "MES": "%Crecimiento Mes", "L4M": "%Crecimiento L4M", "YTD": "%Crecimiento YTD", "TAM": "%Crecimiento TAM"},
    "BPS Período L3M LY Switch": {"MES": "BPS Mes LY", "L4M": "BPS L3M LY", "YTD": "BPS YTD", "TAM": "BPS TAM"},
    "BPS Período LY Switch": {"MES": "BPS Mes LY", "L4M": "BPS L4M", "YTD": "BPS YTD", "TAM": "BPS TAM"},
    "BPS Período Switch": {"MES": "BPS Mes", "L4M": "BPS L4M", "YTD": "BPS YTD", "TAM": "BPS TAM"},
    "Crecimiento Ventas Períodos LY Switch": {
        "MES": "Crecimiento Mes LY", "L4M": "Crecimiento L4M", "YTD": "Crecimiento YTD", "TAM": "Crecimiento TAM"},
    "Crecimiento Ventas Períodos Switch": {
        "MES": "Crecimiento Mes", "L4M": "Crecimiento L4M", "YTD": "Crecimiento YTD", "TAM": "Crecimiento TAM"},
    "Market Share Período L3M Switch": {
        "MES": "Market Share Mes", "L4M": "Market Share L3M", "YTD": "Market Share YTD", "TAM": "Market Share TAM"},
    "Market Share Período Switch": {
        "MES": "Market Share Mes", "L4M": "Market Share L4M", "YTD": "Market Share YTD", "TAM": "Market Share TAM"},
    "Market Share Período-1 Switch": {
        "MES": "Market Share Mes-1", "L4M": "Market Share L4M-1", "YTD": "Market Share YTD-1",
        "TAM": "Market Share TAM-1"},
    "Market Share Y-1 Switch": {
        "MES": "Market Share Mes LY", "L4M": "Market Share L4M-1", "YTD": "Market Share YTD-1",
        "TAM": "Market Share TAM-1"},
    "Ventas Periodos-1 Switch": {
        "MES": "Ventas Mes-1", "L4M": "Ventas L4M-1", "YTD": "Ventas YTD-1", "TAM": "Ventas TAM-1"},
    "Ventas Períodos Switch": {"MES": "Ventas Mes", "L4M": "Ventas L4M", "YTD": "Ventas YTD", "TAM": "Ventas TAM"},
    "Ventas Y-1 Switch": {
        "MES": "Ventas Mes LY", "L4M": "Ventas L4M-1", "YTD": "Ventas YTD-1", "TAM": "Ventas TAM-1"},
}

# Text measures, answered by text_measures().
TEXTS = [
    "Fecha L6M", "Fecha L6M-1", "Fecha Último Período Cargado", "Fecha Último Período Cargado - Sell In",
    "Fecha Último Período Cargado - Sell Out", "Selección Fecha", "Texto Segmento Categoría",
]

# The KPI parameter, its measures in order by group.
PARAMETER_KPIS: dict[str, list[str]] = {
    "1. Mes": [
        "Ventas Mes", "Ventas Mes-1", "Ventas Mes LY", "Crecimiento Mes", "%Crecimiento Mes", "Crecimiento Mes LY",
        "%Crecimiento Mes LY", "Market Share Mes", "Market Share Mes-1", "Market Share Mes LY", "BPS Mes",
        "BPS Mes LY", "%Peso Mes", "%Peso Mes-1", "%Peso Mes LY",
    ],
    "2. L4M": [
        "Ventas L4M", "Ventas L4M-1", "Crecimiento L4M", "%Crecimiento L4M", "Market Share L4M", "Market Share L4M-1",
        "BPS L4M", "%Peso L4M", "%Peso L4M-1",
    ],
    "3. YTD": [
        "Ventas YTD", "Ventas YTD-1", "Crecimiento YTD", "%Crecimiento YTD", "Market Share YTD", "Market Share YTD-1",
        "BPS YTD", "%Peso YTD", "%Peso YTD-1",
    ],
    "4. TAM": [
        "Ventas TAM", "Ventas TAM-1", "Crecimiento TAM", "%Crecimiento TAM", "Market Share TAM", "Market Share TAM-1",
        "BPS TAM", "%Peso TAM", "%Peso TAM-1",
    ],
}
# The other measure parameters, label → measure.
PARAMETERS: dict[str, dict[str, str]] = {
    "Market Year": {
        "Market Share Período Switch": "Market Share Período Switch",
        "Ventas Periodos Switch": "Ventas Períodos Switch",
        "BPS Mes LY": "BPS Período LY Switch",
    },
    "Market Year-1": {
        "Market Share Y-1 Switch": "Market Share Y-1 Switch",
        "Ventas Y-1 Switch": "Ventas Y-1 Switch",
    },
    "Market Período-1": {
        "Market Share-1": "Market Share Período-1 Switch",
        "Ventas Periodos-1": "Ventas Periodos-1 Switch",
    },
    "Market Período": {
        "Market Share": "Market Share Período Switch",
        "Ventas": "Ventas Períodos Switch",
        "BPS": "BPS Período Switch",
        "Evolución (en €)": "Crecimiento Ventas Períodos Switch",
        "Evolución (en %)": "%Crecimiento Período Switch",
    },
}


def switched(name: str, period_type: str | int) -> str:
    """The measure a name stands for under a period type; plain measures stand for themselves."""
    kind = periods.PERIOD_SWITCH.get(period_type, period_type)
    if kind not in periods.REPORT_TYPES:
        raise ValueError(f"unknown period type {period_type}")
    return SWITCHES[name][kind] if name in SWITCHES else name


def measure_table(
    fact: DataFrame,
    group: list[str],
    names: list[str],
    anchor: int,
    calendar: DataFrame,
    period_type: str | int = "L4M",
    field: str | None = None,
    company: str = "manufacturer",
    value: str = "value",
) -> DataFrame:
    """Measures by group at an anchor: ``group`` columns plus one column per name.

    ``fact`` carries every filter of the report except one on ``company`` (a
    company is picked from the result): shares are of the whole market. ``field``
    is the breakdown field whose own members are summed for weights.

    One aggregation serves all measures; its months are limited to what the
    windows span unless an unwindowed measure is asked for.
    """
    wanted = {n: MEASURES[switched(n, period_type)] for n in names}
    windows = sorted({w for m in wanted.values() for w in m.windows})
    blocks = {w: periods.block(anchor, *WINDOWS[w][:2]) for w in windows}
    unwindowed = any(not m.windows for m in wanted.values())
    rows = fact if unwindowed or not blocks else periods.within(fact, *blocks.values())

    sums = [f"{b.sum_of(value)} AS `s_{w}`" for w, b in blocks.items()]
    if unwindowed:
        sums.append(f"SUM({value}) AS s_all")
    members = rows.groupBy(*group).agg(*[F.expr(x) for x in sums])

    suffixes = [*windows, *(["all"] if unwindowed else [])]
    with_market = any(m.market for m in wanted.values())
    if with_market:
        by = [g for g in group if g != company]
        members = with_totals(members, {f"m_{s}": f"s_{s}" for s in suffixes}, by)
    with_whole = any(m.whole for m in wanted.values())
    if with_whole and with_market and FIELDS.get(field) == company:  # the same totals
        members = members.selectExpr("*", *[f"`m_{s}` AS `w_{s}`" for s in suffixes])
    elif with_whole and field in FIELDS:
        by = [g for g in group if g != FIELDS[field]]
        members = with_totals(members, {f"w_{s}": f"s_{s}" for s in suffixes}, by)
    elif with_whole:
        members = members.selectExpr("*", *[f"CAST(NULL AS DOUBLE) AS `w_{s}`" for s in suffixes])

    flags = {"_has_whole": F.lit(field in FIELDS)}
    if any(m.folder == POINTS for m in wanted.values()):
        compared = {m.windows[1] for m in wanted.values() if m.folder == POINTS}
        found = periods.all_loaded(calendar, {f"p_{w}": blocks[w] for w in sorted(compared)})
        members = members.withColumn("_loaded", found)
        flags |= {f"p_{w}": F.col("_loaded")[f"p_{w}"] for w in compared}
    return members.withColumns(flags).selectExpr(
        *[f"`{g}`" for g in group], *[f"{m.sql} AS `{n}`" for n, m in wanted.items()]
    )


def parameter_table(
    fact: DataFrame, group: list[str], parameter: str, anchor: int, calendar: DataFrame, period_type: str | int, **options
) -> DataFrame:
    """The measures of a measure parameter, named by its labels."""
    choices = PARAMETERS[parameter]
    table = measure_table(fact, group, list(dict.fromkeys(choices.values())), anchor, calendar, period_type, **options)
    return table.select(*group, *[F.col(f"`{name}`").alias(label) for label, name in choices.items()])


def select_company(table: DataFrame, companies: list[str], company: str = "manufacturer") -> DataFrame:
    """A company slicer, applied after the shares were taken."""
    return table.filter(F.col(company).isin(companies))


def text_measures(
    fact: DataFrame, calendar: DataFrame, categories: DataFrame, anchor: int, category: str = "category"
) -> DataFrame:
    """The text measures as one row. ``fact`` needs ``period_id``, ``category_id`` and the category column."""
    current, before = periods.block(anchor, "L6M"), periods.block(anchor, "L6M", "prev")

    def span(b: Block) -> Column:
        return dates.span_label(F.lit(dates.from_pidx(b.first)), F.lit(dates.from_pidx(b.last)), "Ventas: ")

    # one pass over the fact; categories are summed up before they meet their source
    by_category = fact.groupBy("category_id").agg(
        F.max("period_id").alias("_last"), F.min(category).alias("_low"), F.max(category).alias("_high"),
        F.count(F.lit(1)).alias("_rows"), F.count(category).alias("_named"),
    ).join(categories.select("category_id", "source_id"), "category_id", "left")
    one = by_category.agg(
        F.max(F.when(F.col("source_id") == 1, F.col("_last"))).alias("_sell_in"),
        F.max(F.when(F.col("source_id") != 1, F.col("_last"))).alias("_sell_out"),
        F.min("_low").alias("_low"), F.max("_high").alias("_high"),
        (F.sum("_rows") == F.sum("_named")).alias("_all_named"),
    )
    last_date = calendar.select(F.max("date")).scalar()
    alone = F.col("_all_named") & (F.col("_low") == F.col("_high"))
    return one.select(
        span(current).alias("Fecha L6M"),
        span(before).alias("Fecha L6M-1"),
        F.concat(F.lit("Último Período Cargado: "), dates.period_label(dates.month_int(last_date))).alias(
            "Fecha Último Período Cargado"),
        F.concat(F.lit("Último Período Cargado (Sell In): "), dates.period_label("_sell_in")).alias(
            "Fecha Último Período Cargado - Sell In"),
        F.concat(F.lit("Último Período Cargado (Sell Out): "), dates.period_label("_sell_out")).alias(
            "Fecha Último Período Cargado - Sell Out"),
        last_date.alias("Selección Fecha"),
        F.when(alone, F.col("_low")).otherwise("SELECCIÓN MULTIPLE").alias("Texto Segmento Categoría"),
    )


def measure_names() -> list[str]:
    """Every measure that can be asked for by name."""
    return [*MEASURES, *SWITCHES, *TEXTS]


def members(df: DataFrame, column: str) -> DataFrame:
    """Member list of a selector."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def selected_label(df: DataFrame, column: str) -> DataFrame:
    return df.agg(keys.single_or_multiple(column).alias("label"))
