"""Windows, measures and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.functions import dates, formats, ratios
from panelwright.operators.totals import percent_of_total, with_totals
from panelwright.operators.grid import dense_months
from panelwright.plans import measures, periods, reports

from .registry import add, rounded, table
from .star_view import METRICS, SQL_CALENDAR, calendar as star_calendar, months, sql_wide, wide

ANCHOR = 200012
COMPANY = "Brand#12"


def idx(period: int) -> int:
    return period // 100 * 12 + period % 100


# Plain interval arithmetic for the SQL side, written out per window.
# The first and last month of each window, by the month index of its anchor.
def sql_interval(window: str, anchor: int = ANCHOR) -> tuple[int, int]:
    a, year = idx(anchor), anchor // 100
    return {
        "MES": (a, a), "MES-1": (a - 1, a - 1), "MES LY": (a - 12, a - 12),
        "L3M": (a - 2, a), "L3M-1": (a - 5, a - 3), "L3M LY": (a - 14, a - 12),
        "L4M": (a - 3, a), "L4M-1": (a - 7, a - 4), "L4M LY": (a - 15, a - 12),
        "L6M": (a - 5, a), "L6M-1": (a - 11, a - 6), "L6M LY": (a - 17, a - 12),
        "YTD": (year * 12 + 1, a), "YTD-1": (year * 12 - 11, a - 12),
        "TAM": (a - 11, a), "TAM-1": (a - 23, a - 12),
    }[window.upper()]


def fsum(window: str, anchor: int = ANCHOR, extra: str = "") -> str:
    lo, hi = sql_interval(window, anchor)
    return f"CAST(sum(value) FILTER (WHERE pidx BETWEEN {lo} AND {hi}{extra}) AS DOUBLE)"


def slug(name: str) -> str:
    text = name.lower()
    for a, b in [("%", "pct_"), ("-1", "_1"), (" ", "_"), ("á", "a"), ("í", "i"), ("ó", "o")]:
        text = text.replace(a, b)
    return text


def kind_variant(window: str) -> tuple[str, str]:
    if window.endswith("-1"):
        return window[:-2], "prev"
    if window.endswith(" LY"):
        return window[:-3], "ly"
    return window, "current"


# ---- sales per window (PW1-PW16) --------------------------------------------------

def _window_sales(window: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        market = wide(spark, sf, ["manufacturer", "pidx"])
        b = periods.block(ANCHOR, *kind_variant(window))
        sums = periods.block_sums(market, ["manufacturer"], {"sales": b})
        return sums.selectExpr("manufacturer", f"{ratios.zero('sales')} AS sales")

    return query


for w in ["MES", "MES-1", "MES LY", "L3M", "L3M-1", "L3M LY", "L4M", "L4M-1", "L4M LY", "L6M", "L6M-1", "L6M LY",
          "YTD", "YTD-1", "TAM", "TAM-1"]:
    add(f"ventas_{slug(w)}", _window_sales(w),
        f"WITH {sql_wide()} SELECT manufacturer, coalesce({fsum(w)}, 0) AS sales FROM wf GROUP BY 1")


# ---- the measure registry ----------------------------------------------------------

GROUP = ["category", "manufacturer"]
SQL_SHARE = "CASE WHEN {m} IS NULL OR {m} = 0 THEN 0 ELSE {s} / {m} END"


def q(window: str) -> str:
    return window.replace("-", "_").replace(" ", "_").lower()


WINDOW_NAMES = list(measures.WINDOWS)
ZERO_WINDOWS = ["L3M", "L4M", "L4M-1", "L6M-1", "YTD", "YTD-1"]


def sql_measure_base(anchor: int = ANCHOR, metric: str = "Valor €") -> str:
    sums = ", ".join(f"{fsum(w, anchor)} AS s_{q(w)}" for w in WINDOW_NAMES)
    # R4: some windows are 0 when empty, for members and for totals alike
    zeros = ", ".join(
        (f"coalesce(s_{q(w)}, 0) AS s_{q(w)}" if w in ZERO_WINDOWS else f"s_{q(w)}") for w in WINDOW_NAMES
    )
    totals = ", ".join(f"m.m_{q(w)}" for w in WINDOW_NAMES)
    market_sums = ", ".join(f"{fsum(w, anchor)} AS m_{q(w)}" for w in WINDOW_NAMES)
    return (
        f"{sql_wide(metric)}, {SQL_CALENDAR}, "
        f"raw AS (SELECT category, manufacturer, {sums}, CAST(sum(value) AS DOUBLE) AS s_all FROM wf GROUP BY 1, 2), "
        f"mem AS (SELECT category, manufacturer, s_all, {zeros} FROM raw), "
        f"mkt AS (SELECT category, {market_sums}, CAST(sum(value) AS DOUBLE) AS m_all FROM wf GROUP BY 1), "
        f"x AS (SELECT mem.*, {totals}, m.m_all FROM mem JOIN mkt m ON mem.category = m.category)"
    )


def sql_prior(window: str, anchor: int) -> str:
    lo, hi = sql_interval(window, anchor)
    return f"EXISTS (SELECT 1 FROM cal WHERE pidx BETWEEN {lo} AND {hi})"


def sql_measure(name: str, anchor: int = ANCHOR) -> str:
    """SQL of one plain measure over ``x`` (field = company)."""
    def share(w):
        return SQL_SHARE.format(s=f"s_{q(w)}", m=f"m_{q(w)}")

    compared = {"L4M": ("L4M", "L4M-1"), "L6M": ("L6M", "L6M-1"), "L3M": ("L3M", "L3M LY"), "L3M LY": ("L3M", "L3M LY"),
                "Mes": ("Mes", "Mes-1"), "Mes LY": ("Mes", "Mes LY"), "TAM": ("TAM", "TAM-1"), "YTD": ("YTD", "YTD-1")}
    if name == "Ventas":
        return "s_all"
    if name == "Market Share":
        return SQL_SHARE.format(s="s_all", m="m_all")
    if name.startswith("Ventas Globales "):
        w = name[len("Ventas Globales "):-len(" Switch")]
        return f"coalesce(m_{q(w)}, 0)" if w in ZERO_WINDOWS else f"m_{q(w)}"
    if name.startswith("Ventas "):
        return f"s_{q(name[len('Ventas '):])}"
    if name.startswith("Market Share "):
        return share(name[len("Market Share "):])
    if name.startswith("%Peso "):
        return share(name[len("%Peso "):])
    if name.startswith("Crecimiento "):
        a, b = compared[name[len("Crecimiento "):]]
        return f"coalesce(s_{q(a)}, 0) - coalesce(s_{q(b)}, 0)"
    if name.startswith("%Crecimiento "):
        a, b = compared[name[len("%Crecimiento "):]]
        return f"CASE WHEN coalesce(s_{q(b)}, 0) = 0 THEN 0 ELSE coalesce(s_{q(a)}, 0) / s_{q(b)} - 1 END"
    if name.startswith("BPS "):
        a, b = compared[name[len("BPS "):]]
        return (f"CASE WHEN {sql_prior(b, anchor)} THEN (coalesce({share(a)}, 0) - coalesce({share(b)}, 0)) * 10000 "
                "ELSE 0 END")
    raise ValueError(name)


def digits(name: str) -> int:
    if name.startswith(("BPS",)):
        return 4
    return 8 if name.startswith(("%", "Market Share", "Peso")) else 4


def measure_query(names: list[str], anchor: int = ANCHOR, period_type: str = "L4M", metric: str = "Valor €"):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        fact = wide(spark, sf, [*GROUP, "period_id", "pidx"], metric)
        out = measures.measure_table(
            fact, GROUP, names, anchor, months(spark, sf), period_type=period_type, field="Compañía"
        )
        return out.select(*GROUP, *[F.round(F.col(f"`{n}`"), digits(n)).alias(slug(n)) for n in names])

    return query


# Fixed values, written out a second time so that the twins don't follow the library: the measure that a switch stands for
# by period type, and the measures of the parameters in order.
TYPES = ("MES", "L4M", "YTD", "TAM")
TWIN_SWITCHES = {
    "%Crecimiento Período L3M LY Switch": ("%Crecimiento Mes LY", "%Crecimiento L3M", "%Crecimiento YTD",
        "%Crecimiento TAM"),
    "%Crecimiento Período LY Switch": ("%Crecimiento Mes LY", "%Crecimiento L4M", "%Crecimiento YTD",
        "%Crecimiento TAM"),
    "%Crecimiento Período Switch": ("%Crecimiento Mes", "%Crecimiento L4M", "%Crecimiento YTD", "%Crecimiento TAM"),
    "BPS Período L3M LY Switch": ("BPS Mes LY", "BPS L3M LY", "BPS YTD", "BPS TAM"),
    "BPS Período LY Switch": ("BPS Mes LY", "BPS L4M", "BPS YTD", "BPS TAM"),
    "BPS Período Switch": ("BPS Mes", "BPS L4M", "BPS YTD", "BPS TAM"),
    "Crecimiento Ventas Períodos LY Switch": ("Crecimiento Mes LY", "Crecimiento L4M", "Crecimiento YTD",
        "Crecimiento TAM"),
    "Crecimiento Ventas Períodos Switch": ("Crecimiento Mes", "Crecimiento L4M", "Crecimiento YTD",
        "Crecimiento TAM"),
    "Market Share Período L3M Switch": ("Market Share Mes", "Market Share L3M", "Market Share YTD",
        "Market Share TAM"),
    "Market Share Período Switch": ("Market Share Mes", "Market Share L4M", "Market Share YTD", "Market Share TAM"),
    "Market Share Período-1 Switch": ("Market Share Mes-1", "Market Share L4M-1", "Market Share YTD-1",
        "Market Share TAM-1"),
    "Market Share Y-1 Switch": ("Market Share Mes LY", "Market Share L4M-1", "Market Share YTD-1",
        "Market Share TAM-1"),
    "Ventas Periodos-1 Switch": ("Ventas Mes-1", "Ventas L4M-1", "Ventas YTD-1", "Ventas TAM-1"),
    "Ventas Períodos Switch": ("Ventas Mes", "Ventas L4M", "Ventas YTD", "Ventas TAM"),
    "Ventas Y-1 Switch": ("Ventas Mes LY", "Ventas L4M-1", "Ventas YTD-1", "Ventas TAM-1"),
}
TWIN_PARAMETERS = {
    "Market Year": ["Market Share Período Switch", "Ventas Períodos Switch", "BPS Período LY Switch"],
    "Market Year-1": ["Market Share Y-1 Switch", "Ventas Y-1 Switch"],
    "Market Período-1": ["Market Share Período-1 Switch", "Ventas Periodos-1 Switch"],
    "Market Período": ["Market Share Período Switch", "Ventas Períodos Switch", "BPS Período Switch",
        "Crecimiento Ventas Períodos Switch", "%Crecimiento Período Switch"],
}


def twin_switched(name: str, kind: str) -> str:
    return TWIN_SWITCHES[name][TYPES.index(kind)] if name in TWIN_SWITCHES else name


def measure_sql(names: list[str], anchor: int = ANCHOR, period_type: str = "L4M", metric: str = "Valor €") -> str:
    plain = {n: sql_measure(twin_switched(n, period_type), anchor) for n in names}
    unwindowed = any(n in ("Ventas", "Market Share") for n in names)
    columns = ", ".join(f"round({e}, {digits(n)}) AS {slug(n)}" for n, e in plain.items())
    # members that exist within the months the windows span
    used = set()
    for n in names:
        used |= set(measures.MEASURES[twin_switched(n, period_type)].windows)
    where = ""
    if not unwindowed:
        lo = min(sql_interval(w, anchor)[0] for w in used)
        hi = max(sql_interval(w, anchor)[1] for w in used)
        where = (f" WHERE EXISTS (SELECT 1 FROM wf WHERE wf.category = x.category AND "
                 f"wf.manufacturer = x.manufacturer AND pidx BETWEEN {lo} AND {hi})")
    return f"WITH {sql_measure_base(anchor, metric)} SELECT category, manufacturer, {columns} FROM x{where}"


def add_measures(query_name: str, names: list[str], **options) -> None:
    add(query_name, measure_query(names, **options), measure_sql(names, **options))


def of(prefix: str, keep=lambda n: True) -> list[str]:
    return [n for n in measures.MEASURES if n.startswith(prefix) and keep(n)]


add_measures("ventas_all_windows", ["Ventas", *[f"Ventas {w}" for w in WINDOW_NAMES]])
add_measures("market_share_all_windows", of("Market Share"))
for name in ["Mes", "L3M", "L4M", "YTD", "TAM"]:
    add_measures(f"market_share_{slug(name)}", [f"Market Share {name}"])
add_measures("bps_all_windows", of("BPS "))
for name in ["Mes", "Mes LY", "L3M LY", "L4M", "YTD", "TAM"]:
    add_measures(f"bps_{slug(name)}", [f"BPS {name}"])
add_measures("peso_all_windows", of("%Peso "))
add_measures("ventas_globales_all_windows", of("Ventas Globales "))
add_measures("growth_all_windows", of("Crecimiento "))
add_measures("pct_growth_all_windows", of("%Crecimiento "))
for kind in periods.REPORT_TYPES:
    add_measures(f"period_switch_{kind.lower()}", list(TWIN_SWITCHES), period_type=kind)
add_measures("kpi_parameter_42", [n for group in measures.PARAMETER_KPIS.values() for n in group])
for m in METRICS[:1] + METRICS[2:]:
    add_measures(f"kpi_parameter_{slug(m)}", measures.PARAMETER_KPIS["2. L4M"], metric=m)
for anchor in [199504, 199506, 200108]:
    add_measures(f"kpi_parameter_at_{anchor}", [n for g in measures.PARAMETER_KPIS.values() for n in g], anchor=anchor)


# ---- weights and globals per breakdown field (M63-M71, FP1) ------------------------

def _field_query(field: str):
    column = measures.FIELDS[field]
    group = [column] if column == "manufacturer" else ["manufacturer", column]

    def query(spark: SparkSession, sf: str) -> DataFrame:
        fact = wide(spark, sf, [*group, "period_id", "pidx"])
        names = ["Ventas L4M", "Ventas Globales L4M Switch", "%Peso L4M", "%Peso L4M-1"]
        out = measures.measure_table(fact, group, names, ANCHOR, months(spark, sf), field=field)
        return out.select(*group, *[F.round(F.col(f"`{n}`"), digits(n)).alias(slug(n)) for n in names])

    by = ", ".join(group)
    rest = [g for g in group if g != column]
    on = " AND ".join(f"a.{g} = t.{g}" for g in rest) or "true"
    keys = ", ".join(rest)
    lo, hi = sql_interval("L4M-1")[0], sql_interval("L4M")[1]
    sums = f"coalesce({fsum('L4M')}, 0) AS c, coalesce({fsum('L4M-1')}, 0) AS p"
    total = f"SELECT {keys + ', ' if keys else ''}{sums} FROM r{' GROUP BY ' + keys if keys else ''}"
    out = ", ".join(f"a.{g}" for g in group)
    sql = f"""
WITH {sql_wide()}, r AS (SELECT * FROM wf WHERE pidx BETWEEN {lo} AND {hi}),
a AS (SELECT {by}, {sums} FROM r GROUP BY {by}), t AS ({total})
SELECT {out}, round(a.c, 4) AS ventas_l4m, round(t.c, 4) AS ventas_globales_l4m_switch,
  round(CASE WHEN t.c = 0 THEN 0 ELSE a.c / t.c END, 8) AS pct_peso_l4m,
  round(CASE WHEN t.p = 0 THEN 0 ELSE a.p / t.p END, 8) AS pct_peso_l4m_1
FROM a JOIN t ON {on}"""
    return query, sql


for field in measures.FIELDS:
    add(f"peso_by_{measures.FIELDS[field]}", *_field_query(field))


# ---- period framework ---------------------------------------------------------------

LONG_WINDOWS = [(k, v) for k in periods.TYPES for v in periods.VARIANTS]


def _name(kind: str, variant: str) -> str:
    return kind + {"current": "", "prev": "-1", "ly": " LY"}[variant]


def _sql_interval_kv(kind: str, variant: str, anchor: int = ANCHOR) -> tuple[int, int]:
    if kind == "YTD" and variant == "ly":
        variant = "prev"
    if kind == "TAM" and variant == "ly":
        variant = "prev"
    return sql_interval(_name(kind, variant), anchor)


def window_table(spark, sf):
    return periods.window_table(months(spark, sf), 199506).select("kind", "variant", "pidx")


_values = ", ".join(
    f"('{k}', '{v}', {lo}, {hi})"
    for k, v in LONG_WINDOWS for lo, hi in [_sql_interval_kv(k, v, 199506)]
)
add("period_window_table", window_table, f"""
WITH {SQL_CALENDAR} SELECT kind, variant, pidx FROM cal JOIN (VALUES {_values}) AS s(kind, variant, lo, hi)
ON pidx BETWEEN lo AND hi""")


def sales_by_window(spark, sf):
    windows = periods.window_table(months(spark, sf), ANCHOR)
    market = wide(spark, sf, ["manufacturer", "pidx"])
    out = periods.sales_by_window(market, ["manufacturer"], windows)
    labels = periods.window_labels(windows)
    return out.join(F.broadcast(labels), ["kind", "variant"]).withColumn("sales", F.col("sales").cast("double"))


_values = ", ".join(
    f"('{k}', '{v}', {lo}, {hi})" for k, v in LONG_WINDOWS for lo, hi in [_sql_interval_kv(k, v)]
)
_label = ("lpad(CAST((p - 1) % 12 + 1 AS VARCHAR), 2, '0') || '/' || CAST((p - 1) // 12 AS VARCHAR)")
add("sales_by_window_long", sales_by_window, f"""
WITH {sql_wide()}, s AS (SELECT * FROM (VALUES {_values}) AS s(kind, variant, lo, hi))
SELECT manufacturer, kind, variant, CAST(sum(value) AS DOUBLE) AS sales,
  any_value({_label.replace('p -', 'lo -')} || ' - ' || {_label.replace('p -', 'hi -')}) AS label
FROM wf JOIN s ON pidx BETWEEN lo AND hi GROUP BY 1, 2, 3""")

ALL_FRAMES = [(k, v) for k, v in LONG_WINDOWS]


def windows_all_anchors(spark, sf):
    market = wide(spark, sf, ["manufacturer", "pidx"])
    out = periods.all_anchors(market, ["manufacturer"], ALL_FRAMES, calendar=months(spark, sf))
    return out.select(
        "manufacturer", "pidx", *[F.col(f"{k}_{v}").cast("double").alias(f"{k}_{v}".lower()) for k, v in ALL_FRAMES]
    )


def _sql_frame(kind: str, variant: str) -> str:
    n = {"MES": 1, "L3M": 3, "L4M": 4, "L6M": 6, "TAM": 12, "YTD": 0}[kind]
    if kind == "YTD":
        back = 0 if variant == "current" else 12
        cond = f"b.pidx BETWEEN (g.pidx - 1) // 12 * 12 + 1 - {back} AND g.pidx - {back}"
    else:
        hi = {"current": 0, "prev": n, "ly": 12}[variant]
        cond = f"b.pidx BETWEEN g.pidx - {hi + n - 1} AND g.pidx - {hi}"
    return f"CAST(coalesce(sum(b.v) FILTER (WHERE {cond}), 0) AS DOUBLE) AS {kind.lower()}_{variant}"


add("windows_all_anchors", windows_all_anchors, f"""
WITH {sql_wide()}, {SQL_CALENDAR},
mo AS (SELECT manufacturer, pidx, sum(value) AS v FROM wf GROUP BY 1, 2),
g AS (SELECT manufacturer, cal.pidx FROM (SELECT DISTINCT manufacturer FROM wf) AS d CROSS JOIN cal)
SELECT g.manufacturer, g.pidx, {', '.join(_sql_frame(k, v) for k, v in ALL_FRAMES)}
FROM g JOIN mo b ON b.manufacturer = g.manufacturer GROUP BY 1, 2""")


def shares_all_anchors(spark, sf):
    market = wide(spark, sf, ["manufacturer", "pidx"])
    out = periods.all_anchors(market, ["manufacturer"], [("L4M", "current"), ("L4M", "prev")], calendar=months(spark, sf))
    out = with_totals(out, {"tc": "L4M_current", "tp": "L4M_prev"}, ["pidx"])
    share, before = ratios.share("L4M_current", "tc"), ratios.share("L4M_prev", "tp")
    out = out.selectExpr("manufacturer", "pidx", f"{share} AS share", f"{before} AS share_prev",
                         f"{ratios.bps(share, before, '(tp > 0)')} AS bps")
    return rounded(out, share=8, share_prev=8, bps=4)


add("shares_all_anchors", shares_all_anchors, f"""
WITH {sql_wide()}, {SQL_CALENDAR},
mo AS (SELECT manufacturer, pidx, sum(value) AS v FROM wf GROUP BY 1, 2),
g AS (SELECT manufacturer, cal.pidx FROM (SELECT DISTINCT manufacturer FROM wf) AS d CROSS JOIN cal),
f AS (SELECT g.manufacturer, g.pidx,
  CAST(coalesce(sum(b.v) FILTER (WHERE b.pidx BETWEEN g.pidx - 3 AND g.pidx), 0) AS DOUBLE) AS c,
  CAST(coalesce(sum(b.v) FILTER (WHERE b.pidx BETWEEN g.pidx - 7 AND g.pidx - 4), 0) AS DOUBLE) AS p
  FROM g JOIN mo b ON b.manufacturer = g.manufacturer GROUP BY 1, 2),
t AS (SELECT pidx, CAST(sum(value) AS DOUBLE) AS v FROM wf GROUP BY 1),
tt AS (SELECT cal.pidx,
  coalesce(sum(t.v) FILTER (WHERE t.pidx BETWEEN cal.pidx - 3 AND cal.pidx), 0) AS tc,
  coalesce(sum(t.v) FILTER (WHERE t.pidx BETWEEN cal.pidx - 7 AND cal.pidx - 4), 0) AS tp
  FROM cal CROSS JOIN t GROUP BY 1)
SELECT manufacturer, f.pidx, round(CASE WHEN tc = 0 THEN 0 ELSE c / tc END, 8) AS share,
  round(CASE WHEN tp = 0 THEN 0 ELSE p / tp END, 8) AS share_prev,
  round(CASE WHEN tp > 0 THEN (c / tc - p / tp) * 10000 ELSE 0 END, 4) AS bps
FROM f JOIN tt ON f.pidx = tt.pidx""")


def compare_back(spark, sf):
    monthly = wide(spark, sf, ["category", "pidx"]).groupBy("category", "pidx").agg(F.sum("value").alias("sales"))
    grid = dense_months(monthly, ["category"], ["sales"])
    out = periods.compare_back(periods.compare_back(grid, ["category"], 1, "previous"), ["category"], 12, "year_ago")
    return out.select("category", "pidx", *[F.col(c).cast("double").alias(c) for c in ["sales", "previous", "year_ago"]])


add("previous_period_and_year", compare_back, f"""
WITH {sql_wide()}, {SQL_CALENDAR},
mo AS (SELECT category, pidx, sum(value) AS v FROM wf GROUP BY 1, 2),
g AS (SELECT category, cal.pidx, coalesce(mo.v, 0) AS v FROM (SELECT DISTINCT category FROM wf) AS d CROSS JOIN cal
  LEFT JOIN mo USING (category, pidx))
SELECT category, pidx, CAST(v AS DOUBLE) AS sales,
  CAST(lag(v) OVER (PARTITION BY category ORDER BY pidx) AS DOUBLE) AS previous,
  CAST(lag(v, 12) OVER (PARTITION BY category ORDER BY pidx) AS DOUBLE) AS year_ago FROM g""")


def percent_of_total_query(spark, sf):
    sums = wide(spark, sf, ["manufacturer"]).groupBy("manufacturer").agg(F.sum("value").alias("v"))
    out = percent_of_total(sums, "v", "pct").select("manufacturer", "pct")
    return rounded(out, pct=10)


add("percent_of_total", percent_of_total_query, f"""
WITH {sql_wide()}, s AS (SELECT manufacturer, sum(value) AS v FROM wf GROUP BY 1)
SELECT manufacturer, round(CAST(v AS DOUBLE) / CAST(sum(v) OVER () AS DOUBLE), 10) AS pct FROM s""")


# ---- reports -----------------------------------------------------------------------

def sql_members(field: str, cur: str, prev: str, keep_empty: bool, prior: str, metric: str = "Valor €",
                where: str = "") -> str:
    """CTEs ending in ``y``: the comparison columns per member. ``cur``/``prev`` are SQL conditions on pidx."""
    having = "" if keep_empty else f" HAVING sum(value) FILTER (WHERE {cur}) > 0"
    return f"""{sql_wide(metric)}, {SQL_CALENDAR},
k AS (SELECT * FROM wf {where}),
t AS (SELECT coalesce(CAST(sum(value) FILTER (WHERE {cur}) AS DOUBLE), 0) AS tc,
  coalesce(CAST(sum(value) FILTER (WHERE {prev}) AS DOUBLE), 0) AS tp, {prior} AS has_prior FROM k),
v AS (SELECT {field}, coalesce(CAST(sum(value) FILTER (WHERE {cur}) AS DOUBLE), 0) AS vc,
  coalesce(CAST(sum(value) FILTER (WHERE {prev}) AS DOUBLE), 0) AS vp FROM k WHERE {field} IS NOT NULL
  GROUP BY 1{having}),
z AS (SELECT v.*, has_prior, CASE WHEN tc = 0 THEN 0 ELSE vc / tc END AS share,
  CASE WHEN tp = 0 THEN 0 ELSE vp / tp END AS share_prev FROM v CROSS JOIN t),
y AS (SELECT {field}, vc, vp, has_prior, share, share_prev,
  CASE WHEN has_prior THEN (share - share_prev) * 10000 ELSE 0 END AS bps,
  CASE WHEN has_prior THEN vc - vp ELSE 0 END AS growth,
  CASE WHEN vp = 0 THEN 0 ELSE vc / vp - 1 END AS pct_growth FROM z)"""


def between(window: str, anchor: int = ANCHOR) -> str:
    lo, hi = sql_interval(window, anchor)
    return f"pidx BETWEEN {lo} AND {hi}"


def selection(kind: str = "L4M", anchor: int = ANCHOR) -> periods.Selection:
    return periods.resolve([anchor // 100], [anchor % 100], kind)


def spanned(sel: periods.Selection) -> tuple[int, int]:
    """The months from a selection's first to its last."""
    return min(sel.current.first, sel.previous.first), max(sel.current.last, sel.previous.last)


def two_years(anchor: int) -> tuple[int, int]:
    """The months that the windows of an anchor can reach."""
    return idx(anchor) - 23, idx(anchor)


def company_table(spark: SparkSession, sf: str, kind: str = "L4M", anchor: int = ANCHOR) -> DataFrame:
    market = wide(spark, sf, ["manufacturer", "pidx"])
    out = reports.company_table(market, selection(kind, anchor), months(spark, sf))
    return rounded(out, sales=4, share=8, bps=4, growth=4, pct_growth=8)


COMPANY_COLUMNS = ("round(vc, 4) AS sales, round(share, 8) AS share, round(bps, 4) AS bps, "
                   "round(growth, 4) AS growth, round(pct_growth, 8) AS pct_growth, has_prior")

for kind in ["L4M", "MES", "YTD", "TAM"]:
    add("company_table" if kind == "L4M" else f"company_table_{kind.lower()}",
        lambda spark, sf, kind=kind: company_table(spark, sf, kind),
        f"WITH {sql_members('manufacturer', between(kind), between(kind + '-1'), True, sql_prior(kind + '-1', ANCHOR))} "
        f"SELECT manufacturer, {COMPANY_COLUMNS} FROM y")

for anchor in [199504, 199506, 200108]:
    add(f"company_table_at_{anchor}" if anchor != 199504 else "no_prior_bps_zero",
        lambda spark, sf, anchor=anchor: company_table(spark, sf, "L4M", anchor),
        f"WITH {sql_members('manufacturer', between('L4M', anchor), between('L4M-1', anchor), True, sql_prior('L4M-1', anchor))} "
        f"SELECT manufacturer, {COMPANY_COLUMNS} FROM y")


def filtered_company_table(spark, sf):
    market = wide(spark, sf, ["manufacturer", "category", "type_channel", "channel", "business_area", "pidx"])
    market = reports.apply_filters(market, category=["PROMO", "LARGE"], environment=["Online"], channel=[], area=None)
    out = reports.company_table(market, selection(), months(spark, sf))
    return rounded(out, sales=4, share=8, bps=4, growth=4, pct_growth=8)


_where = "WHERE category IN ('PROMO', 'LARGE') AND type_channel = 'Online'"
add("slicer_filter", filtered_company_table,
    f"WITH {sql_members('manufacturer', between('L4M'), between('L4M-1'), True, sql_prior('L4M-1', ANCHOR), where=_where)} "
    f"SELECT manufacturer, {COMPANY_COLUMNS} FROM y")

BREAKDOWN_COLUMNS = (
    "round(vc, 4) AS sales, round(vp, 4) AS sales_prev, round(growth, 4) AS growth, "
    "round(pct_growth, 8) AS pct_growth, round(share, 8) AS share, round(share_prev, 8) AS share_prev, "
    "round(bps, 4) AS bps, round(share, 8) AS weight, round(share_prev, 8) AS weight_prev, has_prior"
)


def breakdown(spark, sf, field, kind="L4M", keep_empty=True):
    market = wide(spark, sf, [field, "pidx"])
    out = reports.breakdown_table(market, field, selection(kind), months(spark, sf), keep_empty)
    return rounded(out, sales=4, sales_prev=4, growth=4, pct_growth=8, share=8, share_prev=8, bps=4, weight=8,
                   weight_prev=8)


for field in measures.FIELDS.values():
    add(f"breakdown_{field}", lambda spark, sf, field=field: breakdown(spark, sf, field),
        f"WITH {sql_members(field, between('L4M'), between('L4M-1'), True, sql_prior('L4M-1', ANCHOR))} "
        f"SELECT {field}, {BREAKDOWN_COLUMNS} FROM y")

add("breakdown_with_current_sales", lambda spark, sf: breakdown(spark, sf, "sub_brand", "MES", False),
    f"WITH {sql_members('sub_brand', between('MES'), between('MES-1'), False, sql_prior('MES-1', ANCHOR))} "
    f"SELECT sub_brand, {BREAKDOWN_COLUMNS} FROM y")


def breakdown_total(spark, sf):
    market = wide(spark, sf, ["category", "pidx"])
    out = reports.breakdown_table(market, "category", selection("TAM"), months(spark, sf))
    return rounded(reports.with_total_row(out, ["category"], ["sales", "sales_prev"]), sales=4, sales_prev=4)


add("breakdown_with_total_row", breakdown_total,
    f"WITH {sql_members('category', between('TAM'), between('TAM-1'), True, sql_prior('TAM-1', ANCHOR))} "
    "SELECT category, round(vc, 4) AS sales, round(vp, 4) AS sales_prev, 0 AS is_total FROM y UNION ALL "
    "SELECT NULL, round(sum(vc), 4), round(sum(vp), 4), 1 FROM y")


# several months and years: the same months as many years back as years are chosen
def _multi(years, chosen_months):
    def condition(shift):
        pairs = sorted({(y - shift) * 12 + m for y in years for m in chosen_months})
        return f"pidx IN ({', '.join(map(str, pairs))})"

    return condition(0), condition(len(years))


def multi_table(spark, sf, years, chosen):
    sel = periods.resolve(years, chosen)
    out = reports.company_table(wide(spark, sf, ["manufacturer", "pidx"]), sel, months(spark, sf))
    return rounded(out, sales=4, share=8, bps=4, growth=4, pct_growth=8)


for name, years, chosen in [
    ("resolve_months_of_a_year", [1999], [5, 6]),
    ("resolve_two_years", [1998, 1999], list(range(1, 13))),
    ("resolve_without_prior", [1995, 1996], [1, 3, 11]),
]:
    _cur, _prev = _multi(years, chosen)
    add(name, lambda spark, sf, years=years, chosen=chosen: multi_table(spark, sf, years, chosen),
        f"WITH {sql_members('manufacturer', _cur, _prev, True, f'EXISTS (SELECT 1 FROM cal WHERE {_prev})')} "
        f"SELECT manufacturer, {COMPANY_COLUMNS} FROM y")


# cards
def card(spark, sf, anchor=ANCHOR):
    market = wide(spark, sf, ["manufacturer", "pidx"], months=two_years(anchor))
    out = reports.kpi_card(market, COMPANY, anchor, months(spark, sf))
    return rounded(out, sales=4, sales_prev=4, diff=4, pct_diff=8, share_month=8)


def _span_text(window, anchor=ANCHOR):
    lo, hi = sql_interval(window, anchor)
    return " - ".join(f"{(p - 1) % 12 + 1:02d}/{(p - 1) // 12}" for p in (lo, hi))


_mine = f" AND manufacturer = '{COMPANY}'"
add("kpi_card_l6m", card, f"""
WITH {sql_wide()}, {SQL_CALENDAR},
o AS (SELECT coalesce({fsum('L6M', extra=_mine)}, 0) AS c, coalesce({fsum('L6M-1', extra=_mine)}, 0) AS p,
  coalesce({fsum('MES', extra=_mine)}, 0) AS m, {fsum('MES')} AS mm FROM wf)
SELECT '{_span_text('L6M-1')}' AS label_prev, '{_span_text('L6M')}' AS label, round(p, 4) AS sales_prev,
  round(c, 4) AS sales, round(c - p, 4) AS diff, round(CASE WHEN p = 0 THEN 0 ELSE (c - p) / p END, 8) AS pct_diff,
  round(CASE WHEN mm IS NULL OR mm = 0 THEN 0 ELSE m / mm END, 8) AS share_month,
  {sql_prior('L6M-1', ANCHOR)} AS has_prior,
  CASE WHEN NOT {sql_prior('L6M-1', ANCHOR)} THEN 'none' WHEN c > p THEN 'up' WHEN c < p THEN 'down' ELSE 'flat' END
  AS trend FROM o""")


def card_multi(spark, sf):
    sel = periods.resolve([1999, 2000], [3, 4, 9])
    market = wide(spark, sf, ["manufacturer", "pidx"], months=spanned(sel))
    out = reports.kpi_card_selection(market, COMPANY, sel, months(spark, sf))
    return rounded(out, sales=4, sales_prev=4, diff=4, pct_diff=8, share=8, bps=4)


_cur, _prev = _multi([1999, 2000], [3, 4, 9])
add("kpi_card_multi", card_multi, f"""
WITH {sql_wide()}, {SQL_CALENDAR},
o AS (SELECT coalesce(CAST(sum(value) FILTER (WHERE {_cur}{_mine}) AS DOUBLE), 0) AS c,
  coalesce(CAST(sum(value) FILTER (WHERE {_prev}{_mine}) AS DOUBLE), 0) AS p,
  CAST(sum(value) FILTER (WHERE {_cur}) AS DOUBLE) AS mc, CAST(sum(value) FILTER (WHERE {_prev}) AS DOUBLE) AS mp,
  EXISTS (SELECT 1 FROM cal WHERE {_prev}) AS hp FROM wf)
SELECT round(p, 4) AS sales_prev, round(c, 4) AS sales, round(c - p, 4) AS diff,
  round(CASE WHEN p = 0 THEN 0 ELSE (c - p) / p END, 8) AS pct_diff, round(c / mc, 8) AS share,
  round(CASE WHEN hp THEN (c / mc - p / mp) * 10000 ELSE 0 END, 4) AS bps, hp AS has_prior,
  CASE WHEN NOT hp THEN 'none' WHEN c > p THEN 'up' WHEN c < p THEN 'down' ELSE 'flat' END AS trend FROM o""")


def comparison(spark, sf, anchor=ANCHOR):
    out = reports.window_comparison(
        wide(spark, sf, ["manufacturer", "pidx"], months=two_years(anchor)), COMPANY, anchor, months(spark, sf))
    return rounded(out, sales=4, sales_prev=4, share=8, share_prev=8, bps=4)


def _sql_comparison(anchor):
    rows = []
    for i, k in enumerate(["MES", "L4M", "YTD", "TAM"]):
        p = k + "-1"
        rows.append(
            f"SELECT {i} AS position, '{k}' AS kind, coalesce({fsum(k, anchor, _mine)}, 0) AS c, "
            f"coalesce({fsum(p, anchor, _mine)}, 0) AS p, {fsum(k, anchor)} AS mc, {fsum(p, anchor)} AS mp, "
            f"{sql_prior(p, anchor)} AS hp FROM wf"
        )
    return f"""WITH {sql_wide()}, {SQL_CALENDAR}, o AS ({' UNION ALL '.join(rows)}),
s AS (SELECT *, CASE WHEN mc IS NULL OR mc = 0 THEN 0 ELSE c / mc END AS sc,
  CASE WHEN mp IS NULL OR mp = 0 THEN 0 ELSE p / mp END AS sp FROM o),
b AS (SELECT *, CASE WHEN hp THEN (sc - sp) * 10000 ELSE 0 END AS bps FROM s) """


add("window_comparison", comparison, _sql_comparison(ANCHOR) + """
SELECT position, kind, round(c, 4) AS sales, round(p, 4) AS sales_prev, round(sc, 8) AS share,
  round(sp, 8) AS share_prev, round(bps, 4) AS bps, hp AS has_prior FROM b""")
add("bps_by_window",
    lambda spark, sf: rounded(
        reports.bps_by_window(wide(spark, sf, ["manufacturer", "pidx"], months=two_years(199507)), COMPANY, 199507,
                              months(spark, sf)), bps=4),
    _sql_comparison(199507) + """SELECT kind, round(bps, 4) AS bps, hp AS has_prior,
  CASE WHEN NOT hp THEN 'none' WHEN bps > 0 THEN 'up' WHEN bps < 0 THEN 'down' ELSE 'flat' END AS trend FROM b""")


def kpi_row(spark, sf):
    market = wide(spark, sf, ["manufacturer", "pidx"])
    out = reports.company_kpis(market, COMPANY, selection())
    return rounded(out, comp_cur=4, ms_cur=8, ms_prev=8, pct_var_market=8, pct_var_company=8, bps=4)


def sql_es(x: str, decimals: int) -> str:
    """European number text in DuckDB."""
    return f"translate(format('{{:,.{decimals}f}}', {x}), ',.', '.,')"


def sql_es_sig(x: str) -> str:
    branches = "".join(
        f" WHEN least(greatest(0, 1 - floor(log10(abs({x})))), 8) = {d} THEN {sql_es(x, d)}" for d in range(9)
    )
    return f"CASE WHEN {x} = 0 THEN '0'{branches} END"


def sql_es_scale(x: str) -> str:
    return (f"CASE WHEN abs({x}) >= 1e6 THEN {sql_es(f'({x}) / 1e6', 1)} || ' mill.' "
            f"WHEN abs({x}) >= 1e3 THEN {sql_es(f'({x}) / 1e3', 1)} || ' mil' ELSE {sql_es(x, 0)} END")


add("company_kpi_row", kpi_row, f"""
WITH {sql_wide()},
o AS (SELECT {fsum('L4M', extra=_mine)} AS c, {fsum('L4M-1', extra=_mine)} AS p, {fsum('L4M')} AS mc,
  {fsum('L4M-1')} AS mp FROM wf),
r AS (SELECT coalesce(c, 0) AS comp_cur, c / mc AS ms_cur, p / mp AS ms_prev, mc / mp - 1 AS pct_var_market,
  CASE WHEN coalesce(p, 0) = 0 THEN 0 ELSE coalesce(c, 0) / p - 1 END AS pct_var_company,
  (c / mc - coalesce(p, 0) / mp) * 10000 AS bps FROM o)
SELECT round(comp_cur, 4) AS comp_cur, round(ms_cur, 8) AS ms_cur, round(ms_prev, 8) AS ms_prev,
  round(pct_var_market, 8) AS pct_var_market, round(pct_var_company, 8) AS pct_var_company, round(bps, 4) AS bps,
  {sql_es_scale('comp_cur')} AS sales_text, {sql_es('ms_cur * 100', 1)} || ' %' AS share_text,
  {sql_es('pct_var_market * 100', 1)} || ' %' AS pct_var_text, {sql_es_sig('bps')} AS bps_text FROM r""")


def yoy(spark, sf, year=1996):
    out = reports.monthly_yoy(
        wide(spark, sf, ["manufacturer", "pidx"], months=two_years(year * 100 + 12)), COMPANY, year, months(spark, sf))
    return rounded(out, sales=4, sales_prev=4, share=8, share_prev=8, bps=4)


_es_months = ", ".join(f"({i}, '{m}')" for i, m in enumerate(
    # Spanish month labels.
    ["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"], 1))


def _sql_yoy(year):
    return f"""
WITH {sql_wide()}, {SQL_CALENDAR}, mo AS (SELECT * FROM (VALUES {_es_months}) AS m(n, month)),
a AS (SELECT month_number AS n, CAST(sum(value) FILTER (WHERE year = {year}{_mine}) AS DOUBLE) AS c,
  CAST(sum(value) FILTER (WHERE year = {year - 1}{_mine}) AS DOUBLE) AS p,
  CAST(sum(value) FILTER (WHERE year = {year}) AS DOUBLE) AS mc,
  CAST(sum(value) FILTER (WHERE year = {year - 1}) AS DOUBLE) AS mp FROM wf GROUP BY 1),
s AS (SELECT mo.n, mo.month, coalesce(c, 0) AS c, coalesce(p, 0) AS p,
  CASE WHEN coalesce(mc, 0) = 0 THEN 0 ELSE coalesce(c, 0) / mc END AS sc,
  CASE WHEN coalesce(mp, 0) = 0 THEN 0 ELSE coalesce(p, 0) / mp END AS sp,
  EXISTS (SELECT 1 FROM cal WHERE pidx = {(year - 1) * 12} + mo.n) AS hp FROM mo LEFT JOIN a ON mo.n = a.n)
SELECT n AS month_number, month, round(c, 4) AS sales, round(p, 4) AS sales_prev, round(sc, 8) AS share,
  round(sp, 8) AS share_prev, round(CASE WHEN hp THEN (sc - sp) * 10000 ELSE 0 END, 4) AS bps FROM s"""


add("monthly_yoy", yoy, _sql_yoy(1996))
add("monthly_yoy_last_year", lambda spark, sf: yoy(spark, sf, 2001), _sql_yoy(2001))
add("monthly_yoy_first_year", lambda spark, sf: yoy(spark, sf, 1995), _sql_yoy(1995))


# rankings
def top7(spark, sf):
    market = wide(spark, sf, ["manufacturer", "pidx"])
    out = reports.top_companies(market, selection(), months(spark, sf))
    return rounded(out, sales=4, growth=4)


_trend = ("CASE WHEN NOT has_prior THEN 'none' WHEN growth > 0 THEN 'up' WHEN growth < 0 THEN 'down' "
          "ELSE 'flat' END")
add("top7_trend", top7,
    f"WITH {sql_members('manufacturer', between('L4M'), between('L4M-1'), True, sql_prior('L4M-1', ANCHOR))} "
    f"SELECT manufacturer, round(vc, 4) AS sales, round(growth, 4) AS growth, has_prior, {_trend} AS trend FROM y "
    "ORDER BY vc DESC, manufacturer LIMIT 7")


def top7_own(spark, sf):
    market = wide(spark, sf, ["sub_brand", "pidx"])
    out = reports.top_companies_by_own_history(market, selection("MES"), 7, "sub_brand")
    return rounded(out, sales=4, growth=4)


add("top7_trend_own_history", top7_own, f"""
WITH {sql_wide()}, a AS (SELECT sub_brand, {fsum('MES')} AS c, {fsum('MES-1')} AS p FROM wf GROUP BY 1)
SELECT sub_brand, round(c, 4) AS sales, round(c - coalesce(p, 0), 4) AS growth,
  CASE WHEN p IS NULL THEN 'none' WHEN c > p THEN 'up' WHEN c < p THEN 'down' ELSE 'flat' END AS trend
FROM a WHERE c > 0 ORDER BY c DESC, sub_brand LIMIT 7""")


def ranked(spark, sf):
    market = wide(spark, sf, ["manufacturer", "pidx"])
    out = reports.ranked_market(market, selection(), months(spark, sf))
    return rounded(out, sales=4, share=8, growth=4, pct_growth=8)


_sym = "CASE WHEN NOT has_prior THEN '○' WHEN {0} > 0 THEN '▲' WHEN {0} < 0 THEN '▼' ELSE '–' END || ' ' || "
add("ranked_market_table", ranked,
    f"WITH {sql_members('manufacturer', between('L4M'), between('L4M-1'), False, sql_prior('L4M-1', ANCHOR))} "
    f"SELECT manufacturer, round(vc, 4) AS sales, round(share, 8) AS share, round(growth, 4) AS growth, "
    f"round(pct_growth, 8) AS pct_growth, {sql_es('vc', 0)} AS sales_text, {sql_es('share * 100', 1)} || ' %' AS share_text, "
    f"{_sym.format('growth')}{sql_es('growth', 0)} AS growth_text, "
    f"{_sym.format('pct_growth')}{sql_es('pct_growth * 100', 1)} || ' %' AS pct_growth_text FROM y")


# trends
def trend(spark, sf, field):
    return rounded(reports.trend(wide(spark, sf, [field, "pidx"]), field, calendar=months(spark, sf)), sales=4, share=8)


def _sql_trend(field):
    return f"""
WITH {sql_wide()}, {SQL_CALENDAR},
best AS (SELECT {field}, sum(value) AS v FROM wf WHERE {field} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 6),
mk AS (SELECT pidx, CAST(sum(value) AS DOUBLE) AS m FROM wf GROUP BY 1),
s AS (SELECT {field}, pidx, CAST(sum(value) AS DOUBLE) AS v FROM wf GROUP BY 1, 2)
SELECT cal.period_id, best.{field}, round(coalesce(s.v, 0), 4) AS sales,
  round(CASE WHEN mk.m IS NULL OR mk.m = 0 THEN 0 ELSE coalesce(s.v, 0) / mk.m END, 8) AS share
FROM cal CROSS JOIN best LEFT JOIN mk ON mk.pidx = cal.pidx
LEFT JOIN s ON s.pidx = cal.pidx AND s.{field} = best.{field}"""


for field in ["manufacturer", "product", "sub_channel"]:
    add("top6_trend" if field == "manufacturer" else f"top6_trend_{field}",
        lambda spark, sf, field=field: trend(spark, sf, field), _sql_trend(field))

def matrix(spark, sf):
    out = reports.trend_matrix(wide(spark, sf, ["manufacturer", "pidx"]), "manufacturer", months(spark, sf))
    return out.select("manufacturer", *[F.round(F.col(f"`{p}`"), 4).alias(f"p{p}") for p in out.columns[1:]])


# The months of the orders, written out: a column per month.
MATRIX_MONTHS = [12 * year + month for year in range(1995, 2002) for month in range(1, 13) if (year, month) <= (2001, 8)]
_cells = ", ".join(f"round(coalesce(CAST(sum(CASE WHEN pidx = {p} THEN value END) AS DOUBLE), 0), 4) AS p{(p - 1) // 12 * 100 + (p - 1) % 12 + 1}"
                   for p in MATRIX_MONTHS)
add("trend_matrix_pivot", matrix, f"""
WITH {sql_wide()}, best AS (SELECT manufacturer FROM wf GROUP BY 1 ORDER BY sum(value) DESC, 1 LIMIT 6)
SELECT manufacturer, {_cells} FROM wf WHERE manufacturer IN (SELECT manufacturer FROM best) GROUP BY 1""")


# segments
def segments(spark, sf, chosen=None, kind="L4M"):
    market = wide(spark, sf, ["category", "pidx"])
    out = reports.segment_comparison(market, selection(kind), months(spark, sf), chosen)
    return rounded(out, cur=4, prev=4, growth=4, pct_growth=8, bps=4)


_segment_columns = (
    "category, round(vc, 4) AS cur, round(vp, 4) AS prev, round(growth, 4) AS growth, "
    "round(pct_growth, 8) AS pct_growth, round(bps, 4) AS bps, CASE WHEN NOT has_prior THEN 'none' "
    "WHEN vc > vp THEN 'up' WHEN vc < vp THEN 'down' ELSE 'flat' END AS trend"
)
add("segment_compare", segments,
    f"WITH {sql_members('category', between('L4M'), between('L4M-1'), True, sql_prior('L4M-1', ANCHOR))} "
    f"SELECT {_segment_columns} FROM y ORDER BY category LIMIT 4")
add("segment_compare_chosen", lambda spark, sf: segments(spark, sf, ["SMALL", "PROMO"], "L3M"),
    f"WITH {sql_members('category', between('L3M'), between('L3M-1'), True, sql_prior('L3M-1', ANCHOR))} "
    f"SELECT {_segment_columns} FROM y WHERE category IN ('SMALL', 'PROMO')")

_sql_segment = f"""WITH {sql_wide()},
a AS (SELECT category, {fsum('L4M')} AS c, {fsum('L4M-1')} AS p FROM wf WHERE category IS NOT NULL GROUP BY 1),
t AS (SELECT sum(c) AS tc, sum(p) AS tp FROM a)
"""
add("segment_table",
    lambda spark, sf: rounded(reports.segment_table(wide(spark, sf, ["category", "pidx"], months=spanned(selection())), selection()),
                              cur=4, prev=4, growth=4, pct_growth=8, bps=4),
    _sql_segment + """SELECT category, round(c, 4) AS cur, round(p, 4) AS prev, round(c - coalesce(p, 0), 4) AS growth,
  round(CASE WHEN p IS NULL OR p = 0 THEN NULL ELSE c / p - 1 END, 8) AS pct_growth,
  round(CASE WHEN tp IS NULL OR tp = 0 THEN 0 ELSE (c / tc - coalesce(p, 0) / tp) * 10000 END, 4) AS bps
FROM a CROSS JOIN t WHERE c > 0""")
add("segment_long",
    lambda spark, sf: rounded(
        reports.segment_long(wide(spark, sf, ["category", "pidx"], months=spanned(selection())), selection(), "L4M"), sales=4),
    _sql_segment + """SELECT category, 'L4M' AS period, round(c, 4) AS sales FROM a WHERE c > 0 UNION ALL
SELECT category, 'L4M-1', round(p, 4) FROM a WHERE c > 0""")


# dynamic report
def dynamic(spark, sf, dims, kind="L4M", total=False):
    out = reports.dynamic_report(
        wide(spark, sf, [*dims, "pidx"], months=spanned(selection(kind))), dims, selection(kind))
    if total:
        out = reports.with_total_row(out, dims, ["sales"])
    return rounded(out, sales=4)


for name, dims, kind in [
    ("dynamic_report", ["manufacturer", "category"], "L4M"),
    ("dynamic_report_one_field", ["product"], "YTD"),
    ("dynamic_report_five_fields", ["market", "type_channel", "business_area", "format", "etapas"], "TAM"),
    ("dynamic_report_wide", ["geo", "sub_brand", "channel"], "TAM"),
]:
    _by = ", ".join(dims)
    add(name, lambda spark, sf, dims=dims, kind=kind: dynamic(spark, sf, dims, kind),
        f"WITH {sql_wide()} SELECT {_by}, round(CAST(sum(value) AS DOUBLE), 4) AS sales FROM wf "
        f"WHERE {between(kind)} GROUP BY {_by}")


def subtotals(spark, sf):
    dims = ["market", "type_channel", "business_area", "format", "etapas"]
    rows = wide(spark, sf, [*dims, "pidx"], months=spanned(selection("TAM")))
    return rounded(reports.dynamic_report_with_subtotals(rows, dims, selection("TAM")), sales=4)


add("dynamic_report_subtotals", subtotals,
    f"WITH {sql_wide()} SELECT market, type_channel, business_area, format, etapas, "
    "round(CAST(sum(value) AS DOUBLE), 4) AS sales, CAST(5 - grouping(market) - grouping(type_channel) - grouping(business_area) "
    f"- grouping(format) - grouping(etapas) AS INTEGER) AS level FROM wf WHERE {between('TAM')} "
    "GROUP BY ROLLUP (market, type_channel, business_area, format, etapas)")


def first_quarters(spark, sf):
    """Sales by company over the months that the calendar puts into the first quarter."""
    rows = periods.in_calendar(wide(spark, sf, ["manufacturer", "period_id"]), star_calendar(spark, sf), "quarter = 1")
    return rounded(rows.groupBy("manufacturer").agg(F.sum("value").cast("double").alias("sales")), sales=4)


add("sales_in_calendar_quarter", first_quarters,
    f"WITH {sql_wide()} SELECT manufacturer, round(CAST(sum(value) AS DOUBLE), 4) AS sales FROM wf "
    "WHERE month_number BETWEEN 1 AND 3 GROUP BY 1")
add("dynamic_report_total", lambda spark, sf: dynamic(spark, sf, ["market", "category"], "TAM", True),
    f"WITH {sql_wide()}, r AS (SELECT market, category, CAST(sum(value) AS DOUBLE) AS v FROM wf "
    f"WHERE {between('TAM')} GROUP BY 1, 2) "
    "SELECT market, category, round(v, 4) AS sales, 0 AS is_total FROM r UNION ALL "
    "SELECT NULL, NULL, round(sum(v), 4), 1 FROM r")


# selectors and anchors
for field in ["manufacturer", "channel", "category"]:
    add(f"selector_{field}",
        lambda spark, sf, field=field: measures.members(wide(spark, sf, [field]), field),
        f"WITH {sql_wide()} SELECT DISTINCT {field} FROM wf WHERE {field} IS NOT NULL")


def anchor_months(spark, sf):
    """Default anchor and the anchor a later month falls back to."""
    cal = months(spark, sf)
    default = periods.last_period(wide(spark, sf, ["period_id"]))
    fallback = periods.anchor_in(cal, 209912)
    return cal.filter(F.col("period_id") == fallback).select(
        F.lit(default).alias("default_anchor"), F.col("period_id").alias("fallback_anchor"))


add("anchor_defaults", anchor_months, f"""
WITH {sql_wide()}, {SQL_CALENDAR} SELECT (SELECT max(period_id) FROM wf) AS default_anchor,
(SELECT max(period_id) FROM cal WHERE period_id <= 209912) AS fallback_anchor""")


# formats
def format_columns(spark, sf):
    sums = wide(spark, sf, ["sub_brand", "pidx"]).groupBy("sub_brand", "pidx").agg(
        F.sum("value").cast("double").alias("v"))
    has_prior = f"(pidx > {idx(199601)})"
    return sums.withColumn("small", F.expr("v / 1e7 - 0.002D")).selectExpr(
        "sub_brand", "pidx",
        f"{formats.es_num('v')} AS num", f"{formats.es_num('v', 2)} AS num2", f"{formats.es_pct('small')} AS pct",
        f"{formats.es_mill('v')} AS mill", f"{formats.es_scale('v')} AS scale", f"{formats.es_sig('small')} AS sig",
        f"{ratios.trend_symbol('v - 100000', has_prior)} AS symbol", f"{ratios.trend('v - 100000', has_prior)} AS trend",
    ).withColumn("label", dates.period_label(dates.period_of_pidx("pidx")))


_small = "(v / 1e7 - 0.002)"
add("format_es_columns", format_columns, f"""
WITH {sql_wide()}, s AS (SELECT sub_brand, pidx, CAST(sum(value) AS DOUBLE) AS v FROM wf GROUP BY 1, 2)
SELECT sub_brand, pidx, {sql_es('v', 0)} AS num, {sql_es('v', 2)} AS num2,
  {sql_es(_small + ' * 100', 1)} || ' %' AS pct, {sql_es('v / 1e6', 1)} || ' mill.' AS mill,
  {sql_es_scale('v')} AS scale, {sql_es_sig(_small)} AS sig,
  CASE WHEN pidx <= {idx(199601)} THEN '○' WHEN v > 100000 THEN '▲' WHEN v < 100000 THEN '▼' ELSE '–' END AS symbol,
  CASE WHEN pidx <= {idx(199601)} THEN 'none' WHEN v > 100000 THEN 'up' WHEN v < 100000 THEN 'down' ELSE 'flat' END
  AS trend,
  lpad(CAST((pidx - 1) % 12 + 1 AS VARCHAR), 2, '0') || '/' || CAST((pidx - 1) // 12 AS VARCHAR) AS label
FROM s""")


# context series
def context(spark, sf):
    from panelwright.plans import star
    from .star_view import calendar

    orders = table(spark, sf, "orders")
    series = orders.groupBy(dates.month_int("o_orderdate").alias("period_id")).agg(
        (F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double") / F.count(F.lit(1))).alias("value"))
    cal = calendar(spark, sf)
    return star.context_series(star.context_fact(series, cal), cal)


_context = """ctx AS (SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period_id,
  CAST(year(o_orderdate) AS INTEGER) AS year, any_value(strftime(o_orderdate, '%B')) AS month_long,
  any_value(strftime(o_orderdate, '%Y-%m')) AS period_name,
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS value FROM orders GROUP BY 1, 2)"""
add("context_series", lambda spark, sf: rounded(context(spark, sf), value=8),
    f"WITH {_context} SELECT period_id, year, month_long, period_name, round(value, 8) AS value FROM ctx")
add("context_year_avg", lambda spark, sf: rounded(reports.yearly_average(context(spark, sf)), average=6),
    f"WITH {_context} SELECT year, round(avg(value), 6) AS average FROM ctx GROUP BY 1")


# measure parameters, named by their labels
def parameter(spark, sf, name, kind):
    fact = wide(spark, sf, [*GROUP, "period_id", "pidx"])
    out = measures.parameter_table(fact, GROUP, name, ANCHOR, months(spark, sf), kind, field="Compañía")
    targets = measures.PARAMETERS[name]
    return out.select(*GROUP, *[F.round(F.col(f"`{label}`"), digits(measures.SWITCHES[t][kind])).alias(f"p{i}")
                                for i, (label, t) in enumerate(targets.items())])


for name, kind in [("Market Period", "YTD"), ("Market Year", "MES"), ("Market Year-1", "TAM"), ("Market Period-1", "L4M")]:
    _name_in_model = name.replace("Period", "Período")
    _targets = [twin_switched(t, kind) for t in TWIN_PARAMETERS[_name_in_model]]
    _used = {w for t in _targets for w in measures.MEASURES[t].windows}
    _lo, _hi = min(sql_interval(w)[0] for w in _used), max(sql_interval(w)[1] for w in _used)
    _shown = ", ".join(f"round({sql_measure(t)}, {digits(t)}) AS p{i}" for i, t in enumerate(_targets))
    add(f"parameter_{slug(name)}", lambda spark, sf, n=_name_in_model, kind=kind: parameter(spark, sf, n, kind),
        f"WITH {sql_measure_base()} SELECT category, manufacturer, {_shown} FROM x WHERE EXISTS (SELECT 1 FROM wf "
        f"WHERE wf.category = x.category AND wf.manufacturer = x.manufacturer AND pidx BETWEEN {_lo} AND {_hi})")


def breakdown_texts(spark, sf):
    market = wide(spark, sf, ["format", "pidx"])
    out = reports.breakdown_table(market, "format", selection("YTD"), months(spark, sf))
    out = reports.with_texts(out, ["sales", "sales_prev"], ["weight"])
    return out.select("format", "sales_text", "sales_prev_text", "weight_text")


add("breakdown_with_texts", breakdown_texts,
    f"WITH {sql_members('format', between('YTD'), between('YTD-1'), True, sql_prior('YTD-1', ANCHOR))} "
    f"SELECT format, {sql_es('vc', 0)} AS sales_text, {sql_es('vp', 0)} AS sales_prev_text, "
    f"{sql_es('share * 100', 1)} || ' %' AS weight_text FROM y")


def period_texts(spark, sf):
    """Label columns of the flat extract: period text, and whether a date is in the year to date."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.period_text(F.year(day), F.date_format(day, "MMMM")).alias("period_text"),
        dates.ytd_text(day, F.lit("2000-09-30").cast("date")).alias("ytd"))


add("period_texts", period_texts, """
SELECT o_orderkey, year(o_orderdate) || '-' || strftime(o_orderdate, '%B') AS period_text,
  CASE WHEN o_orderdate <= DATE '2000-09-30' AND year(o_orderdate) = 2000 THEN 'YTD' ELSE 'Fuera' END AS ytd FROM orders""")


def switch_long(spark, sf):
    """Sales by company for every period type of the selector, current and previous."""
    windows = periods.window_table(months(spark, sf), ANCHOR, periods.REPORT_TYPES, ["current", "prev"])
    sums = periods.sales_by_window(wide(spark, sf, ["manufacturer", "pidx"]), ["manufacturer"], windows)
    kinds = periods.period_types(spark)
    return sums.join(kinds, F.expr("kind = period_type")).select(
        "period_type_id", "manufacturer", "variant", F.col("sales").cast("double").alias("sales"))


_rows = ", ".join(
    f"({i}, '{v}', {lo}, {hi})" for i, k in [(4, "MES"), (3, "L4M"), (2, "YTD"), (1, "TAM")]
    for v in ["current", "prev"] for lo, hi in [_sql_interval_kv(k, v)])
add("period_switch_all", switch_long, f"""
WITH {sql_wide()}, s AS (SELECT * FROM (VALUES {_rows}) AS s(period_type_id, variant, lo, hi))
SELECT period_type_id, manufacturer, variant, CAST(sum(value) AS DOUBLE) AS sales
FROM wf JOIN s ON pidx BETWEEN lo AND hi GROUP BY 1, 2, 3""")


def first_categories(spark, sf):
    """Default selection of the segment page."""
    from panelwright.operators import topk

    return topk.first_members(wide(spark, sf, ["category"]), "category", 4)


add("selector_first_four", first_categories,
    f"WITH {sql_wide()} SELECT DISTINCT category FROM wf ORDER BY 1 LIMIT 4")
