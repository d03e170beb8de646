"""Report tables, one DataFrame each.

``market`` is the wide fact under every filter of the report except the one on
company. Reports read it once: months outside the windows still matter only
where members without current sales are listed (``keep_empty``); otherwise the
scan is cut to the windows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, formats, ratios
from ..operators import feeds, topk
from ..operators.totals import with_totals
from ..sources.rows import inline_rows
from . import periods
from .periods import Block, Selection

COMPANY = "manufacturer"
# Slicers of the reports → column.
SLICERS = {"area": "business_area", "category": "category", "environment": "type_channel", "channel": "channel"}


def apply_filters(wide: DataFrame, metric: str | None = None, **chosen: list[str] | None) -> DataFrame:
    """One metric, and optional member lists (an empty list does not filter)."""
    unknown = set(chosen) - set(SLICERS)
    if unknown:
        raise ValueError(f"unknown slicers {sorted(unknown)}")
    conditions = [F.col(SLICERS[name]).isin(list(values)) for name, values in chosen.items() if values]
    if metric is not None:
        conditions.append(F.col("metric") == metric)
    return reduce(lambda df, c: df.filter(c), conditions, wide)


# ---- members -----------------------------------------------------------------

def _members(market: DataFrame, dims: list[str], sel: Selection, keep_empty: bool) -> DataFrame:
    """Current and previous sales per member with market totals; ``vc, vp, tc, tp`` as doubles.

    Rows without a member count in the totals but are no member.
    """
    rows = market if keep_empty else periods.within(market, sel.current, sel.previous)
    # the number of named rows tells members from the rest after the aggregation: a filter on the member itself
    # would move below it, and the totals could no longer share the aggregate
    named = F.expr("COUNT(CASE WHEN " + " AND ".join(f"{d} IS NOT NULL" for d in dims) + " THEN 1 END) AS named")
    sums = rows.groupBy(*dims).agg(
        F.expr(f"{sel.current.sum_of('value')} AS cur"), F.expr(f"{sel.previous.sum_of('value')} AS prev"), named
    )
    sums = with_totals(sums, {"all_cur": "cur", "all_prev": "prev", "all_named": "named"})
    out = sums.filter("named > 0")
    if not keep_empty:
        out = out.filter("cur > 0")
    return out.selectExpr(
        *dims,
        f"{ratios.zero('cur')} AS vc",
        f"{ratios.zero('prev')} AS vp",
        f"{ratios.zero('all_cur')} AS tc",
        f"{ratios.zero('all_prev')} AS tp",
    )


def _compared(df: DataFrame, has_prior: Column) -> DataFrame:
    """Comparison columns of a member frame."""
    shares = df.select("*", has_prior.alias("has_prior")).selectExpr(
        "*", f"{ratios.share('vc', 'tc')} AS share", f"{ratios.share('vp', 'tp')} AS share_prev"
    )
    return shares.selectExpr(
        "*",
        f"{ratios.bps('share', 'share_prev')} AS bps",
        "CASE WHEN has_prior THEN vc - vp ELSE 0D END AS growth",
        f"{ratios.pct_growth('vc', 'vp')} AS pct_growth",
    )


def company_table(
    market: DataFrame, sel: Selection, calendar: DataFrame, company: str = COMPANY, keep_empty: bool = True
) -> DataFrame:
    """Companies: sales, share, BPS, growth, relative growth; greatest sales first."""
    table = _compared(_members(market, [company], sel, keep_empty), sel.has_prior(calendar))
    table = table.selectExpr(company, "vc AS sales", "share", "bps", "growth", "pct_growth", "has_prior")
    return topk.ranked(table, "sales", company)


def breakdown_table(
    market: DataFrame, field: str, sel: Selection, calendar: DataFrame, keep_empty: bool = True
) -> DataFrame:
    """Any breakdown column with all comparisons; share and weight are of the whole market."""
    table = _compared(_members(market, [field], sel, keep_empty), sel.has_prior(calendar))
    table = table.selectExpr(
        field, "vc AS sales", "vp AS sales_prev", "growth", "pct_growth", "share", "share_prev", "bps",
        "share AS weight", "share_prev AS weight_prev", "has_prior",
    )
    return topk.ranked(table, "sales", field)


def with_total_row(report: DataFrame, dims: list[str], sums: list[str]) -> DataFrame:
    """The report plus one total row at its end (``is_total`` = 1, members NULL). The total is of the report's rows."""
    body = report.select(*dims, *sums).withColumn("is_total", F.lit(0))
    nothing = {d: F.lit(None).cast(report.schema[d].dataType) for d in dims}
    total = report.agg(*[F.sum(s).alias(s) for s in sums]).withColumns(nothing)
    both = body.unionByName(total.withColumn("is_total", F.lit(1)))
    # sorted here, as a union loses the order of its parts
    return both.orderBy("is_total", *[F.desc_nulls_last(s) for s in sums[:1]], *dims)


def with_texts(report: DataFrame, numbers: list[str], percents: list[str]) -> DataFrame:
    """The report plus ``<column>_text`` columns in European format."""
    texts = [f"{formats.or_dash(formats.es_num(c))} AS {c}_text" for c in numbers]
    texts += [f"{formats.or_dash(formats.es_pct(c))} AS {c}_text" for c in percents]
    return report.selectExpr("*", *texts)


# ---- cards ---------------------------------------------------------------------

def _company_sums(market: DataFrame, company: str, blocks: dict[str, Block], column: str = COMPANY) -> DataFrame:
    """One row: ``c_*`` of the company and ``m_*`` of the market per block."""
    rows = periods.within(market, *blocks.values()).withColumn("_mine", F.col(column) == company)
    sums = []
    for name, b in blocks.items():
        sums += [f"{b.sum_of('CASE WHEN _mine THEN value END')} AS c_{name}", f"{b.sum_of('value')} AS m_{name}"]
    return rows.selectExpr(*sums)


def _span(b: Block) -> str:
    first, last = ((p - 1) for p in (b.first, b.last))
    return f"{first % 12 + 1:02d}/{first // 12} - {last % 12 + 1:02d}/{last // 12}"


def kpi_card(market: DataFrame, company: str, anchor: int, calendar: DataFrame) -> DataFrame:
    """Last six months against the six before, and the month's share."""
    cur, prev = periods.block(anchor, "L6M"), periods.block(anchor, "L6M", "prev")
    one = _company_sums(market, company, {"cur": cur, "prev": prev, "month": periods.block(anchor, "MES")})
    diff = ratios.growth("c_cur", "c_prev")
    return one.select("*", periods.loaded(calendar, prev).alias("has_prior")).selectExpr(
        f"'{_span(prev)}' AS label_prev",
        f"'{_span(cur)}' AS label",
        f"{ratios.zero('c_prev')} AS sales_prev",
        f"{ratios.zero('c_cur')} AS sales",
        f"{diff} AS diff",
        f"{ratios.divide(diff, 'c_prev', '0')} AS pct_diff",
        f"{ratios.share(ratios.zero('c_month'), 'm_month')} AS share_month",
        "has_prior",
        f"{ratios.trend(diff)} AS trend",
    )


def kpi_card_selection(market: DataFrame, company: str, sel: Selection, calendar: DataFrame) -> DataFrame:
    """The same card for a selection of several months or years."""
    one = _company_sums(market, company, {"cur": sel.current, "prev": sel.previous})
    share = ratios.share(ratios.zero("c_cur"), "m_cur")
    share_prev = ratios.share(ratios.zero("c_prev"), "m_prev")
    diff = ratios.growth("c_cur", "c_prev")
    return one.select("*", sel.has_prior(calendar).alias("has_prior")).selectExpr(
        f"{ratios.zero('c_prev')} AS sales_prev",
        f"{ratios.zero('c_cur')} AS sales",
        f"{diff} AS diff",
        f"{ratios.divide(diff, 'c_prev', '0')} AS pct_diff",
        f"{share} AS share",
        f"{ratios.bps(share, share_prev)} AS bps",
        "has_prior",
        f"{ratios.trend(diff)} AS trend",
    )


def window_comparison(
    market: DataFrame, company: str, anchor: int, calendar: DataFrame, kinds: list[str] = periods.REPORT_TYPES
) -> DataFrame:
    """Per window kind: sales and share now and before, and BPS."""
    blocks = {}
    for k in kinds:
        blocks[f"{k}_cur"], blocks[f"{k}_prev"] = periods.block(anchor, k), periods.block(anchor, k, "prev")
    one = _company_sums(market, company, blocks)
    priors = [periods.loaded(calendar, blocks[f"{k}_prev"]).alias(f"p_{k}") for k in kinds]
    rows = []
    for position, k in enumerate(kinds):
        share = ratios.share(ratios.zero(f"c_{k}_cur"), f"m_{k}_cur")
        share_prev = ratios.share(ratios.zero(f"c_{k}_prev"), f"m_{k}_prev")
        rows.append(
            f"{position}, '{k}', {ratios.zero(f'c_{k}_cur')}, {ratios.zero(f'c_{k}_prev')}, {share}, {share_prev}, "
            f"{ratios.bps(share, share_prev, f'p_{k}')}, p_{k}"
        )
    names = "position, kind, sales, sales_prev, share, share_prev, bps, has_prior"
    return one.select("*", *priors).selectExpr(f"stack({len(kinds)}, {', '.join(rows)}) AS ({names})")


def bps_by_window(market: DataFrame, company: str, anchor: int, calendar: DataFrame) -> DataFrame:
    table = window_comparison(market, company, anchor, calendar)
    return table.selectExpr("kind", "bps", "has_prior", f"{ratios.trend('bps')} AS trend")


def company_kpis(market: DataFrame, company: str, sel: Selection) -> DataFrame:
    """One row with the page's blank rules: a missing market makes ratios NULL, a missing prior BPS 0.

    The market's growth is named as such; the company's own growth stands next to it.
    """
    one = _company_sums(market, company, {"cur": sel.current, "prev": sel.previous}).selectExpr(
        *[f"CAST({c} AS DOUBLE) AS {c}" for c in ("c_cur", "c_prev", "m_cur", "m_prev")]
    )
    row = one.selectExpr(
        f"{ratios.zero('c_cur')} AS comp_cur",
        f"{ratios.divide('c_cur', 'm_cur')} AS ms_cur",
        f"{ratios.divide('c_prev', 'm_prev')} AS ms_prev",
        f"{ratios.divide('m_cur', 'm_prev')} - 1 AS pct_var_market",
        f"{ratios.pct_growth('c_cur', 'c_prev')} AS pct_var_company",
        "CASE WHEN COALESCE(m_cur, 0) = 0 THEN NULL WHEN COALESCE(m_prev, 0) = 0 THEN 0D "
        "ELSE (c_cur / m_cur - COALESCE(c_prev, 0) / m_prev) * 10000 END AS bps",
    )
    return row.selectExpr(
        "*",
        f"{formats.es_scale('comp_cur')} AS sales_text",
        f"{formats.es_pct('ms_cur')} AS share_text",
        f"{formats.es_pct('pct_var_market')} AS pct_var_text",
        f"{formats.es_sig('bps')} AS bps_text",
    )


# ---- months --------------------------------------------------------------------

def monthly_yoy(market: DataFrame, company: str, year: int, calendar: DataFrame) -> DataFrame:
    """Twelve months of a year against the year before; missing months count 0."""
    cur, prev = Block(((year * 12 + 1, year * 12 + 12),)), Block(((year * 12 - 11, year * 12),))
    rows = periods.within(market, cur, prev).withColumns(
        {"month_number": F.expr("(pidx - 1) % 12 + 1"), "_mine": F.col(COMPANY) == company}
    )
    sums = []
    for name, b in {"cur": cur, "prev": prev}.items():
        sums += [f"{b.sum_of('CASE WHEN _mine THEN value END')} AS c_{name}", f"{b.sum_of('value')} AS m_{name}"]
    by_month = rows.groupBy("month_number").agg(*[F.expr(x) for x in sums])
    months = [(m, name, year * 12 - 12 + m) for m, name in enumerate(dates.ES_SHORT, 1)]
    spine = inline_rows(market.sparkSession, "month_number int, month string, _prev int", months)
    known = calendar.select(F.col("pidx").alias("_prev"), F.lit(True).alias("_known"))
    joined = spine.join(known, "_prev", "left").join(by_month, "month_number", "left")
    share = ratios.share(ratios.zero("c_cur"), "m_cur")
    share_prev = ratios.share(ratios.zero("c_prev"), "m_prev")
    return joined.selectExpr(
        "month_number",
        "month",
        f"{ratios.zero('c_cur')} AS sales",
        f"{ratios.zero('c_prev')} AS sales_prev",
        f"{share} AS share",
        f"{share_prev} AS share_prev",
        f"{ratios.bps(share, share_prev, '_known IS NOT NULL')} AS bps",
    ).orderBy("month_number")


# ---- rankings ------------------------------------------------------------------

def top_companies(
    market: DataFrame, sel: Selection, calendar: DataFrame, k: int = 7, company: str = COMPANY
) -> DataFrame:
    """The k greatest companies with their trend against the prior period."""
    table = _compared(_members(market, [company], sel, True), sel.has_prior(calendar))
    table = table.selectExpr(company, "vc AS sales", "growth", "has_prior", f"{ratios.trend('growth')} AS trend")
    return topk.top(table, k, "sales", company)


def top_companies_by_own_history(market: DataFrame, sel: Selection, k: int = 7, company: str = COMPANY) -> DataFrame:
    """The k greatest with current sales, trend against each company's own prior sales (none: no comparison)."""
    sums = periods.block_sums(
        periods.within(market, sel.current, sel.previous), [company], {"cur": sel.current, "prev": sel.previous}
    ).filter("cur > 0")
    growth = ratios.growth("cur", "prev")
    table = sums.selectExpr(
        company,
        "CAST(cur AS DOUBLE) AS sales",
        f"{growth} AS growth",
        f"{ratios.trend(growth, '(prev IS NOT NULL)')} AS trend",
    )
    return topk.top(table, k, "sales", company)


def ranked_market(market: DataFrame, sel: Selection, calendar: DataFrame, company: str = COMPANY) -> DataFrame:
    """The company table of members with current sales, with its text columns."""
    table = company_table(market, sel, calendar, company, keep_empty=False)
    change = formats.with_symbol(ratios.trend_symbol("growth"), formats.es_num("growth"))
    relative = formats.with_symbol(ratios.trend_symbol("pct_growth"), formats.es_pct("pct_growth"))
    return table.selectExpr(
        company, "sales", "share", "growth", "pct_growth",
        f"{formats.es_num('sales')} AS sales_text",
        f"{formats.es_pct('share')} AS share_text",
        f"{change} AS growth_text",
        f"{relative} AS pct_growth_text",
    )


# ---- trends --------------------------------------------------------------------

def _trend_months(market: DataFrame, field: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Monthly sales of the top-k members over all periods, and the monthly market, from one reading of the fact.

    Ranking, market and members use the same aggregate by member and month, whose exchange is reused as long as none of
    them pushes a filter below it. So rows without a month go beforehand, rows without a member sort last and are
    dropped after the limit, and members are picked by an outer join whose misses are dropped, which stays above.
    """
    monthly = market.filter("pidx IS NOT NULL").groupBy(field, "pidx").agg(F.sum("value").alias("sales"))
    totals = monthly.groupBy(field).agg(F.sum("sales").alias("_all"))
    best = totals.orderBy(F.expr(f"{field} IS NULL"), F.desc_nulls_last("_all"), field).limit(k)
    best = best.filter(f"{field} IS NOT NULL").select(F.col(field).alias("_best"), F.lit(True).alias("_picked"))
    whole = monthly.groupBy("pidx").agg(F.sum("sales").alias("market"))
    # at most k rows
    mine = monthly.join(F.broadcast(best), F.expr(f"{field} <=> _best"), "left").filter("COALESCE(_picked, false)")
    return mine.drop("_best", "_picked"), whole


def trend(market: DataFrame, field: str, k: int = 6, calendar: DataFrame | None = None) -> DataFrame:
    """Top-k members by month: sales and share of the month's market. Missing months are 0.

    The months are those of the ``calendar``, or without one those of the market.
    """
    mine, whole = _trend_months(market, field, k)
    months = whole if calendar is None else calendar
    bounds = months.select(F.struct(F.min("pidx").alias("lo"), F.max("pidx").alias("hi"))).scalar()
    # at most k members: the grid is k × months
    filled = mine.groupBy(field).agg(
        F.map_from_entries(F.collect_list(F.struct("pidx", "sales"))).alias("_by_month")
    )
    grid = filled.withColumn("_b", bounds).select(
        field, "_by_month", F.explode(F.sequence("_b.lo", "_b.hi")).alias("pidx")
    )
    sales = ratios.zero("_by_month[pidx]")
    return (
        grid.join(whole, "pidx", "left")
        .withColumn("period_id", dates.period_of_pidx("pidx"))
        .selectExpr("period_id", field, f"{sales} AS sales", f"{ratios.share(sales, 'market')} AS share")
        .orderBy("period_id", field)
    )


def calendar_periods(calendar: DataFrame) -> list[int]:
    """All periods from the calendar's first month to its last: the columns of a matrix, bounded by the calendar.

    Columns have to be known when a plan is made, so this reads the calendar's first and last month at once (a job over the
    calendar alone).
    """
    low, high = calendar.agg(F.min("pidx"), F.max("pidx")).first()
    return [] if low is None else [dates.from_pidx(p) for p in range(low, high + 1)]


def trend_matrix(market: DataFrame, field: str, calendar: DataFrame, k: int = 6) -> DataFrame:
    """Top-k members × all periods of the calendar."""
    mine, _ = _trend_months(market, field, k)
    wanted = mine.withColumn("period_id", dates.period_of_pidx("pidx"))
    matrix = wanted.groupBy(field).pivot("period_id", calendar_periods(calendar)).agg(F.sum("sales").cast("double"))
    return matrix.fillna(0.0)


# ---- segments ------------------------------------------------------------------

def segment_comparison(
    market: DataFrame, sel: Selection, calendar: DataFrame, chosen: list[str] | None = None, field: str = "category",
    k: int = 4,
) -> DataFrame:
    """Up to four segments side by side; by default the first four in the alphabet."""
    members = _members(market, [field], sel, True)
    if chosen is None:
        members = members.orderBy(field).limit(k)
    else:
        if len(chosen) > k:
            raise ValueError(f"at most {k} segments")
        members = members.filter(F.col(field).isin(chosen))
    table = _compared(members, sel.has_prior(calendar))
    return table.selectExpr(
        field, "vc AS cur", "vp AS prev", "growth", "pct_growth", "bps", f"{ratios.trend('(vc - vp)')} AS trend"
    ).orderBy(field)


def segment_table(market: DataFrame, sel: Selection, field: str = "category") -> DataFrame:
    """All segments with current sales, under the page's blank rules; unnamed rows stay out of the market."""
    named = periods.within(market, sel.current, sel.previous).filter(F.col(field).isNotNull())
    sums = periods.block_sums(named, [field], {"cur": sel.current, "prev": sel.previous})
    sums = with_totals(sums, {"tc": "cur", "tp": "prev"}).filter("cur > 0")
    table = sums.selectExpr(
        field,
        "CAST(cur AS DOUBLE) AS cur",
        "CAST(prev AS DOUBLE) AS prev",
        f"{ratios.growth('cur', 'prev')} AS growth",
        f"{ratios.divide('cur', 'prev')} - 1 AS pct_growth",
        f"CASE WHEN {ratios.zero('tp')} = 0 THEN 0D ELSE ({ratios.divide('cur', 'tc')} - "
        f"{ratios.share(ratios.zero('prev'), 'tp')}) * 10000 END AS bps",
    )
    return topk.ranked(table, "cur", field)


def segment_long(market: DataFrame, sel: Selection, kind: str, field: str = "category") -> DataFrame:
    """Current and previous sales as rows ``L4M`` / ``L4M-1``."""
    table = segment_table(market, sel, field)
    return feeds.long_form(table, [field], {"cur": kind, "prev": f"{kind}-1"}, "period", "sales")


# ---- dynamic report ------------------------------------------------------------

def dynamic_report(market: DataFrame, dims: list[str], sel: Selection) -> DataFrame:
    """Sales of the window by any number of columns, greatest first."""
    if not dims:
        raise ValueError("choose at least one field")
    rows = periods.within(market, sel.current).filter(sel.current.condition())
    sums = rows.groupBy(*dims).agg(F.sum("value").cast("double").alias("sales"))
    return topk.ranked(sums, "sales", *dims)


def dynamic_report_with_subtotals(market: DataFrame, dims: list[str], sel: Selection) -> DataFrame:
    """Sales of the window by the columns, with a subtotal row for each of the first columns and a total row: one
    aggregation for all, and one exchange. ``level`` is the number of columns that a row is of; the others are NULL there."""
    if not dims:
        raise ValueError("choose at least one field")
    rows = periods.within(market, sel.current).filter(sel.current.condition())
    # the grouping id has a bit for each column that a row sums over, the last column's lowest
    level = F.lit(len(dims)) - F.bit_count(F.grouping_id())
    sums = rows.rollup(*dims).agg(F.sum("value").cast("double").alias("sales"), level.cast("int").alias("level"))
    return sums.orderBy("level", F.desc_nulls_last("sales"), *dims)


# ---- loaded periods and context -------------------------------------------------

def loaded_periods(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Calendar periods with fact rows, newest first."""
    loaded = fact.select("period_id").distinct()
    return (
        calendar.join(loaded, "period_id", "left_semi")
        .select("period_id", "year", "month_number", "period_name", "pidx")
        .orderBy(F.desc("period_id"))
    )


def last_loaded(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Newest loaded period and how many are loaded."""
    return loaded_periods(fact, calendar).agg(
        F.max("period_name").alias("period"), F.count(F.lit(1)).alias("loaded_periods")
    )


def last_loaded_by_source(fact: DataFrame, categories: DataFrame, sell_in: int = 1) -> DataFrame:
    """Last period over all rows, of the sell-in source and of the others, with labels."""
    by_category = fact.groupBy("category_id").agg(F.max("period_id").alias("_last"))
    one = by_category.join(categories.select("category_id", "source_id"), "category_id", "left").agg(
        F.max("_last").alias("last_period"),
        F.max(F.when(F.col("source_id") == sell_in, F.col("_last"))).alias("sell_in"),
        F.max(F.when(F.col("source_id") != sell_in, F.col("_last"))).alias("sell_out"),
    )
    return one.withColumns({f"{c}_label": dates.period_label(c) for c in ("last_period", "sell_in", "sell_out")})


def yearly_average(series: DataFrame, value: str = "value") -> DataFrame:
    return series.groupBy("year").agg(F.avg(value).alias("average")).orderBy("year")
