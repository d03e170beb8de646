"""Periods, measures and reports on a small market, checked against plain Python."""

import itertools

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from panelwright.plans import calendars, measures, periods, reports, star
from panelwright.schemas import star_schema
from panelwright.sources.rows import inline_rows

FIRST, LAST = 202201, 202412


def months_of(first, last):
    return [y * 100 + m for y in range(first // 100, last // 100 + 1) for m in range(1, 13) if first <= y * 100 + m <= last]


PERIODS = months_of(FIRST, LAST)


def value(company, category, period):
    if company == "C" and period < 202406:
        return None  # a newcomer
    if company == "B" and period % 100 == 12:
        return None  # gaps
    return float((len(company) + ord(company[0]) % 7 + ord(category[0]) % 5) * (period % 100 + period // 100 % 10))


DATA = [
    (p, periods.dates.to_pidx(p), c, k, v)
    for p, c, k in itertools.product(PERIODS, ["A", "B", "C"], ["X", "Y"])
    if (v := value(c, k, p)) is not None
] + [(p, periods.dates.to_pidx(p), None, "X", 7.0) for p in PERIODS]


@pytest.fixture(scope="module")
def market(spark):
    return inline_rows(
        spark, "period_id int, pidx int, manufacturer string, category string, value decimal(18,4)", DATA).cache()


@pytest.fixture(scope="module")
def calendar(spark):
    limits = spark.sql("SELECT DATE '2022-01-15' AS min_date, DATE '2024-12-01' AS max_date")
    return calendars.month_calendar(limits, F.lit("2024-12-20").cast("date")).cache()


# First and last month of each window, as "anchor kind current prev ly".
WINDOWS = """
202201 MES 202201..202201 - -
202201 L3M 202201..202201 - -
202201 L4M 202201..202201 - -
202201 L6M 202201..202201 - -
202201 YTD 202201..202201 - -
202201 TAM 202201..202201 - -
202203 MES 202203..202203 202202..202202 -
202203 L3M 202201..202203 - -
202203 L4M 202201..202203 - -
202203 L6M 202201..202203 - -
202203 YTD 202201..202203 - -
202203 TAM 202201..202203 - -
202301 MES 202301..202301 202212..202212 202201..202201
202301 L3M 202211..202301 202208..202210 202201..202201
202301 L4M 202210..202301 202206..202209 202201..202201
202301 L6M 202208..202301 202202..202207 202201..202201
202301 YTD 202301..202301 202201..202201 202201..202201
202301 TAM 202202..202301 202201..202201 202201..202201
202305 MES 202305..202305 202304..202304 202205..202205
202305 L3M 202303..202305 202212..202302 202203..202205
202305 L4M 202302..202305 202210..202301 202202..202205
202305 L6M 202212..202305 202206..202211 202201..202205
202305 YTD 202301..202305 202201..202205 202201..202205
202305 TAM 202206..202305 202201..202205 202201..202205
202306 MES 202306..202306 202305..202305 202206..202206
202306 L3M 202304..202306 202301..202303 202204..202206
202306 L4M 202303..202306 202211..202302 202203..202206
202306 L6M 202301..202306 202207..202212 202201..202206
202306 YTD 202301..202306 202201..202206 202201..202206
202306 TAM 202207..202306 202201..202206 202201..202206
202406 MES 202406..202406 202405..202405 202306..202306
202406 L3M 202404..202406 202401..202403 202304..202306
202406 L4M 202403..202406 202311..202402 202303..202306
202406 L6M 202401..202406 202307..202312 202301..202306
202406 YTD 202401..202406 202301..202306 202301..202306
202406 TAM 202307..202406 202207..202306 202207..202306
202407 MES 202407..202407 202406..202406 202307..202307
202407 L3M 202405..202407 202402..202404 202305..202307
202407 L4M 202404..202407 202312..202403 202304..202307
202407 L6M 202402..202407 202308..202401 202302..202307
202407 YTD 202401..202407 202301..202307 202301..202307
202407 TAM 202308..202407 202208..202307 202208..202307
202412 MES 202412..202412 202411..202411 202312..202312
202412 L3M 202410..202412 202407..202409 202310..202312
202412 L4M 202409..202412 202405..202408 202309..202312
202412 L6M 202407..202412 202401..202406 202307..202312
202412 YTD 202401..202412 202301..202312 202301..202312
202412 TAM 202401..202412 202301..202312 202301..202312
"""


def written_out(text):
    found = {}
    for anchor, kind, *spans in map(str.split, text.strip().splitlines()):
        for variant, span in zip(["current", "prev", "ly"], spans):
            ends = [] if span == "-" else [int(p) for p in span.split("..")]
            found[int(anchor), kind, variant] = months_of(*ends) if ends else []
    return found


EXPECTED = written_out(WINDOWS)


def window(anchor, kind, variant):
    return EXPECTED[anchor, kind, variant]


def total(ps, company="*", category="*"):
    return sum(v for p, _, c, k, v in DATA
               if p in ps and (company == "*" or c == company) and (category == "*" or k == category))


@pytest.mark.parametrize("anchor", [202201, 202203, 202301, 202306, 202412])
def test_windows(calendar, anchor):
    table = periods.window_table(calendar.select("pidx"), anchor)
    got = {}
    for kind, variant, pidx in rows(table.select("kind", "variant", "pidx"), "pidx"):
        got.setdefault((kind, variant), []).append(periods.dates.from_pidx(pidx))
    for kind in periods.TYPES:
        for variant in periods.VARIANTS:
            assert got.get((kind, variant), []) == window(anchor, kind, variant), (kind, variant)


def test_window_labels(calendar):
    labels = periods.window_labels(periods.window_table(calendar.select("pidx"), 202403))
    got = {(k, v): t for k, v, t in rows(labels)}
    assert got[("L4M", "current")] == "12/2023 - 03/2024" and got[("MES", "ly")] == "03/2023 - 03/2023"


@pytest.mark.parametrize(
    "years,chosen,cur,prev,multi",
    [([2023], [5, 6], [202305, 202306], [202205, 202206], True),
     ([2022, 2023], [1, 2], [202201, 202202, 202301, 202302], [202001, 202002, 202101, 202102], True),
     ([2024], [12], [202412], [202411], False)],
)
def test_resolve(years, chosen, cur, prev, multi):
    sel = periods.resolve(years, chosen)
    inside = lambda b: [p for p in months_of(201901, 202512)
                        if any(lo <= periods.dates.to_pidx(p) <= hi for lo, hi in b.spans)]
    assert (inside(sel.current), inside(sel.previous), sel.multi) == (cur, prev, multi)


def test_resolve_refuses_nothing_and_unknown_windows():
    with pytest.raises(ValueError):
        periods.resolve([], [1])
    with pytest.raises(ValueError):
        periods.block(202412, "L5M")


def test_anchor(calendar, market):
    assert periods.anchor_in(calendar, 203001) == 202412
    assert periods.anchor_in(calendar, 202302) == 202302
    assert periods.last_period(market) == 202412
    with pytest.raises(ValueError):
        periods.anchor_in(calendar, 202101)


@pytest.mark.parametrize("kind,anchor", [("L4M", 202412), ("MES", 202406), ("L4M", 202201), ("TAM", 202306), ("YTD", 202407)])
def test_company_table(market, calendar, kind, anchor):
    sel = periods.resolve([anchor // 100], [anchor % 100], kind)
    got = reports.company_table(market, sel, calendar).collect()
    cur, prev = window(anchor, kind, "current"), window(anchor, kind, "prev")
    assert [r["sales"] for r in got] == sorted((r["sales"] for r in got), reverse=True)
    assert {r["manufacturer"] for r in got} == {"A", "B", "C"}
    for r in got:
        v, vp, t, tp = total(cur, r["manufacturer"]), total(prev, r["manufacturer"]), total(cur), total(prev)
        share, before = v / t if t else 0, vp / tp if tp else 0
        assert r["has_prior"] == bool(prev)
        assert r["sales"] == v and r["share"] == pytest.approx(share)
        assert r["bps"] == pytest.approx((share - before) * 10000 if prev else 0)
        assert r["growth"] == pytest.approx(v - vp if prev else 0)
        assert r["pct_growth"] == pytest.approx(v / vp - 1 if vp else 0)


def test_shares_and_bps_add_up(market, calendar):
    named = market.filter("manufacturer IS NOT NULL")
    got = reports.company_table(named, periods.resolve([2024], [9], "L4M"), calendar).agg(F.sum("share"), F.sum("bps"))
    share, bps = got.first()
    assert share == pytest.approx(1) and bps == pytest.approx(0, abs=1e-6)


def test_reports_read_the_market_once(spark, sf):
    import workload

    for name in ["company_table", "breakdown_category", "top6_trend", "segment_compare"]:
        df = workload.QUERIES[name](spark, sf)
        df.collect()
        assert "ReusedExchange" in plan(df), name


def test_all_anchors_equal_one_anchor(market):
    windows = [(k, v) for k in periods.TYPES for v in periods.VARIANTS]
    grid = periods.all_anchors(market, ["manufacturer", "category"], windows)
    cells = {(r["manufacturer"], r["category"], periods.dates.from_pidx(r["pidx"])): r for r in grid.collect()}
    assert len(cells) == 7 * len(PERIODS)
    anchors = {anchor for anchor, _, _ in EXPECTED}
    for (company, category, anchor), r in cells.items():
        for kind, variant in windows if anchor in anchors else []:
            assert float(r[f"{kind}_{variant}"]) == total(window(anchor, kind, variant), company, category)


def test_compare_back(spark):
    grid = inline_rows(spark, "m string, pidx int, sales int", [("a", i, i * 10) for i in range(1, 15)])
    out = periods.compare_back(periods.compare_back(grid, ["m"], 1, "previous"), ["m"], 12, "year_ago")
    assert rows(out.select("pidx", "previous", "year_ago"), "pidx")[12] == (13, 120, 10)


# ---- measures ---------------------------------------------------------------------

def test_registry_is_complete():
    assert len(measures.measure_names()) == len(set(measures.measure_names())) == 85
    kpis = [n for group in measures.PARAMETER_KPIS.values() for n in group]
    assert len(kpis) == 42 and set(kpis) <= set(measures.MEASURES)
    for targets in measures.SWITCHES.values():
        assert set(targets) == set(periods.REPORT_TYPES) and set(targets.values()) <= set(measures.MEASURES)
    for choices in measures.PARAMETERS.values():
        assert set(choices.values()) <= set(measures.MEASURES) | set(measures.SWITCHES)
    with pytest.raises(ValueError):
        measures.field_column("Peso")
    with pytest.raises(ValueError):
        measures.switched("Ventas Períodos Switch", "L3M")
    assert measures.switched("Ventas Períodos Switch", 1) == "Ventas TAM"
    assert measures.field_column("Mes") == "month_long"


def table(market, calendar, names, anchor, **options):
    out = measures.measure_table(market, ["category", "manufacturer"], names, anchor, calendar, **options)
    return {(r["category"], r["manufacturer"]): r for r in out.collect()}


def test_measures(market, calendar):
    names = ["Ventas", "Market Share", "Ventas L4M", "Ventas Mes", "Ventas Mes LY", "Market Share L4M",
             "Market Share Mes", "BPS L4M", "%Peso L4M", "Ventas Globales L4M Switch", "%Crecimiento Mes LY",
             "Crecimiento TAM", "BPS Período Switch"]
    got = table(market, calendar, names, 202412, field="Compañía", period_type="TAM")
    cur, prev, tam, before = (window(202412, k, v) for k, v in
                              [("L4M", "current"), ("L4M", "prev"), ("TAM", "current"), ("TAM", "prev")])
    row = got[("X", "A")]
    share = total(cur, "A", "X") / total(cur, "*", "X")
    assert row["Ventas"] == total(PERIODS, "A", "X")
    assert row["Market Share"] == pytest.approx(total(PERIODS, "A", "X") / total(PERIODS, "*", "X"))
    assert row["Market Share L4M"] == row["%Peso L4M"] == pytest.approx(share)
    assert row["Ventas Globales L4M Switch"] == total(cur, "*", "X")
    assert row["BPS L4M"] == pytest.approx((share - total(prev, "A", "X") / total(prev, "*", "X")) * 10000)
    assert row["Crecimiento TAM"] == total(tam, "A", "X") - total(before, "A", "X")
    assert row["BPS Período Switch"] == pytest.approx(
        (total(tam, "A", "X") / total(tam, "*", "X") - total(before, "A", "X") / total(before, "*", "X")) * 10000)
    gap = got[("X", "B")]  # nothing sold in December
    assert gap["Ventas Mes"] is None and gap["Market Share Mes"] is None and gap["Ventas L4M"] > 0
    assert gap["%Crecimiento Mes LY"] == 0


def test_measures_without_prior_and_without_a_total(market, calendar):
    got = table(market, calendar, ["BPS L4M", "Ventas L4M-1", "%Peso L4M", "Ventas Globales L4M Switch"], 202203,
                field="Métrica")
    for row in got.values():
        assert row["BPS L4M"] == 0 and row["Ventas L4M-1"] == 0
        assert row["Ventas Globales L4M Switch"] is None and row["%Peso L4M"] == 0


def test_company_slicer_leaves_shares_alone(market, calendar):
    out = measures.measure_table(market, ["manufacturer"], ["Market Share Mes"], 202411, calendar)
    only = measures.select_company(out, ["A"]).first()
    assert only["Market Share Mes"] == pytest.approx(total([202411], "A") / total([202411]))


# ---- other reports -----------------------------------------------------------------

def test_slicers(market):
    assert reports.apply_filters(market, category=[]).count() == market.count()
    assert reports.apply_filters(market, category=["X"]).count() == market.filter("category = 'X'").count()
    with pytest.raises(ValueError):
        reports.apply_filters(market, brand=["x"])


def test_breakdown_total_row(market, calendar):
    sel = periods.resolve([2024], [3], "L4M")
    out = reports.with_total_row(reports.breakdown_table(market, "manufacturer", sel, calendar), ["manufacturer"], ["sales"])
    got = {r["manufacturer"]: r["sales"] for r in out.collect() if not r["is_total"]}
    assert out.filter("is_total = 1").first()["sales"] == sum(got.values())
    assert got["C"] == 0 and None not in got
    current = reports.breakdown_table(market, "manufacturer", sel, calendar, keep_empty=False)
    assert {r["manufacturer"] for r in current.collect()} == {"A", "B"}


def test_cards(market, calendar):
    card = reports.kpi_card(market, "A", 202412, calendar).first()
    assert (card["label"], card["label_prev"]) == ("07/2024 - 12/2024", "01/2024 - 06/2024")
    assert card["diff"] == total(window(202412, "L6M", "current"), "A") - total(window(202412, "L6M", "prev"), "A")
    first = reports.kpi_card(market, "A", 202203, calendar).first()
    assert first["trend"] == "none" and not first["has_prior"] and first["sales_prev"] == 0
    absent = reports.kpi_card_selection(market, "C", periods.resolve([2023], [1, 2]), calendar).first()
    assert absent["sales"] == 0 and absent["bps"] == 0 and absent["has_prior"] and absent["trend"] == "flat"


def test_window_comparison(market, calendar):
    got = {r["kind"]: r for r in reports.window_comparison(market, "B", 202305, calendar).collect()}
    assert list(got) == ["MES", "L4M", "YTD", "TAM"]
    for kind, r in got.items():
        assert r["sales"] == total(window(202305, kind, "current"), "B")
        assert r["sales_prev"] == total(window(202305, kind, "prev"), "B")


def test_monthly_yoy(market, calendar):
    got = reports.monthly_yoy(market, "B", 2022, calendar).collect()
    assert [r["month"] for r in got][:2] == ["Ene", "Feb"] and len(got) == 12
    assert all(r["bps"] == 0 and r["sales_prev"] == 0 for r in got)
    assert got[11]["sales"] == 0
    later = reports.monthly_yoy(market, "B", 2023, calendar).collect()
    assert later[0]["sales_prev"] == total([202201], "B") and later[0]["bps"] != 0


def test_top_and_trend(market, calendar):
    sel = periods.resolve([2024], [12], "MES")
    best = reports.top_companies(market, sel, calendar, k=2).collect()
    assert len(best) == 2 and best[0]["sales"] >= best[1]["sales"]
    own = {r["manufacturer"]: r["trend"] for r in reports.top_companies_by_own_history(
        market.filter("manufacturer IS NOT NULL"), periods.resolve([2024], [6], "MES")).collect()}
    assert own["C"] == "none"
    lines = reports.trend(market, "manufacturer", k=2).collect()
    assert len(lines) == 2 * len(PERIODS) and all(r["manufacturer"] is not None for r in lines)
    for r in lines:
        assert r["sales"] == total([r["period_id"]], r["manufacturer"])
        assert r["share"] == pytest.approx(r["sales"] / total([r["period_id"]]))
    matrix = reports.trend_matrix(market, "manufacturer", calendar.filter("period_id <= 202203"), k=2)
    assert matrix.columns == ["manufacturer", *map(str, PERIODS[:3])]


def test_segments(market, calendar):
    sel = periods.resolve([2024], [12], "L3M")
    got = reports.segment_comparison(market, sel, calendar, field="manufacturer", k=2).collect()
    assert [r["manufacturer"] for r in got] == ["A", "B"]
    with pytest.raises(ValueError):
        reports.segment_comparison(market, sel, calendar, list("abcde"))
    long = reports.segment_long(market, sel, "L3M").collect()
    assert {r["period"] for r in long} == {"L3M", "L3M-1"} and len(long) == 4
    with pytest.raises(ValueError):
        reports.dynamic_report(market, [], sel)


def test_periods_partitioned_by_period_are_pruned(spark, tmp_path, market, calendar):
    path = str(tmp_path / "fact")
    market.write.partitionBy("period_id").parquet(path)
    fact = spark.read.parquet(path)
    sel = periods.resolve([2024], [12], "L4M")
    text = plan(reports.company_table(fact, sel, calendar, keep_empty=False))
    assert "PartitionFilters: [isnotnull(period_id" in text and "(period_id#" in text


# ---- star ---------------------------------------------------------------------------

def test_tall_fact_derives_once_and_keeps_unknown_products(spark):
    base = inline_rows(
        spark, star_schema("FACT_TABLE").replace("value double", "value decimal(18,4)"),
        [(202401, 1, 1, 1, 1, 1, "p", 10), (202401, 1, 1, 1, 2, 1, "p", 99), (202401, 7, 1, 1, 1, 1, "p", 5)])
    products = inline_rows(spark, "product_id int, format string, conversor_lkg double", [(1, "200G", 1.804), (2, "1kg", 1.0)])
    got = [(p, k, float(v)) for p, k, v in rows(
        star.tall_fact(base, products).select("product_id", "kpi_flag_id", "value"), "product_id", "kpi_flag_id")]
    assert got == [(1, 1, 10.0), (1, 2, 99.0), (1, 3, 50.0), (1, 4, 18.04), (7, 1, 5.0)]


def test_wide_fact_joins_only_what_it_needs(spark):
    fact = inline_rows(spark, star_schema("FACT_TABLE"), [(202401, 1, 1, 1, 1, 1, "p", 1.0)])
    dims = {"DIM_PROD": inline_rows(spark, "product_id int, manufacturer string", [(1, "m")])}
    wide = star.wide_fact(fact, dims, ["manufacturer", "period_id", "pidx", "value"])
    assert rows(wide) == [("m", 202401, 2024 * 12 + 1, 1.0)]
    with pytest.raises(ValueError):
        star.wide_fact(fact, dims, ["colour"])


def test_daily_calendar(spark):
    days = calendars.daily_calendar(spark)
    assert days.count() == 29585 and len(days.columns) == 27


def test_context(spark, calendar):
    series = inline_rows(spark, "period_id int, value double", [(202201, 6.5), (202301, 7.5), (209901, 1.0)])
    fact = star.context_fact(series, calendar)
    assert rows(fact, "period_id") == [(2022, "JAN", 6.5, 202201), (2023, "JAN", 7.5, 202301)]
    labelled = star.context_series(fact, calendar)
    assert rows(labelled.select("period_name", "month_long"), "period_name")[0] == ("2022-01", "January")
    assert rows(reports.yearly_average(labelled)) == [(2022, 6.5), (2023, 7.5)]


@pytest.fixture(scope="module")
def undated(market):
    """The market and rows whose period could not be read."""
    return market.unionByName(market.limit(3).withColumns({"pidx": F.lit(None).cast("int"), "period_id": F.lit(None).cast("int")}))


def test_rows_without_a_period_are_in_no_window(market, undated, calendar):
    frames = [("L4M", "current"), ("YTD", "ly")]
    for bounds in (None, calendar):
        want = periods.all_anchors(market, ["manufacturer"], frames, calendar=bounds)
        assert rows(periods.all_anchors(undated, ["manufacturer"], frames, calendar=bounds), "manufacturer", "pidx") == rows(want, "manufacturer", "pidx")
        assert reports.trend(undated, "manufacturer", 2, bounds).collect() == reports.trend(market, "manufacturer", 2, bounds).collect()
    assert rows(reports.trend_matrix(undated, "manufacturer", calendar, 2), "manufacturer") == rows(
        reports.trend_matrix(market, "manufacturer", calendar, 2), "manufacturer")


def scans(spark):
    """Parquet scans of the last query, as it ran."""
    spark._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    store = spark._jsparkSession.sharedState().statusStore()
    last = store.executionsList().last()
    nodes = store.planGraph(last.executionId()).allNodes()
    return sum(nodes.apply(i).name().startswith("Scan parquet") for i in range(nodes.size()))


def test_facts_are_read_once(spark, market, calendar, tmp_path):
    market.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    for df in (reports.trend(fact, "manufacturer", 2, calendar), reports.trend_matrix(fact, "manufacturer", calendar, 2),
               periods.all_anchors(fact, ["manufacturer"], [("L4M", "current")], calendar=calendar),
               measures.measure_table(fact, ["manufacturer"], ["Market Share L4M", "BPS L4M", "%Peso L4M"], 202412, calendar, field="Compañía")):
        df.collect()
        assert scans(spark) == 1


def test_trend_matrix_has_every_calendar_period(market, calendar):
    assert reports.trend_matrix(market, "manufacturer", calendar, 2).columns == ["manufacturer", *map(str, PERIODS)]
