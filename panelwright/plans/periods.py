"""Period windows.

A window is a set of months relative to an anchor month ``a`` (``pidx``). One
anchor: a literal interval, summed in one pass together with its companions.
All anchors at once: range frames over a month grid.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import dates
from ..operators.grid import dense_months
from ..sources.rows import inline_rows

# Months in a rolling window.
ROLLING = {"MES": 1, "L3M": 3, "L4M": 4, "L6M": 6, "TAM": 12}
TYPES = [*ROLLING, "YTD"]
VARIANTS = ["current", "prev", "ly"]
# The period-type selector.
PERIOD_SWITCH = {4: "MES", 3: "L4M", 2: "YTD", 1: "TAM"}
REPORT_TYPES = ["MES", "L4M", "YTD", "TAM"]


def period_types(spark: SparkSession) -> DataFrame:
    """The period-type selector as a table."""
    rows = [(kind, number) for number, kind in PERIOD_SWITCH.items()]
    return inline_rows(spark, "period_type string, period_type_id int", rows)


@dataclass(frozen=True)
class Block:
    """A set of months, as closed ``pidx`` intervals."""

    spans: tuple[tuple[int, int], ...]

    @property
    def first(self) -> int:
        return min(lo for lo, _ in self.spans)

    @property
    def last(self) -> int:
        return max(hi for _, hi in self.spans)

    def condition(self, pidx: str = "pidx") -> str:
        """SQL text: the month is in the block."""
        return "(" + " OR ".join(f"{pidx} BETWEEN {lo} AND {hi}" for lo, hi in self.spans) + ")"

    def sum_of(self, value: str, pidx: str = "pidx") -> str:
        """SQL text: sum of a value over the block."""
        return f"SUM(CASE WHEN {self.condition(pidx)} THEN {value} END)"

    def shift(self, months: int) -> Block:
        return Block(tuple((lo + months, hi + months) for lo, hi in self.spans))


def block(anchor: int, kind: str, variant: str = "current") -> Block:
    """Window of an anchor period (YYYYMM)."""
    if kind not in TYPES or variant not in VARIANTS:
        raise ValueError(f"unknown window {kind}/{variant}")
    a = dates.to_pidx(anchor)
    if kind == "YTD":
        january = (a - 1) // 12 * 12 + 1
        current = Block(((january, a),))
        return current if variant == "current" else current.shift(-12)
    n = ROLLING[kind]
    current = Block(((a - n + 1, a),))
    return {"current": current, "prev": current.shift(-n), "ly": current.shift(-12)}[variant]


@dataclass(frozen=True)
class Selection:
    """Resolved period selection: what to sum and what to compare it with."""

    current: Block
    previous: Block
    multi: bool

    def has_prior(self, calendar: DataFrame) -> Column:
        return loaded(calendar, self.previous)


def resolve(years: list[int], months: list[int], kind: str = "MES") -> Selection:
    """One year and month: a window and its previous block. Several: the chosen
    periods against the same months as many years back as years were chosen."""
    if not years or not months:
        raise ValueError("choose at least one year and one month")
    if len(years) == 1 and len(months) == 1:
        anchor = years[0] * 100 + months[0]
        return Selection(block(anchor, kind), block(anchor, kind, "prev"), False)
    chosen = sorted({y * 12 + m for y in years for m in months})
    spans: list[list[int]] = []
    for p in chosen:  # neighbours become one interval
        if spans and spans[-1][1] == p - 1:
            spans[-1][1] = p
        else:
            spans.append([p, p])
    current = Block(tuple((lo, hi) for lo, hi in spans))
    return Selection(current, current.shift(-12 * len(set(years))), True)


def loaded(calendar: DataFrame, months: Block) -> Column:
    """Whether the calendar has any month of the block (partial blocks count)."""
    return calendar.filter(months.condition()).selectExpr("COUNT(1) > 0").scalar()


def all_loaded(calendar: DataFrame, blocks: dict[str, Block]) -> Column:
    """``loaded`` for several blocks as one struct, from one reading of the calendar."""
    flags = [F.coalesce(F.bool_or(F.expr(b.condition())), F.lit(False)).alias(n) for n, b in blocks.items()]
    return calendar.agg(F.struct(*flags).alias("flags")).scalar()


def anchor_in(calendar: DataFrame, period: int) -> int:
    """The period, or the greatest calendar period before it."""
    found = calendar.filter(F.col("period_id") <= period).agg(F.max("period_id")).first()[0]
    if found is None:
        raise ValueError(f"no period up to {period}")
    return found


def last_period(fact: DataFrame) -> int:
    """Default anchor: the last period with fact rows."""
    return fact.agg(F.max("period_id")).first()[0]


def within(df: DataFrame, *blocks: Block) -> DataFrame:
    """Rows of the periods the blocks span. On a table partitioned by period only those are read."""
    low, high = min(b.first for b in blocks), max(b.last for b in blocks)
    key = "period_id" if "period_id" in df.columns else "pidx"
    bounds = (dates.from_pidx(low), dates.from_pidx(high)) if key == "period_id" else (low, high)
    return df.filter(f"{key} BETWEEN {bounds[0]} AND {bounds[1]}")


# ---- one anchor ------------------------------------------------------------

def block_sums(df: DataFrame, dims: list[str], blocks: dict[str, Block], value: str = "value") -> DataFrame:
    """Sum per member and block in one pass and one shuffle. Members without sales in a block get NULL there."""
    sums = [F.expr(f"{b.sum_of(value)} AS {name}") for name, b in blocks.items()]
    return df.groupBy(*dims).agg(*sums)


def window_table(calendar: DataFrame, anchor: int, kinds: list[str] = TYPES, variants: list[str] = VARIANTS) -> DataFrame:
    """(kind, variant, pidx) rows of the calendar; a window wholly before the data has none."""
    spans = []
    for kind in kinds:
        for variant in variants:
            b = block(anchor, kind, variant)
            spans.append((kind, variant, b.first, b.last))
    wanted = inline_rows(calendar.sparkSession, "kind string, variant string, first int, last int", spans)
    months = wanted.select("kind", "variant", F.explode(F.sequence("first", "last")).alias("pidx"))
    return months.join(calendar.select("pidx"), "pidx", "left_semi")


def sales_by_window(df: DataFrame, dims: list[str], windows: DataFrame, value: str = "value") -> DataFrame:
    """Long form: one row per member, kind and variant. Months are summed before the windows multiply them."""
    monthly = df.groupBy(*dims, "pidx").agg(F.sum(value).alias("_month"))
    # windows: kinds × variants × at most 12 months
    return (
        monthly.join(F.broadcast(windows), "pidx").groupBy(*dims, "kind", "variant").agg(F.sum("_month").alias("sales"))
    )


def window_labels(windows: DataFrame) -> DataFrame:
    """``mm/yyyy - mm/yyyy`` per window."""
    ends = windows.groupBy("kind", "variant").agg(F.min("pidx").alias("_lo"), F.max("pidx").alias("_hi"))
    label = dates.span_label(dates.period_of_pidx("_lo"), dates.period_of_pidx("_hi"))
    return ends.select("kind", "variant", label.alias("label"))


# ---- every anchor ------------------------------------------------------------

def frame_sum(dims: list[str], kind: str, variant: str, value: str = "sales") -> Column:
    """The window as a range frame; needs ``pidx`` and, for YTD, ``year``."""
    if kind == "YTD":
        current = F.sum(value).over(
            Window.partitionBy(*dims, "year").orderBy("pidx").rangeBetween(Window.unboundedPreceding, 0)
        )
        if variant == "current":
            return current
        raise ValueError("the prior YTD is taken from the current one, twelve months earlier")
    n = ROLLING[kind]
    offset = {"current": 0, "prev": -n, "ly": -12}[variant]
    return F.sum(value).over(
        Window.partitionBy(*dims).orderBy("pidx").rangeBetween(offset - n + 1, offset)
    )


def all_anchors(
    df: DataFrame, dims: list[str], windows: list[tuple[str, str]], value: str = "value", calendar: DataFrame | None = None
) -> DataFrame:
    """Every window for every month: ``dims, pidx, <kind>_<variant>…`` (0 where nothing was sold).

    Fact rows are summed to members × months first. The frames then run over
    one member's months at a time: their size follows the calendar, not the data.
    With a ``calendar``, whose months the grid then has, the fact is read once.
    """
    monthly = df.groupBy(*dims, "pidx").agg(F.sum(value).alias("sales"))
    grid = dense_months(monthly, dims, ["sales"], calendar=calendar).withColumn("year", dates.year_of_pidx("pidx"))
    # a decimal's zero, so that a sum keeps the type of the measure
    none = F.col("sales") * 0
    columns = {}
    for kind, variant in windows:
        if kind == "YTD" and variant != "current":
            continue
        columns[f"{kind}_{variant}"] = F.coalesce(frame_sum(dims, kind, variant), none)
    prior = [v for k, v in windows if k == "YTD" and v != "current"]
    if prior:
        columns.setdefault("_ytd", frame_sum(dims, "YTD", "current"))
    out = grid.withColumns(columns)
    if prior:
        before = F.lag("_ytd", 12).over(Window.partitionBy(*dims).orderBy("pidx"))
        out = out.withColumns({f"YTD_{v}": F.coalesce(before, none) for v in prior})
    return out.select(*dims, "pidx", *[f"{k}_{v}" for k, v in windows])


def compare_back(monthly: DataFrame, dims: list[str], months: int, out: str, value: str = "sales") -> DataFrame:
    """Value of the same member some months earlier (1 = previous period, 12 = previous year), on a month grid."""
    return monthly.withColumn(out, F.lag(value, months).over(Window.partitionBy(*dims).orderBy("pidx")))


def in_calendar(fact: DataFrame, calendar: DataFrame, condition: Column | str, period: str = "period_id") -> DataFrame:
    """The fact's rows whose month meets a condition over the calendar's columns (a quarter, the current year, ...).

    The months are looked up at run time: on a fact in partitions by period, the join prunes the partitions that the
    calendar leaves out before any of their files is opened.
    """
    return fact.join(calendar.filter(condition).select(period), period, "left_semi")
