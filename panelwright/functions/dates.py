"""Periods, month index and calendar parts.

A period is an int ``YYYYMM``; ``pidx = year * 12 + month`` numbers the months
without gaps, so every period window is one closed interval of ``pidx``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .keys import col

# Portuguese month labels, January first.
PT_SHORT = ["JAN", "FEV", "MAR", "ABR", "MAI", "JUN", "JUL", "AGO", "SET", "OUT", "NOV", "DEZ"]
PT_LONG = [
    "JANEIRO", "FEVEREIRO", "MARÇO", "ABRIL", "MAIO", "JUNHO",
    "JULHO", "AGOSTO", "SETEMBRO", "OUTUBRO", "NOVEMBRO", "DEZEMBRO",
]
# Spanish short month labels of the reports.
ES_SHORT = ["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"]


def month_name(month: Column | str, names: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), col(month).cast("int"))


# ---- parsing -------------------------------------------------------------

def date_int(d: Column | str) -> Column:
    """Date → int YYYYMMDD."""
    d = col(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_int(d: Column | str) -> Column:
    """Date → int YYYYMM."""
    d = col(d)
    return F.year(d) * 100 + F.month(d)


def date_text_to_int(c: Column | str, fmt: str) -> Column:
    """Date text in a known format → int YYYYMMDD; NULL when it is no such date."""
    return date_int(F.try_to_date(col(c), fmt))


def month_label_to_period(c: Column | str) -> Column:
    """``jan24`` / ``Fev 23`` → text YYYYMM.

    An unknown month gives ``00`` so that it shows up; no two trailing digits
    gives NULL.
    """
    text = F.lower(col(c))
    year = F.nullif(F.regexp_extract(text, r"(\d{2})\s*$", 1), F.lit(""))
    month = F.coalesce(
        F.array_position(F.array(*[F.lit(m.lower()) for m in PT_SHORT]), F.substring(text, 1, 3)),
        F.lit(0),
    )
    return F.concat(F.lit("20"), year, F.lpad(month.cast("string"), 2, "0"))


def month_of_code(c: Column | str) -> Column:
    """6- or 8-digit period → text YYYYMM."""
    return F.substring(col(c).cast("string"), 1, 6)


def code_to_date(c: Column | str) -> Column:
    """6- or 8-digit period → date (first of the month for 6); else NULL."""
    text = col(c).cast("string")
    full = F.when(F.length(text) == 6, F.concat(text, F.lit("01"))).when(F.length(text) == 8, text)
    return F.try_to_date(full, "yyyyMMdd")


# ---- month index ---------------------------------------------------------

def pidx_of(year: Column | str, month: Column | str) -> Column:
    return (col(year) * 12 + col(month)).cast("int")


def pidx_of_date(d: Column | str) -> Column:
    d = col(d)
    return F.year(d) * 12 + F.month(d)


def pidx_of_period(period: Column | str) -> Column:
    period = col(period).cast("int")
    return F.floor(period / 100).cast("int") * 12 + period % 100


def period_of_pidx(pidx: Column | str) -> Column:
    m = col(pidx) - 1
    return (F.floor(m / 12) * 100 + m % 12 + 1).cast("int")


def year_of_pidx(pidx: Column | str) -> Column:
    return F.floor((col(pidx) - 1) / 12).cast("int")


def month_of_pidx(pidx: Column | str) -> Column:
    return ((col(pidx) - 1) % 12 + 1).cast("int")


def to_pidx(period: int) -> int:
    """Driver-side twin of :func:`pidx_of_period` for parameters."""
    year, month = divmod(int(period), 100)
    if not 1 <= month <= 12:
        raise ValueError(f"not a YYYYMM period: {period}")
    return year * 12 + month


def from_pidx(pidx: int) -> int:
    return (pidx - 1) // 12 * 100 + (pidx - 1) % 12 + 1


# ---- labels --------------------------------------------------------------

def period_label(period: Column | str) -> Column:
    """202412 → ``12/2024``."""
    period = col(period).cast("int")
    return F.concat(
        F.lpad((period % 100).cast("string"), 2, "0"), F.lit("/"), F.floor(period / 100).cast("string")
    )


def span_label(first: Column, last: Column, prefix: str = "") -> Column:
    """``mm/yyyy - mm/yyyy`` of two periods, NULL when either is."""
    return F.concat(F.lit(prefix), period_label(first), F.lit(" - "), period_label(last))


def period_text(year: Column | str, month_long: Column | str) -> Column:
    return F.concat_ws("-", col(year).cast("string"), col(month_long))


def ytd_text(d: Column | str, as_of: Column) -> Column:
    """``YTD`` for dates of the year of ``as_of`` up to it, else ``Fuera``."""
    d = col(d)
    return F.when((d <= as_of) & (F.year(d) == F.year(as_of)), F.lit("YTD")).otherwise(F.lit("Fuera"))


# ---- calendar parts ------------------------------------------------------

def iso_weekday(d: Column | str) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(col(d)) + 1


def iso_week_label(d: Column | str) -> Column:
    d = col(d)
    week = F.lpad(F.weekofyear(d).cast("string"), 2, "0")
    return F.concat(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("-W"), week)


def flag(condition: Column) -> Column:
    return condition.cast("int")


def is_month_start(d: Column | str) -> Column:
    return flag(F.dayofmonth(col(d)) == 1)


def is_month_end(d: Column | str) -> Column:
    return flag(F.last_day(col(d)) == col(d))


def is_quarter_start(d: Column | str) -> Column:
    d = col(d)
    return flag(F.to_date(F.date_trunc("quarter", d)) == d)


def is_quarter_end(d: Column | str) -> Column:
    d = col(d)
    return flag(F.last_day(F.add_months(F.to_date(F.date_trunc("quarter", d)), 2)) == d)


def is_year_start(d: Column | str) -> Column:
    return flag(F.dayofyear(col(d)) == 1)


def is_year_end(d: Column | str) -> Column:
    d = col(d)
    return flag((F.month(d) == 12) & (F.dayofmonth(d) == 31))
