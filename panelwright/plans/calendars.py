"""Daily, monthly and national calendars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import dates

# The range of the conformed daily calendar.
FIRST_DAY = dt.date(1990, 1, 1)
LAST_DAY = dt.date(2070, 12, 31)


def day_spine(spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("DAT_COD"))


def daily_calendar(
    spark: SparkSession,
    first: dt.date = FIRST_DAY,
    last: dt.date = LAST_DAY,
    loaded_at: Column | None = None,
    source: str = "SHARED_CALENDAR",
) -> DataFrame:
    """One row per day with day, ISO week, month, quarter, term and year parts."""
    d, month, year = F.col("DAT_COD"), F.month("DAT_COD"), F.year("DAT_COD")
    return day_spine(spark, first, last).select(
        "DAT_COD",
        dates.date_int(d).alias("DAT_KEY"),
        dates.month_int(d).alias("PER_KEY"),
        year.alias("YEA_COD"),
        F.when(month <= 6, 1).otherwise(2).alias("SEM_COD"),
        F.ceil(month / 4).cast("int").alias("QUA_COD"),  # four-month term
        F.quarter(d).alias("QUA_DSC"),
        F.concat(year.cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("YEA_QUA"),
        month.alias("MON_NUM"),
        F.date_format(d, "MMM").alias("MON_SHR"),
        F.date_format(d, "MMMM").alias("MON_LNG"),
        F.dayofmonth(d).alias("DAY_NUM"),
        dates.iso_weekday(d).alias("DAY_WEK_NUM"),
        F.date_format(d, "EEE").alias("DAY_WEK_NAM"),
        F.weekofyear(d).alias("WEK_YEA"),
        dates.iso_week_label(d).alias("YEA_WEK_ISO"),
        F.date_format(d, "yyyy-MM").alias("YEA_MON"),
        F.date_format(d, "MMM-yyyy").alias("PER_NAM"),
        dates.flag(dates.iso_weekday(d) >= 6).alias("WEK_END"),
        dates.is_month_start(d).alias("MON_BGN"),
        dates.is_month_end(d).alias("MON_END"),
        dates.is_quarter_start(d).alias("QUA_BGN"),
        dates.is_quarter_end(d).alias("QUA_END"),
        dates.is_year_start(d).alias("YEA_BGN"),
        dates.is_year_end(d).alias("YEA_END"),
        F.lit(source).alias("SRC_DSC_ORG"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("LOA_DAT"),
    )


def period_limits(fact: DataFrame, period: str = "PER_DSC") -> DataFrame:
    """First and last date among the 6- or 8-digit periods of a fact (one row)."""
    # distinct first: a fact has few periods, so almost nothing is parsed or shuffled
    days = fact.select(period).distinct().select(dates.code_to_date(period).alias("_d"))
    return days.agg(F.min("_d").alias("min_date"), F.max("_d").alias("max_date"))


def months_between(limits: DataFrame, low: str = "min_date", high: str = "max_date") -> DataFrame:
    """The months of a one-row date range, without gaps."""
    first, last = F.trunc(low, "month"), F.trunc(high, "month")
    return limits.select(
        F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("DAT_COD"), last.alias("_last_month")
    )


def national_calendar(
    fact: DataFrame, period: str = "PER_DSC", as_of: Column | None = None, loaded_at: Column | None = None
) -> DataFrame:
    """Monthly calendar over the periods of the national fact, Portuguese labels, last-year shifts and flags."""
    today = F.current_date() if as_of is None else as_of
    d, month, year = F.col("DAT_COD"), F.month("DAT_COD"), F.year("DAT_COD")
    short = dates.month_name(month, dates.PT_SHORT)
    return months_between(period_limits(fact, period)).select(
        "DAT_COD",
        F.add_months(d, -12).alias("DAT_LSY"),
        dates.month_int(d).alias("PER_DSC"),
        year.alias("YEA_DSC"),
        (year - 1).alias("YEA_LSY"),
        month.alias("MON_NUM"),
        short.alias("MON_SHR"),
        dates.month_name(month, dates.PT_LONG).alias("MON_LNG"),
        F.quarter(d).alias("QUA_DSC"),
        F.concat(year.cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("YEA_QUA"),
        F.concat(year.cast("string"), F.lit(" "), short).alias("PER_NAM"),
        dates.flag(d == F.trunc(today, "month")).alias("CUR_MON"),
        F.when(month == F.month("_last_month"), "Mes Actual").otherwise("Otros Meses").alias("MAX_MON"),
        F.when(year == F.year("_last_month"), "Año Actual").otherwise("Otros Años").alias("MAX_YEA"),
        F.lit("GOLD_CALENDAR").alias("SRC_DSC_ORG"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("LOA_DAT"),
    )


def month_calendar(limits: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The star's calendar: one row per month of a one-row date range."""
    today = F.current_date() if as_of is None else as_of
    d, month, year = F.col("DAT_COD"), F.month("DAT_COD"), F.year("DAT_COD")
    return months_between(limits).select(
        d.alias("date"),
        year.alias("year"),
        F.quarter(d).alias("quarter"),
        month.alias("month_number"),
        F.date_format(d, "MMM").alias("month_short"),
        F.date_format(d, "MMMM").alias("month_long"),
        dates.month_int(d).alias("period_id"),
        F.date_format(d, "yyyy-MM").alias("period_name"),
        F.concat(year.cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        (year - 1).alias("year_ly"),
        F.add_months(d, -12).alias("date_ly"),
        dates.flag(year == F.year(today)).alias("current_year"),
        dates.flag(d == F.trunc(today, "month")).alias("current_month"),
        dates.pidx_of_date(d).alias("pidx"),
    )


def month_index(limits: DataFrame) -> DataFrame:
    """Only what the period windows need: ``period_id, pidx`` per month of a one-row date range."""
    return months_between(limits).selectExpr(
        "year(DAT_COD) * 100 + month(DAT_COD) AS period_id", "year(DAT_COD) * 12 + month(DAT_COD) AS pidx"
    )
