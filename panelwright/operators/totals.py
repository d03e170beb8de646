"""Totals next to members: the denominators of shares and weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.ratios import divide


def with_totals(members: DataFrame, sums: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """Add ``{total: sum(member column)}`` over ``by`` (all rows when empty).

    ``members`` is already aggregated. The total is a second, much smaller
    aggregate of the same frame, so its exchange is reused and nothing is read
    twice. It is attached as a scalar or by an equi join, never by a window
    over the whole frame: that would pull all members of a market into one task.
    """
    totals = [f"SUM(`{c}`) AS `{t}`" for t, c in sums.items()]
    if not by:
        fields = ", ".join(f"'{t}', SUM(`{c}`)" for t, c in sums.items())
        packed = members.selectExpr(f"named_struct({fields})").scalar()
        return members.select("*", packed.alias("_totals")).selectExpr(
            *[f"`{c}`" for c in members.columns], *[f"_totals.`{t}` AS `{t}`" for t in sums]
        )
    grouped = members.groupBy(*[F.expr(f"`{b}` AS `_by_{b}`") for b in by]).agg(*[F.expr(t) for t in totals])
    same = " AND ".join(f"`{b}` <=> `_by_{b}`" for b in by)
    return members.join(grouped, F.expr(same)).drop(*[f"_by_{b}" for b in by])


def percent_of_total(members: DataFrame, value: str, out: str, by: list[str] | None = None) -> DataFrame:
    total = with_totals(members, {"_total": value}, by)
    return total.withColumn(out, F.expr(divide(value, "_total"))).drop("_total")
