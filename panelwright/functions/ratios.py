"""Ratios with the blank and zero rules of the measures.

These functions take and return SQL text. A report puts dozens of them into
one ``selectExpr``; as text each column is a single call to the JVM.
"""

from __future__ import annotations


def as_double(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def zero(x: str) -> str:
    return f"COALESCE(CAST({x} AS DOUBLE), 0D)"


def divide(a: str, b: str, alt: str = "NULL") -> str:
    """``a / b``; ``alt`` when ``b`` is NULL or 0; NULL when only ``a`` is NULL."""
    return f"CASE WHEN {zero(b)} = 0 THEN CAST({alt} AS DOUBLE) ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


def share(part: str, whole: str) -> str:
    """Share of a whole; 0 when there is no whole, NULL when the part is blank."""
    return divide(part, whole, "0")


def growth(cur: str, prev: str) -> str:
    return f"({zero(cur)} - {zero(prev)})"


def pct_growth(cur: str, prev: str) -> str:
    """Relative growth; 0 when there is nothing to compare with."""
    return f"CASE WHEN {zero(prev)} = 0 THEN 0D ELSE {zero(cur)} / CAST({prev} AS DOUBLE) - 1 END"


def bps(share_cur: str, share_prev: str, has_prior: str = "has_prior") -> str:
    """Share change in basis points; 0 without a prior period."""
    return f"CASE WHEN {has_prior} THEN ({zero(share_cur)} - {zero(share_prev)}) * 10000 ELSE 0D END"


def trend(change: str, has_prior: str = "has_prior") -> str:
    """``up`` / ``down`` / ``flat`` / ``none`` (nothing to compare with)."""
    return f"CASE WHEN NOT {has_prior} THEN 'none' WHEN {change} > 0 THEN 'up' WHEN {change} < 0 THEN 'down' ELSE 'flat' END"


def trend_symbol(change: str, has_prior: str = "has_prior") -> str:
    # The four symbols of the reports.
    return f"CASE WHEN NOT {has_prior} THEN '○' WHEN {change} > 0 THEN '▲' WHEN {change} < 0 THEN '▼' ELSE '–' END"
