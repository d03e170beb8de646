"""European number text (``.`` for thousands, ``,`` for decimals).

As in ``ratios``, these functions take and return SQL text.
"""

from __future__ import annotations


def es_num(x: str, decimals: int = 0) -> str:
    return f"translate(format_number(CAST({x} AS DOUBLE), {decimals}), ',.', '.,')"


def es_pct(x: str, decimals: int = 1) -> str:
    return f"concat({es_num(f'({x}) * 100', decimals)}, ' %')"


def es_mill(x: str) -> str:
    return f"concat({es_num(f'({x}) / 1e6', 1)}, ' mill.')"


def es_scale(x: str) -> str:
    """Millions, thousands or the plain integer, by magnitude."""
    thousands = f"concat({es_num(f'({x}) / 1e3', 1)}, ' mil')"
    return f"CASE WHEN abs({x}) >= 1e6 THEN {es_mill(x)} WHEN abs({x}) >= 1e3 THEN {thousands} ELSE {es_num(x)} END"


def es_sig(x: str, sig: int = 2, max_decimals: int = 8) -> str:
    """At least ``sig`` significant digits, at most ``max_decimals`` decimals."""
    wanted = f"least(greatest(0, {sig - 1} - floor(log10(abs({x})))), {max_decimals})"
    branches = " ".join(f"WHEN {d} THEN {es_num(x, d)}" for d in range(max_decimals + 1))
    return f"CASE WHEN {x} = 0 THEN '0' ELSE CASE {wanted} {branches} END END"


def with_symbol(symbol: str, text: str) -> str:
    return f"concat({symbol}, ' ', {text})"


def or_dash(text: str) -> str:
    return f"COALESCE({text}, '–')"
