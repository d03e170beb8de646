"""Keys and codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the reserved "not assigned" member of every mapped dimension.
NOT_ASSIGNED_CODE = 99
NOT_ASSIGNED_LABEL = "NOT_ASSIGNED"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: Column | str) -> Column:
    """Case- and space-insensitive form of a natural key."""
    return F.upper(F.trim(col(c)))


def hash_key(c: Column | str) -> Column:
    """Surrogate key that stays the same from load to load: SHA-256 hex of ``norm``."""
    return F.sha2(norm(c), 256)


def clean_token(c: Column | str, token: str = "NA") -> Column:
    """``norm`` with the token that means "no value" turned into NULL."""
    return F.nullif(norm(c), F.lit(token))


def first_key(*cols: Column | str) -> Column:
    """First key that is present, in order of precedence."""
    return F.coalesce(*[col(c) for c in cols])


def code_or_default(c: Column | str, default: int | None = NOT_ASSIGNED_CODE) -> Column:
    return col(c) if default is None else F.coalesce(col(c), F.lit(default))


def parent_code(c: Column | str) -> Column:
    """Parent of a hierarchical code: its first digit."""
    return F.substring(col(c).cast("string"), 1, 1).cast("int")


def label_code(c: Column | str, labels: dict[str, str | int], otherwise: str | int | None = None) -> Column:
    """Code of a label from a fixed dictionary."""
    expr = None
    for label, code in labels.items():
        hit = col(c) == F.lit(label)
        expr = F.when(hit, F.lit(code)) if expr is None else expr.when(hit, F.lit(code))
    return expr if otherwise is None else expr.otherwise(F.lit(otherwise))


def decide(rules: list[tuple[dict[str, str], int]], otherwise: int = NOT_ASSIGNED_CODE) -> Column:
    """First rule whose column values all match gives the code."""
    expr = None
    for wanted, code in rules:
        hit = F.lit(True)
        for name, value in wanted.items():
            hit = hit & (F.col(name) == F.lit(value))
        expr = F.when(hit, F.lit(code)) if expr is None else expr.when(hit, F.lit(code))
    return expr.otherwise(F.lit(otherwise))


def single_or_multiple(c: Column | str, label: str = "SELECCIÓN MULTIPLE") -> Column:
    """Aggregate: the one selected value, or a label when there are several (or none)."""
    c = col(c)
    low, high = F.min(c), F.max(c)
    alone = low.isNotNull() & (low == high) & (F.count(F.lit(1)) == F.count(c))
    return F.when(alone, low).otherwise(F.lit(label))
