"""Latest version per business key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# complex columns cannot break ties by value, so they are compared by hash
_UNORDERED = ("map", "variant")


def tie_breakers(df: DataFrame, used: set[str]) -> list[Column]:
    """Every other column, so that the order of versions is total."""
    rest = []
    for field in df.schema.fields:
        if field.name.lower() in used:
            continue
        c = F.col(field.name)
        if field.dataType.typeName() in _UNORDERED:
            c = F.xxhash64(F.to_json(c))
        rest.append(c.desc_nulls_last())
    return rest


def latest_version(
    df: DataFrame,
    keys: list[str] | dict[str, Column],
    order_by: str = "LOA_DAT",
    ties: list[Column] | None = None,
) -> DataFrame:
    """Keep the row with the greatest ``order_by`` per key.

    ``keys`` are column names, or names mapped to expressions for keys that are
    computed. A row without a stamp is never the latest. Equal stamps are told
    apart by the remaining columns (or ``ties``), so reruns agree.

    The filter sits directly on the row number: Spark then drops all but one
    row per key inside each task *before* the shuffle, which is what keeps a
    hot key from landing whole in one task.
    """
    if isinstance(keys, dict):
        parts, used = list(keys.values()), set()
    else:
        parts, used = [F.col(k) for k in keys], {k.lower() for k in keys}
    used.add(order_by.lower())
    order = [F.col(order_by).desc_nulls_last(), *(tie_breakers(df, used) if ties is None else ties)]
    window = Window.partitionBy(*parts).orderBy(*order)
    return df.withColumn("_version", F.row_number().over(window)).filter("_version = 1").drop("_version")
