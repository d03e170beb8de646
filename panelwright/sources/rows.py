"""Small constant tables."""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import DataFrame, SparkSession, types as T


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def inline_rows(spark: SparkSession, schema: T.StructType | str, rows: list[tuple]) -> DataFrame:
    """A constant table. As VALUES its size is known, so joins to it are broadcast."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not rows:
        return empty_table(spark, schema)
    names = ", ".join(f"`{f.name}`" for f in schema.fields)
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    casts = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({names})")


def empty_table(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """A declared table without rows."""
    return spark.createDataFrame([], schema)
