"""CSV in and out of the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import STAR_COLUMNS, star_csv_schema


def read_star_csv(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One star table from its headed CSV, columns renamed to the names used here."""
    raw = spark.read.schema(star_csv_schema(table)).option("header", True).csv(f"{folder.rstrip('/')}/{table}.csv")
    return raw.select(*[F.col(f"`{header}`").alias(name) for header, name, _ in STAR_COLUMNS[table]])


def read_star(spark: SparkSession, folder: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
    return {t: read_star_csv(spark, folder, t) for t in (tables or list(STAR_COLUMNS))}


def with_star_headers(df: DataFrame, table: str) -> DataFrame:
    """Back to the header names of the CSV."""
    return df.select(*[F.col(name).alias(header) for header, name, _ in STAR_COLUMNS[table]])


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Headed CSV. Parts are written side by side; a report of known small size may ask for one file."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
