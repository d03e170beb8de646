"""Data quality: every fact key resolves, no nulls, no negatives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..sources.rows import inline_rows


def referential_report(
    fact: DataFrame, dims: dict[str, tuple[str, DataFrame, str]], value: str = "value"
) -> DataFrame:
    """One row per check: ``check_name, rows_failing``.

    ``dims`` maps a check name to (fact key, dimension, dimension key). Keys are
    counted first, so that a key that fills a third of the fact meets its
    dimension once.
    """
    checks = []
    for name, (key, dim, dim_key) in dims.items():
        counted = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        known = dim.select(F.col(dim_key).alias("_known"))
        orphans = counted.join(known, F.col(key) == F.col("_known"), "left_anti")
        checks.append(
            orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows_failing")).select(
                F.lit(f"orphan_{name}").alias("check_name"), "rows_failing"
            )
        )
    nullable = [key for key, _, _ in dims.values()] + [value]
    counts = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nullable]
    counts.append(F.count_if(F.col(value) < 0).alias(f"negative_{value}"))
    profile = fact.agg(*counts)
    checks.append(profile.unpivot([], profile.columns, "check_name", "rows_failing"))
    return reduce(lambda a, b: a.unionByName(b), checks)


def duplicate_labels(mapping: DataFrame, label: str) -> DataFrame:
    """Mapping labels that appear more than once in a source after normalisation."""
    key = F.upper(F.trim(label)).alias("label")
    return mapping.groupBy("SRC_DSC", key).agg(F.count(F.lit(1)).alias("entries")).filter("entries > 1")


def load_metrics(warehouse, layer: str, table: str) -> DataFrame:
    """What was counted while the loads of a table were written: ``version, metric, value``. Read from its commits; the
    table itself is not scanned."""
    versions = warehouse.versioned(layer, table)
    rows = [(v, k, None if x is None else str(x)) for v in (versions.versions() if versions else [])
            for k, x in sorted(versions.manifest(v).metrics.items())]
    return inline_rows(warehouse.spark, "version int, metric string, value string", rows)
