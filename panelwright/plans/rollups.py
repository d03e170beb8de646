"""Kept monthly aggregates of the star, and the choice of one for a report.

A rollup has the sums of the star's measures by some columns, a row per member combination and month, in partitions by
period. It is a step of the lineage, so a load makes anew only the periods that it has changed. Reports sum, and take any
table with their columns for the market: ``market`` gives them the smallest rollup that has the columns asked for, or the
star join where none has. Sums are exact decimals.

The star is joined once for all of them: the largest is summed from the flat extract, each other one from the rollup before
it, as long as these are made from the same inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions import dates
from ..schemas import STAR_COLUMNS
from ..sources.layers import Warehouse
from . import star

LAYER = "GOLD_STAR"
#: Columns that every rollup has besides its own.
ALWAYS = ["metric", "period_id", "pidx", "value"]
AMOUNT, SUM = "decimal(18,4)", "decimal(28,4)"


@dataclass(frozen=True)
class Rollup:
    table: str
    columns: tuple[str, ...]

    def dimensions(self) -> list[str]:
        """The star dimensions that supply its columns."""
        own = {name for _, name, _ in STAR_COLUMNS["FACT_TABLE"]}
        needed = star.needed_dimensions([*self.columns, "metric"], own)
        return [t for t in star.RELATIONS if t in needed]

    def of(self, fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
        return self._sums(star.wide_fact(fact, dims, [*self.columns, "metric", "period_id", "value"]), AMOUNT)

    def of_finer(self, rows: DataFrame) -> DataFrame:
        """The same from a table that has its columns already: the flat extract, or a rollup by more columns."""
        return self._sums(rows, SUM if rows.schema["value"].dataType.simpleString() == SUM else AMOUNT)

    def finer(self) -> list[str]:
        """The tables that it can be summed from, the smallest first."""
        place = ROLLUPS.index(self)
        return [*[r.table for r in ROLLUPS[place + 1:] if set(self.columns) <= set(r.columns)], "FLAT_FACT"]

    def _sums(self, rows: DataFrame, kind: str) -> DataFrame:
        sums = rows.groupBy(*self.columns, "metric", "period_id").agg(F.sum(F.col("value").cast(kind)).cast(SUM).alias("value"))
        return sums.withColumn("pidx", dates.pidx_of_period("period_id"))


#: From small to large: companies with all slicers, then products' parts.
ROLLUPS = [
    Rollup("AGG_COMPANY", ("manufacturer",)),
    Rollup("AGG_COMPANY_CATEGORY", ("manufacturer", "category", "business_area")),
    Rollup("AGG_COMPANY_SLICERS", ("manufacturer", "category", "business_area", "type_channel", "channel")),
]


def choose(sizes: dict[str, int], columns: list[str]) -> Rollup | None:
    """The smallest rollup that has the columns. ``sizes``: table → bytes, of the rollups that are there."""
    able = [r for r in ROLLUPS if r.table in sizes and set(columns) <= {*r.columns, *ALWAYS}]
    return min(able, key=lambda r: sizes[r.table], default=None)


def sizes(warehouse: Warehouse) -> dict[str, int]:
    """The bytes of the rollups that are there and made from the star as it is now."""
    found = {}
    fact = warehouse.manifest(LAYER, "FACT_TABLE")
    for rollup in ROLLUPS:
        manifest = warehouse.manifest(LAYER, rollup.table)
        if fact is not None and manifest is not None and manifest.inputs.get("FACT_TABLE") == str(fact.version) and all(
                manifest.inputs.get(t) == str(warehouse.manifest(LAYER, t).version) for t in rollup.dimensions() if t in manifest.inputs):
            found[rollup.table] = warehouse.versioned(LAYER, rollup.table).size(manifest)
    return found


def market(warehouse: Warehouse, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Market rows with the asked columns and the calendar, for reports; from the smallest table that serves."""
    from . import lineage

    rollup = choose(sizes(warehouse), columns)
    if rollup is None:
        return lineage.market(warehouse, columns)
    calendar = warehouse.read(LAYER, "DIM_CALENDAR").withColumn("pidx", dates.pidx_of_period("period_id"))
    return warehouse.read(LAYER, rollup.table).select(*columns), calendar
