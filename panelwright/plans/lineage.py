"""From staging to the star, layer by layer, in lineage order.

Each step names the tables it reads and the one it writes; a step whose inputs are not there yet is left out. Panel facts
are loaded incrementally. What is derived from them is kept up by change: a table's commit remembers the versions that it
was made from, so a step with the same inputs is skipped, and a fact is made anew only for the periods that its own inputs
have changed. Anything else that changes (a mapping, a master) makes the whole table anew. In a catalog, where versions
aren't known, derived tables are written on every run. A table that someone else has supplied is left as it is.

Members of the star are numbered by dictionaries that only grow (``KEY_...``), so that numbers stay as products come.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..functions import dates, keys
from ..operators import dictionary, lookup
from ..schemas import STAGING, STAR_COLUMNS, star_schema
from ..sources import star_csv
from ..sources.layers import Warehouse
from ..sources.versions import Manifest, Receipt, part_of, value_of
from . import calendars, marts, mastering, panels, rollups, star

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Step:
    layer: str
    table: str
    reads: dict[str, str]  #: table → layer
    make: Callable[[Tables], DataFrame]
    partition_by: str | None = None
    #: inputs whose changed periods are the only ones to make anew: input → its period's text to the output's
    follows: dict[str, Callable[[str | None], str | None]] = field(default_factory=dict)
    #: rows are only ever added; ``make`` gets the table itself, if there is one, and gives what to add
    grows: bool = False
    #: inputs of which a row, once there, stays as it is for the columns read
    fixed: frozenset[str] = frozenset()
    #: depends on the day, too
    daily: bool = False
    #: inputs of which only the periods are read: those are the names of their partitions, so no row is
    periods_of: frozenset[str] = frozenset()
    #: tables of the same layer and periods that ``make_finer`` makes the same rows of, if they are made from the same inputs
    finer: list[str] = field(default_factory=list)
    make_finer: Callable[[DataFrame], DataFrame] | None = None
    #: ``make`` deals its rows to writers by ``partition_by``, before it makes several of one
    dealt: bool = False
    #: inputs that rows are looked up in and that may have many: products, and what is numbered like them
    lookups: frozenset[str] = frozenset()

    def rows(self, tables: Tables) -> DataFrame:
        return self.make({t: lookup.without_large_broadcast(rows) if t in self.lookups else rows for t, rows in tables.items()})


def _measures(df: DataFrame) -> DataFrame:
    """A panel fact with the measure names of the gold facts; panel D has no weight."""
    weight = F.col("SO_KILOS") if "SO_KILOS" in df.columns else F.lit(None).cast("decimal(18,4)")
    return df.withColumns({"SAL_VAL": F.col("SO_VALUES"), "SAL_UNT": F.col("SO_UNITS"), "SAL_WGT": weight,
                           "SRC_DSC_ORG": F.col("SOURCE_CODE" if "SOURCE_CODE" in df.columns else "SRC_DSC")})


def _national(t: Tables) -> DataFrame:
    feeds = {"PNL_C_COD": t["FACT_PT_PANEL_C"], "PNL_D_COD": t["FACT_PT_PANEL_D_UNION"], "PNL_B_COD": t["FACT_PT_PANEL_B"]}
    columns = marts.GOLD_FACT
    return marts.national_fact({k: _measures(v).select(*columns) for k, v in feeds.items()}, t["M_PT_PRODUCT_NACIONAL"])


def _top2(t: Tables) -> DataFrame:
    columns = marts.GOLD_FACT
    own = [_measures(t[n]).select(*columns) for n in ("FACT_PT_PANEL_C", "FACT_PT_PANEL_A_FOOD", "FACT_PT_PANEL_A_MILK")]
    return marts.top2_fact(own[0], own[1:], t["M_PT_PRODUCT_TOP2"])


def _star_fact(t: Tables) -> DataFrame:
    tall = star.tall_fact(star.base_fact(t["FACT_MARKETSHARE_ALL"]), t["DIM_PROD"], deal_by="period_id")
    return tall.withColumn("value", F.col("value").cast("double"))


def _added(members: Callable[[Tables], DataFrame], table: str) -> Callable[[Tables], DataFrame]:
    return lambda t: dictionary.extended(members(t), t.get(table), "member", "number")


def _marketshare(t: Tables) -> DataFrame:
    """The consolidated mart: volume and value rows of the national fact, under product numbers and months. Codes are compared
    as the master writes them, trimmed and in capitals."""
    sold = t["FACT_NACIONAL"].withColumn("PDT_COD", keys.norm("PDT_COD"))
    described = t["DIM_PROD"].select(F.col("product_id").alias("_id"), "category_id", "product_pack")
    # members and their products are joined first, so that sales are exchanged once
    known = t["KEY_PROD"].join(described, F.col("number") == F.col("_id"), "left").select("member", "number", "category_id", "product_pack")
    missing = described.where(F.col("_id") == dictionary.NOT_ASSIGNED)
    found = F.col("number").isNotNull()
    numbered = sold.join(known, F.col("PDT_COD") == F.col("member"), "left").withColumns({
        "number": F.coalesce("number", F.lit(dictionary.NOT_ASSIGNED)),
        **{c: F.when(found, F.col(c)).otherwise(missing.select(F.max(c)).scalar()) for c in ("category_id", "product_pack")},
        "PER_DSC": F.substring(F.col("PER_DSC").cast("string"), 1, 6).try_cast("int")})
    volume, amount = (F.struct(F.lit(k).alias("KPI"), F.col(c).alias("SO_VALUE")) for k, c in (("VOL", "SAL_WGT"), ("VAL", "SAL_VAL")))
    there = {k: F.col(c).isNotNull() for k, c in (("VOL", "SAL_WGT"), ("VAL", "SAL_VAL"))}
    amounts = F.when(there["VOL"] & there["VAL"], F.array(volume, amount)).when(there["VOL"], F.array(volume)).when(there["VAL"], F.array(amount))
    return numbered.hint("rebalance", "PER_DSC").select(
        "PER_DSC", F.col("number").alias("PDT_COD"), "CHL_COD", "SAL_TYP_COD", F.coalesce("category_id", F.lit(dictionary.NOT_ASSIGNED)).alias("CTG_COD"), F.col("product_pack").alias("PDT_PCK"),
        F.inline(amounts))


def _whole_number(value: str | None) -> str | None:
    """What a period's text becomes as a number."""
    text = (value or "").strip()
    return str(int(text)) if text.lstrip("+-").isdigit() else None


def _month(value: str | None) -> str | None:
    return _whole_number((value or "")[:6])


def _flat(t: Tables) -> DataFrame:
    return star.flat_extract(t["FACT_TABLE"], t)


_DWH, _TRA, _DMT, _STAR = "SILVER_DWH", "SILVER_TRA", "GOLD_DMT", "GOLD_STAR"
STEPS = [
    Step(_TRA, "PRODUCT_MASTER", {"STG_PT_PRODUCT": "BRONZE_STG"}, lambda t: mastering.product_master(t["STG_PT_PRODUCT"])),
    Step(_DMT, "FACT_NACIONAL", {"FACT_PT_PANEL_C": _DWH, "FACT_PT_PANEL_D_UNION": _DWH, "FACT_PT_PANEL_B": _DWH,
                                 "M_PT_PRODUCT_NACIONAL": _TRA}, _national, "PER_DSC",
         dict.fromkeys(["FACT_PT_PANEL_C", "FACT_PT_PANEL_D_UNION", "FACT_PT_PANEL_B"], _whole_number),
         lookups=frozenset({"M_PT_PRODUCT_NACIONAL"})),
    Step(_DMT, "FACT_TOP2", {"FACT_PT_PANEL_C": _DWH, "FACT_PT_PANEL_A_FOOD": _DWH, "FACT_PT_PANEL_A_MILK": _DWH,
                             "M_PT_PRODUCT_TOP2": _TRA}, _top2, "PER_DSC",
         dict.fromkeys(["FACT_PT_PANEL_C", "FACT_PT_PANEL_A_FOOD", "FACT_PT_PANEL_A_MILK"], _whole_number),
         lookups=frozenset({"M_PT_PRODUCT_TOP2"})),
    Step(_DMT, "DIM_PRODUCT", {"PRODUCT_MASTER": _TRA}, lambda t: mastering.product_dimension(t["PRODUCT_MASTER"])),
    Step(_DMT, "DIM_SALES_TYPE", {"SALES_TYPES": _TRA}, lambda t: mastering.sales_type_dimension(t["SALES_TYPES"])),
    Step(_DMT, "DIM_CALENDAR_NACIONAL", {"FACT_NACIONAL": _DMT}, lambda t: calendars.national_calendar(t["FACT_NACIONAL"]),
         daily=True, periods_of=frozenset({"FACT_NACIONAL"})),
    Step(_TRA, "NEW_PRODUCTS", {"FACT_ES_PANEL_I": _DWH, "M_ES_PRODUCT": _TRA, "M_ES_CATEGORY": _TRA},
         lambda t: mastering.new_products(t["FACT_ES_PANEL_I"], t["M_ES_PRODUCT"], t["M_ES_CATEGORY"], "PANEL_I"),
         lookups=frozenset({"M_ES_PRODUCT"})),
    Step(_DMT, "NEW_PRODUCTS", {"STG_ES_PANEL_I_NP": "BRONZE_STG", "NEW_PRODUCTS": _TRA},
         lambda t: mastering.new_product_attributes(t["STG_ES_PANEL_I_NP"], t["NEW_PRODUCTS"])),
    Step(_STAR, "KEY_PROD", {"DIM_PRODUCT": _DMT}, _added(lambda t: t["DIM_PRODUCT"].select(F.col("PDT_COD").alias("member")), "KEY_PROD"), grows=True,
         lookups=frozenset({"KEY_PROD"})),
    Step(_STAR, "KEY_CATEGORY", {"DIM_PRODUCT": _DMT}, _added(lambda t: t["DIM_PRODUCT"].select(F.col("CAT_DSC").alias("member")), "KEY_CATEGORY"), grows=True,
         lookups=frozenset({"KEY_CATEGORY"})),
    Step(_STAR, "KEY_SOURCE", {"DIM_PRODUCT": _DMT}, _added(lambda t: t["DIM_PRODUCT"].select(F.col("ORG_DSC").alias("member")), "KEY_SOURCE"), grows=True,
         lookups=frozenset({"KEY_SOURCE"})),
    Step(_STAR, "DIM_PROD", {"DIM_PRODUCT": _DMT, "KEY_PROD": _STAR, "KEY_CATEGORY": _STAR},
         lambda t: star.product_dimension(t["DIM_PRODUCT"], t["KEY_PROD"], t["KEY_CATEGORY"]),
         lookups=frozenset({"KEY_PROD", "KEY_CATEGORY"})),
    Step(_STAR, "DIM_CATEGORY", {"DIM_PRODUCT": _DMT, "KEY_CATEGORY": _STAR, "KEY_SOURCE": _STAR},
         lambda t: star.category_dimension(t["DIM_PRODUCT"], t["KEY_CATEGORY"], t["KEY_SOURCE"]),
         lookups=frozenset({"KEY_CATEGORY", "KEY_SOURCE"})),
    Step(_STAR, "DIM_SOURCE", {"KEY_SOURCE": _STAR}, lambda t: star.source_dimension(t["KEY_SOURCE"])),
    Step(_STAR, "DIM_CHANNEL", {"MAP_PT_CHANNEL": _DWH, "MAP_ES_CHANNEL": _DWH},
         lambda t: star.channel_dimension(t["MAP_PT_CHANNEL"].unionByName(t["MAP_ES_CHANNEL"]))),
    Step(_STAR, "DIM_SALES_TYPE", {"MAP_PT_SALES_TYPE": _DWH, "MAP_ES_SALES_TYPE": _DWH},
         lambda t: star.sales_type_dimension(t["MAP_PT_SALES_TYPE"].unionByName(t["MAP_ES_SALES_TYPE"]))),
    Step(_DMT, "FACT_MARKETSHARE_ALL", {"FACT_NACIONAL": _DMT, "KEY_PROD": _STAR, "DIM_PROD": _STAR}, _marketshare, "PER_DSC",
         {"FACT_NACIONAL": _month}, dealt=True, lookups=frozenset({"KEY_PROD", "DIM_PROD"})),
    Step(_STAR, "DIM_CALENDAR", {"FACT_MARKETSHARE_ALL": _DMT}, lambda t: calendars.month_calendar(
        calendars.period_limits(t["FACT_MARKETSHARE_ALL"])).select(*[name for _, name, _ in STAR_COLUMNS["DIM_CALENDAR"]]), daily=True,
         periods_of=frozenset({"FACT_MARKETSHARE_ALL"})),
    Step(_STAR, "FACT_TABLE", {"FACT_MARKETSHARE_ALL": _DMT, "DIM_PROD": _STAR}, _star_fact, "period_id",
         {"FACT_MARKETSHARE_ALL": _whole_number}, dealt=True, lookups=frozenset({"DIM_PROD"})),
    Step(_STAR, "FACT_BIRTH_RATE", {"FACT_BIRTH_RATE": _DMT, "DIM_CALENDAR": _STAR}, lambda t: star.context_fact(
        t["FACT_BIRTH_RATE"].select(F.col("PER_DSC").alias("period_id"), F.col("BIRTH_RATE").cast("double").alias("value")), t["DIM_CALENDAR"])),
    Step(_STAR, "FLAT_FACT", {"FACT_TABLE": _STAR, **{d: _STAR for d in star.RELATIONS}}, _flat, "period_id", {"FACT_TABLE": _whole_number},
         fixed=frozenset({"DIM_CALENDAR"}), lookups=frozenset({"DIM_PROD"})),
    *[Step(_STAR, r.table, {"FACT_TABLE": _STAR, **{d: _STAR for d in r.dimensions()}}, lambda t, r=r: r.of(t["FACT_TABLE"], t), "period_id",
           {"FACT_TABLE": _whole_number}, finer=r.finer(), make_finer=r.of_finer,
           lookups=frozenset({"DIM_PROD"})) for r in reversed(rollups.ROLLUPS)],
]


def load_panels(warehouse: Warehouse) -> list[str]:
    """The panel facts whose staging and mappings are there."""
    loaded = []
    for panel in panels.PANELS.values():
        names = list(panel.feed_sources.values()) or [panel.staging]
        needed = {c.mapping for c in panel.codes} | {f[0] for f in panel.feed_codes}
        there = [warehouse.read_or_none(panel.staging_layer, n, STAGING.get(n)) for n in names]
        there += [warehouse.read_or_none(_DWH, m) for m in needed]
        if all(x is not None for x in there):
            panels.run(panel, warehouse)
            loaded.append(panel.target)
    return loaded


def dirty_periods(warehouse: Warehouse, step: Step, own: Manifest | None, versions: dict[str, str]) -> set[str | None] | None:
    """The periods of a step's table that its inputs have changed since it was made; None if all may have."""
    if own is None or not step.follows or set(own.inputs) != set(versions):
        return None
    dirty: set[str | None] = set()
    for table, version in versions.items():
        before = own.inputs[table]
        if before == version:
            continue
        source = warehouse.versioned(step.reads[table], table) if table in step.follows else None
        changed = source.changed_since(int(before)) if source is not None and before.isdigit() else None
        if changed is None:
            return None
        dirty |= {step.follows[table](value_of(part)) for part in changed}
    return dirty


def _narrowed(warehouse: Warehouse, layer: str, table: str, rows: DataFrame, follow: Callable[[str | None], str | None],
              dirty: set[str | None]) -> DataFrame:
    """The rows of an input that belong to dirty periods: a filter on its partitions alone."""
    manifest = warehouse.manifest(layer, table)
    period = F.col(manifest.partition_by)
    values = {v for v in manifest.values.values() if follow(v) in dirty}
    chosen = period.cast("string").isin([v for v in values if v is not None])
    return rows.filter(chosen | period.isNull() if None in values else chosen)


def _periods(warehouse: Warehouse, layer: str, table: str, rows: DataFrame) -> DataFrame:
    """The periods of a table: the values of its partitions, as many as the calendar has. Without partitions, its rows'."""
    manifest = warehouse.manifest(layer, table)
    if manifest is None or manifest.partition_by is None:
        return rows
    kind = rows.schema[manifest.partition_by].dataType
    values = rows.sparkSession.createDataFrame([(v,) for v in manifest.values.values()], f"`{manifest.partition_by}` string")
    return values.select(F.col(manifest.partition_by).cast(kind).alias(manifest.partition_by))


def _finer(warehouse: Warehouse, step: Step, versions: dict[str, str]) -> str | None:
    """The first of a step's finer tables that is made from the same inputs, all of them, and has the step's partitions."""
    for table in step.finer:
        manifest = warehouse.manifest(step.layer, table)
        if manifest is not None and manifest.partition_by == step.partition_by and versions.items() <= manifest.inputs.items():
            return table
    return None


def _same(a: DataFrame, b: DataFrame) -> bool:
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def run_step(warehouse: Warehouse, step: Step) -> bool:
    """Whether the step's table has changed."""
    versions, own = {}, warehouse.versioned(step.layer, step.table)
    if own is not None:
        versions = {t: warehouse.state_of(layer, t) for t, layer in step.reads.items() if t not in step.fixed}
        if step.daily:
            versions["today"] = dt.date.today().isoformat()
        manifest, receipt = own.manifest(), Receipt(inputs=versions)
        if manifest is not None and manifest.inputs in ({}, versions):
            return False  # supplied from outside, or made from the same
    tables = {t: warehouse.read(layer, t, STAGING.get(t)) for t, layer in step.reads.items()}
    tables |= {t: _periods(warehouse, step.reads[t], t, tables[t]) for t in step.periods_of if own is not None}
    if step.grows:
        there = warehouse.read_or_none(step.layer, step.table)
        rows = step.rows(tables | ({} if there is None else {step.table: there}))
        warehouse.append(rows, step.layer, step.table, None, receipt if own is not None else None)
        return True
    if own is None:
        warehouse.replace(step.rows(tables), step.layer, step.table, step.partition_by)
        return True
    finer, dirty = _finer(warehouse, step, versions), dirty_periods(warehouse, step, manifest, versions)
    if dirty is not None:
        if not dirty:
            own.touch(own.read(manifest).schema, step.partition_by, receipt)
            return False
        if finer is not None:
            rows = step.make_finer(_narrowed(warehouse, step.layer, finer, warehouse.read(step.layer, finer), _whole_number, dirty))
        else:
            rows = step.rows(tables | {t: _narrowed(warehouse, step.reads[t], t, tables[t], f, dirty) for t, f in step.follows.items()})
        own.replace_parts(rows, step.partition_by, {part_of(step.partition_by, v) for v in dirty}, receipt, dealt=step.dealt)
        return True
    rows = step.rows(tables) if finer is None else step.make_finer(warehouse.read(step.layer, finer))
    if manifest is None or not manifest.inputs or step.partition_by is not None:
        own.replace_all(rows, step.partition_by, receipt, dealt=step.dealt)
        return True
    rows = rows.persist()  # compared both ways, then written
    try:
        if _same(rows, own.read(manifest)):
            own.touch(rows.schema, None, receipt)  # so that nothing that reads it is made anew
            return False
        own.replace_all(rows, step.partition_by, receipt)
        return True
    finally:
        rows.unpersist()


def load_derived(warehouse: Warehouse) -> list[str]:
    """Silver and gold tables and the star, after the panel facts. Star dimensions whose sources aren't there yet are declared
    empty, so that reports can be planned."""
    for table in ["DIM_SOURCE", "DIM_CATEGORY", "DIM_SALES_TYPE", "DIM_CHANNEL", "DIM_PROD"]:
        if warehouse.read_or_none(_STAR, table) is None:
            warehouse.create_empty(star_schema(table), _STAR, table)
    if warehouse.read_or_none(_STAR, "DIM_UNITS") is None:
        warehouse.replace(star.units_dimension(warehouse.spark), _STAR, "DIM_UNITS")
    loaded = []
    for step in STEPS:
        if all(warehouse.read_or_none(layer, t, STAGING.get(t)) is not None for t, layer in step.reads.items()):
            if run_step(warehouse, step):
                loaded.append(f"{step.layer}.{step.table}")
    return loaded


def run(warehouse: Warehouse) -> list[str]:
    return [*load_panels(warehouse), *load_derived(warehouse)]


def market(warehouse: Warehouse, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """The wide fact and the calendar of the star, for reports."""
    dims = {t: warehouse.read(_STAR, t) for t in star.RELATIONS}
    dims["DIM_PROD"] = lookup.without_large_broadcast(dims["DIM_PROD"])
    calendar = dims["DIM_CALENDAR"].withColumn("pidx", dates.pidx_of_period("period_id"))
    return star.wide_fact(warehouse.read(_STAR, "FACT_TABLE"), dims, columns), calendar


def export_flat(warehouse: Warehouse, path: str) -> None:
    """The flat extract as CSV, in files of one period each."""
    flat = warehouse.read(_STAR, "FLAT_FACT").select(*star.FLAT_COLUMNS)
    star_csv.write_csv(flat.hint("rebalance", "period_id"), path)
