"""The incremental load as a stream.

The stream's checkpoint takes the place of the high watermark: each staging file is loaded exactly once. A micro-batch goes
through the same panel load as the batch job, and its number is committed with its rows, so a micro-batch repeated after a
failure changes nothing. That needs a warehouse below a root path; catalog tables take reloads only.

* One feed: a delivery of a period must arrive in one micro-batch; set no file limit that could cut it in two.
* A union of feeds: arrivals wait in an inbox, by period. A period is loaded once every feed has delivered it, and then
  leaves the inbox; what comes later waits until all have delivered again. ``release`` loads a period that some feed will
  not deliver. Which feeds have delivered which period is part of the inbox's commits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.panels import Panel, load, load_rows, quality_metrics
from ..schemas import STAGING
from ..session import shared_folder
from ..sources.layers import Warehouse
from ..sources.versions import Receipt, part_of

#: The inbox's partition column, and the mark of rows without a period in the list of what has been delivered.
WAITING, NO_PERIOD = "WAITING_FOR", ""


def checkpoint_location(warehouse: Warehouse, name: str) -> str:
    """Under the cluster's shared checkpoint folder; next to the tables where none is set."""
    shared = warehouse.spark.conf.get("spark.checkpoint.dir", None)
    folder = shared or warehouse.root or shared_folder(warehouse.spark)
    return f"{folder.rstrip('/')}/_stream_checkpoints/{name}"


def start_panel_stream(
    panel: Panel, warehouse: Warehouse, mappings: dict[str, DataFrame], checkpoint: str | None = None
) -> StreamingQuery:
    """Load whatever staging files are new, then stop (``availableNow``)."""
    if warehouse.versioned(panel.target_layer, panel.target) is None and (panel.feed_sources or not panel.reload):
        raise ValueError("only a warehouse below a root path takes appends and unions of feeds exactly once")
    checkpoint = checkpoint or checkpoint_location(warehouse, panel.target)
    names = panel.feed_sources or {None: panel.staging}
    arrivals = None
    for tag, name in names.items():
        feed = warehouse.spark.readStream.schema(STAGING[name]).parquet(warehouse.path(panel.staging_layer, name))
        feed = feed if tag is None else feed.withColumn("SRC_DSC", F.lit(tag))
        arrivals = feed if arrivals is None else arrivals.unionByName(feed)

    def load_batch(rows: DataFrame, number: int) -> None:
        receipt = Receipt(query=checkpoint, batch=number)
        if panel.feed_sources:
            _receive(panel, warehouse, mappings, rows, receipt)
        else:
            _store(panel, warehouse, load(panel, {panel.staging: rows}, mappings), panel.emptied(rows), receipt)

    return (
        arrivals.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _store(panel: Panel, warehouse: Warehouse, batch: DataFrame, emptied: DataFrame | None, receipt: Receipt) -> None:
    metrics = quality_metrics(panel)
    if panel.reload:
        warehouse.reload(batch, panel.target_layer, panel.target, "PER_DSC", emptied, receipt, metrics)
    else:
        warehouse.append(batch, panel.target_layer, panel.target, "PER_DSC", receipt, metrics)


def inbox_of(panel: Panel) -> str:
    return f"{panel.target}_INBOX"


def waiting(panel: Panel, warehouse: Warehouse) -> dict[str, list[str]]:
    """The feeds that have delivered each period that isn't loaded yet."""
    manifest = warehouse.manifest(panel.target_layer, inbox_of(panel))
    return dict(manifest.state) if manifest else {}


def _receive(panel: Panel, warehouse: Warehouse, mappings: dict[str, DataFrame], rows: DataFrame, receipt: Receipt) -> None:
    """Put arrivals into the inbox, then load the periods that are complete. Each step is one commit that knows the
    micro-batch, so that a repeated one goes on where it ended."""
    inbox = warehouse.versioned(panel.target_layer, inbox_of(panel))
    if not inbox.holds(receipt):
        rows = rows.withColumn(WAITING, panel.period_text().cast("string"))
        state = waiting(panel, warehouse)
        # at most periods x feeds
        for period, feed in rows.select(WAITING, "SRC_DSC").distinct().collect():
            key = NO_PERIOD if period is None else period
            state[key] = sorted({*state.get(key, []), feed})
        inbox.append(rows, WAITING, Receipt(query=receipt.query, batch=receipt.batch, state=state))
    complete = [p for p, feeds in waiting(panel, warehouse).items() if p == NO_PERIOD or set(feeds) >= set(panel.feed_sources)]
    _load_waiting(panel, warehouse, mappings, complete, receipt)


def _load_waiting(panel: Panel, warehouse: Warehouse, mappings: dict[str, DataFrame], periods: list[str], receipt: Receipt) -> None:
    if not periods:
        return
    inbox = warehouse.versioned(panel.target_layer, inbox_of(panel))
    chosen = F.col(WAITING).isin([p for p in periods if p != NO_PERIOD])
    if NO_PERIOD in periods:
        chosen = F.col(WAITING).isNull() | F.coalesce(chosen, F.lit(False))
    rows = inbox.read().filter(chosen).drop(WAITING)
    _store(panel, warehouse, load_rows(panel, rows, mappings), panel.emptied(rows), receipt)
    left = {p: feeds for p, feeds in waiting(panel, warehouse).items() if p not in periods}
    gone = {part_of(WAITING, None if p == NO_PERIOD else p) for p in periods}
    manifest = inbox.manifest()
    inbox.commit(inbox.read(manifest).schema, WAITING,
                 lambda old: ({p: loads for p, loads in old.items() if p not in gone}, sorted(gone & set(old))),
                 Receipt(query=f"{receipt.query}#loaded", batch=receipt.batch, state=left))


def release(panel: Panel, warehouse: Warehouse, mappings: dict[str, DataFrame], periods: list[str], number: int) -> None:
    """Load periods with what has arrived. ``number`` counts the releases; a repeated one changes nothing."""
    there = [p for p in periods if p in waiting(panel, warehouse)]
    _load_waiting(panel, warehouse, mappings, there, Receipt(query=f"release of {inbox_of(panel)}", batch=number))
