"""Warehouse layers: one Parquet directory (or catalog schema) per layer.

Facts are partitioned by period, so that a reload rewrites the delivered
periods only and a report reads the periods of its window only.

Below a root path, tables change by commits (``versions``): data, load log and
the ledger of micro-batches in one. Landing tables, which others deliver files
to, stay plain folders. Catalog tables keep Spark's own commit per write, with
a log table beside them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import STAGING
from .versions import Manifest, Receipt, VersionedTable, part_of, signature

# The layers, in load order.
LAYERS = ["BRONZE_STG", "SILVER_DWH", "SILVER_TRA", "GOLD_DMT", "GOLD_STAR"]
#: In the place of an input: the table was only declared.
DECLARED = "declared"
LOG, LOG_SCHEMA = "LOAD_LOG", "TARGET string, STAGED_TO string"


@dataclass(frozen=True)
class Warehouse:
    """Where the layers live: ``root`` (paths) or ``database`` (catalog tables)."""

    spark: SparkSession
    root: str | None = None
    database: str | None = None

    def __post_init__(self):
        if (self.root is None) == (self.database is None):
            raise ValueError("give either a root path or a database")

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer}")
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def name(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer}")
        return f"{self.database}.{layer}.{table}" if self.database else f"{layer}.{table}"

    def versioned(self, layer: str, table: str) -> VersionedTable | None:
        """The table's commits; None for landing tables and in a catalog."""
        if self.root is None or layer == "BRONZE_STG" or table in STAGING:
            return None
        return VersionedTable(self.spark, self.path(layer, table))

    def manifest(self, layer: str, table: str) -> Manifest | None:
        versions = self.versioned(layer, table)
        return versions.manifest() if versions else None

    def state_of(self, layer: str, table: str) -> str | None:
        """Something that differs after every change of the table; None where that can't be told."""
        if self.root is None:
            return None
        manifest = self.manifest(layer, table)
        return str(manifest.version) if manifest else signature(self.spark, self.path(layer, table))

    # ---- read --------------------------------------------------------

    def read(self, layer: str, table: str, schema: T.StructType | str | None = None) -> DataFrame:
        if self.root is None:
            return self.spark.table(self.name(layer, table))
        manifest = self.manifest(layer, table)
        if manifest is not None:
            return self.versioned(layer, table).read(manifest)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(layer, table))

    def read_or_none(self, layer: str, table: str, schema: T.StructType | str | None = None) -> DataFrame | None:
        """The table, or None before its first load."""
        if self.root is not None:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(layer, table))
            if not path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
                return None
        try:
            df = self.read(layer, table, schema)
            df.schema  # resolves the path
            return df
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    # ---- write -------------------------------------------------------

    def append(self, df: DataFrame, layer: str, table: str, partition_by: str | None = None, receipt: Receipt | None = None,
               metrics: dict[str, Column] | None = None) -> None:
        """INSERT INTO."""
        if versions := self._adopted(layer, table, partition_by):
            versions.append(df, partition_by, receipt, metrics)
        else:
            self._write(df, layer, table, "append", partition_by)

    def replace(self, df: DataFrame, layer: str, table: str, partition_by: str | None = None, receipt: Receipt | None = None,
                metrics: dict[str, Column] | None = None) -> None:
        """CREATE OR REPLACE TABLE AS SELECT. Without a receipt that says what it was made from, the table counts as supplied
        from outside."""
        if versions := self.versioned(layer, table):
            versions.replace_all(df, partition_by, receipt or Receipt(inputs={}), metrics)
        else:
            self._write(df, layer, table, "overwrite", partition_by)

    def create_empty(self, schema: T.StructType | str, layer: str, table: str) -> None:
        self.replace(self.spark.createDataFrame([], schema), layer, table, receipt=Receipt(inputs={DECLARED: ""}))

    def reload(
        self, batch: DataFrame, layer: str, table: str, period: str = "PER_DSC", emptied: DataFrame | None = None,
        receipt: Receipt | None = None, metrics: dict[str, Column] | None = None,
    ) -> None:
        """Delete the delivered periods and insert the batch, in one commit.

        Only the partitions of those periods are rewritten. ``emptied`` lists
        delivered periods without surviving rows; their partitions go with the
        same commit. Rows without a period are kept, as a delete would not
        match them. A batch with a receipt is taken once; without one, rows
        without a period that it brings again are not doubled, so that a batch
        written twice gives the same table.

        In a catalog, emptied periods are dropped right after the write; a
        crash in between is repaired by a rerun, as the log is written last.
        """
        versions = self._adopted(layer, table, period)
        if versions is None or receipt is None:
            batch = self._with_rows_kept(batch, layer, table, period)
        # a list of periods: bounded by the calendar
        gone = [r[0] for r in emptied.collect() if r[0] is not None] if emptied is not None else []
        if versions is not None:
            keep = {part_of(period, None)} if receipt is not None else set()
            versions.replace_parts(batch, period, {part_of(period, v) for v in gone}, receipt, metrics, keep)
        elif self.read_or_none(layer, table) is None:
            self._write(batch, layer, table, "append", period)
        else:
            name = self.name(layer, table)
            # also for tables made elsewhere: an overwrite replaces the partitions that it has rows of
            self.spark.sql(f"ALTER TABLE {name} SET SERDEPROPERTIES ('partitionOverwriteMode' = 'dynamic')")
            columns = self.spark.table(name).columns
            batch.hint("rebalance", period).select(*columns).write.mode("overwrite").insertInto(name)
            for value in gone:
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({period} = {int(value)})")

    def _with_rows_kept(self, batch: DataFrame, layer: str, table: str, period: str) -> DataFrame:
        """The batch with the table's rows without a period, but for those that it brings again."""
        existing = self.read_or_none(layer, table, batch.schema if self.root else None)
        if existing is None:
            return batch
        without_period = existing.filter(F.col(period).isNull()).select(*batch.columns)
        again = batch.filter(F.col(period).isNull()).select(*[F.col(c).alias(f"_again_{c}") for c in batch.columns])
        same = [F.col(c).eqNullSafe(F.col(f"_again_{c}")) for c in batch.columns]
        condition = same[0]
        for one in same[1:]:
            condition &= one
        return batch.unionByName(without_period.join(again, condition, "left_anti"))

    def _adopted(self, layer: str, table: str, partition_by: str | None) -> VersionedTable | None:
        """The table's commits; rows of a plain folder from before become the first one."""
        versions = self.versioned(layer, table)
        if versions is not None and versions.manifest() is None:
            plain = self.read_or_none(layer, table)
            if plain is not None:
                versions.replace_all(plain, partition_by)
        return versions

    # ---- load log ----------------------------------------------------

    def staged_to(self, layer: str, table: str) -> dt.datetime | None:
        """The highest load stamp that a finished load of the table has looked at."""
        manifest = self.manifest(layer, table)
        if manifest is not None and manifest.staged_to is not None:
            return dt.datetime.fromisoformat(manifest.staged_to)
        log = self.read_or_none(layer, LOG, LOG_SCHEMA)
        if log is None:
            return None
        value = log.filter(F.col("TARGET") == table).agg(F.max("STAGED_TO")).first()[0]
        return dt.datetime.fromisoformat(value) if value else None

    def record_load(self, layer: str, table: str, stamp: dt.datetime) -> None:
        """The last step of a load into a catalog table. What it looked at counts, not what survived: a delivery whose rows
        are all filtered out must not let an older one be loaded again."""
        row = [(table, stamp_text(stamp))]
        self.append(self.spark.createDataFrame(row, LOG_SCHEMA).coalesce(1), layer, LOG)

    def _write(self, df: DataFrame, layer: str, table: str, mode: str, partition_by: str | None = None) -> None:
        if partition_by:
            # one writer per period, except that a period too large for one task is split at run time
            df = df.hint("rebalance", partition_by)
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        if self.root is None:
            # kept with the table: later overwrites replace the partitions that they have rows of
            writer.format("parquet").option("partitionOverwriteMode", "dynamic").saveAsTable(self.name(layer, table))
        else:
            writer.option("partitionOverwriteMode", "static").parquet(self.path(layer, table))


def stamp_text(stamp: dt.datetime) -> str:
    return stamp.isoformat(sep=" ", timespec="microseconds")
