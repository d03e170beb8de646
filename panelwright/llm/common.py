"""What the operators share: opening tables, carrying rows along, the checkpoint folder, word patterns."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_folder

#: Words are runs of anything but the six ASCII white-space characters.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame, name: str = "doc") -> Column:
    """All columns as one struct, so that an operator's own column names can't clash with them."""
    return F.struct(*[column(c) for c in df.columns]).alias(name)


def unpack(name: str, columns: list[str], **replaced: Column) -> list[Column]:
    """The columns of a struct made by whole_row, some of them replaced."""
    return [replaced[c].alias(c) if c in replaced else F.col(name)[c].alias(c) for c in columns]


def text_or_empty(name: str) -> Column:
    return F.coalesce(column(name).cast("string"), F.lit(""))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Have somewhere to checkpoint: the folder that the session names. A local session without one gets a temporary folder;
    on a cluster that is an error, as executors don't share such folders."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, without their lineage; they outlive a lost executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def groups(batches, keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows that follow each other with the same key. A key's rows are few: callers split large keys beforehand."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            this = tuple(row[k] for k in keys)
            if this != key:
                if rows:
                    yield key, rows
                key, rows = this, []
            rows.append(row)
    if rows:
        yield key, rows
