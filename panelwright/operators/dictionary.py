"""Numbers for members that stay the same as members are added."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Fixed value: the number of the member for what is not assigned.
NOT_ASSIGNED = 99
#: New members are counted in so many parts; a number is the part's offset plus the place in the part.
PARTS = 256


def unseen(members: DataFrame, known: DataFrame | None, key: str) -> DataFrame:
    """The different members that have no number yet. NULL is no member."""
    new = members.select(key).where(F.col(key).isNotNull()).distinct()
    return new if known is None else new.join(known.select(key), key, "left_anti")


def last_number(known: DataFrame | None, number: str) -> int:
    """The highest number given so far, the one of the missing member aside."""
    if known is None:
        return 0
    return known.where(F.col(number) != NOT_ASSIGNED).agg(F.max(number)).first()[0] or 0


def numbered(new: DataFrame, key: str, number: str, after: int = 0) -> DataFrame:
    """New members with the numbers that follow ``after``, NOT_ASSIGNED left out.

    Members are dealt into parts by hash and numbered in each; the offsets are the running sums of the parts' sizes, a
    list of ``PARTS`` rows. So no task sees all members, and the same members get the same numbers on a rerun.
    """
    dealt = new.select(key, F.pmod(F.xxhash64(key), F.lit(PARTS)).alias("_part"))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_part").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    rank = F.lit(after - (after > NOT_ASSIGNED)) + F.col("_offset") + F.col("_place")
    return (
        dealt.withColumn("_place", place)
        .join(F.broadcast(offsets), F.col("_part") == F.col("_of"))  # PARTS rows
        .select(key, (rank + (rank >= NOT_ASSIGNED).cast("int")).cast("int").alias(number))
    )


def extended(members: DataFrame, known: DataFrame | None, key: str, number: str) -> DataFrame:
    """The rows to add to a dictionary so that it has all members."""
    return numbered(unseen(members, known, key), key, number, last_number(known, number))


def number_of(rows: DataFrame, known: DataFrame, key: str, number: str, column: str | None = None) -> DataFrame:
    """Rows with the number of their member in ``number``; NOT_ASSIGNED for one that has none."""
    looked_up = known.select(F.col(key).alias("_member"), F.col(number).alias("_number"))
    return (
        rows.join(looked_up, F.col(column or key) == F.col("_member"), "left")
        .withColumn(number, F.coalesce("_number", F.lit(NOT_ASSIGNED)))
        .drop("_member", "_number")
    )
