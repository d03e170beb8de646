"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight and a schedule: how strongly it is drawn at each moment of training, as a piecewise-linear
curve over [0, 1]. The integral of weight times schedule sets the source's share of all words. Documents of a source
stand in a fixed pseudo-random order; the cumulative words up to a document, inverted through the source's cumulative
demand, give the moment at which the document is trained on. Sorting by that moment by range gives the training order.

A running sum over a source would put the largest source into one task, so it is built from two: sums per hash bucket
of a source (4,096 buckets, so at most that many rows per source), and the running sum inside a bucket. Sources, of which
there may be as many as hosts, are numbered and summed in ranges in the same way.

Cases: a null text has no words and is never taken. Sources are ordered by code point, null last, and null is a source
of its own. Documents without an id, and rows that repeat, each count. Ties in the order are broken by id, size and
text, so reruns agree. An empty table gives an empty mix. Further columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, column, cut, text_or_empty, unpack, whole_row

#: A source is taken three times at most.
MOST = 3
BUCKET_DIGITS = 3
#: By weight, as (moment, strength): the lightest sources fade, the heaviest grow, and the rest stay level. Each curve
#: has the integral 1, so that the schedule moves words in time and leaves the shares as they are.
SCHEDULES = {1: [(0.0, 1.5), (1.0, 0.5)], 2: [(0.0, 1.0), (1.0, 1.0)], 3: [(0.0, 0.5), (0.5, 1.0), (1.0, 1.5)]}


def _schedule(weight: Column, schedules: dict[int, list[tuple[float, float]]]) -> Column:
    """Segments of the curve as structs: start, end, strength at both, area before."""
    out = F.lit(None)
    for w, knots in schedules.items():
        area, parts = 0.0, []
        for (t, a), (u, b) in zip(knots, knots[1:]):
            parts.append(F.struct(*[F.lit(float(v)).alias(n) for n, v in zip("tuabs", (t, u, a, b, area))]))
            area += (u - t) * (a + b) / 2
        out = F.when(weight == w, F.array(*parts)).otherwise(out)
    return out


def area(knots: list[tuple[float, float]]) -> float:
    """A schedule's integral over time."""
    return sum((u - t) * (a + b) / 2 for (t, a), (u, b) in zip(knots, knots[1:]))


def _moment(share: Column, segments: Column, whole: Column) -> Column:
    """The moment by which a share of a source's demand has come: the cumulative demand inverted.

    Within a segment the demand is quadratic in time; the root is taken in the form that also holds for level curves.
    """
    need = share * whole
    seg = F.element_at(F.filter(segments, lambda x: x["s"] <= need), -1)
    rest, slope = need - seg["s"], (seg["b"] - seg["a"]) / (seg["u"] - seg["t"])
    root = F.sqrt(F.greatest(seg["a"] * seg["a"] + 2 * slope * rest, F.lit(0.0)))
    return F.least(seg["u"], seg["t"] + F.when(rest > 0, 2 * rest / (seg["a"] + root)).otherwise(F.lit(0.0)))


def _sums_before(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Rows with the sums over all rows that come before them, in two levels: in ranges of the order, and over the sums of
    the ranges, which are as many as there are shuffle partitions. No task sees all rows."""
    dealt = cut(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    whole = dealt.groupBy("_range").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    ranges = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = whole.select(F.col("_range").alias("_of"), *[F.col(n).alias(f"{n}_of") for n in sums]).select(
        "_of", *[F.coalesce(F.sum(f"{n}_of").over(ranges), F.lit(0)).alias(f"{n}_of") for n in sums])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = dealt.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(n) for n, c in sums.items()])
    return within.join(F.broadcast(offsets), F.col("_range") == F.col("_of")).select(
        *rows.columns, *[(F.col(n) + F.col(f"{n}_of")).alias(n) for n in sums])


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources in code-point order, null last, with the weights 1, 2, 3, repeating."""
    rows = _sums_before(sources, [F.col("source").isNull(), F.col("source")], {"_ahead": F.lit(1)})
    return rows.withColumn("weight", (F.col("_ahead") % 3 + 1).cast("long")).drop("_ahead")


def targets(sources: DataFrame, schedules: dict[int, list[tuple[float, float]]] = SCHEDULES) -> DataFrame:
    """From (source, source_size): the weight and the target of each source.

    The sources share all words by weight times the schedule's integral. A target stops at three times its source; what
    is above is shared again among the others. In the order of size per weight the sources that stop come first, so
    running sums tell them apart without repeating.
    """
    integral = F.lit(0.0)
    for w, knots in schedules.items():
        integral = F.when(F.col("weight") == w, F.lit(area(knots))).otherwise(integral)
    rows = _numbered(sources).withColumn("_w", F.col("weight") * integral).withColumn("_most", MOST * F.col("source_size"))
    order = [F.col("_most") / F.col("_w"), F.col("source").isNull(), F.col("source")]
    rows = _sums_before(rows, order, {"_given": F.col("_most"), "_used": F.col("_w")})
    both = rows.agg(F.struct(F.sum("source_size").alias("words"), F.sum("_w").alias("weights"))).scalar()
    rows = rows.withColumn("_all", both)
    stops = (F.col("_all.words") - F.col("_given")) * F.col("_w") > F.col("_most") * (F.col("_all.weights") - F.col("_used"))
    rows = cut(rows.withColumn("_stops", stops))
    left = rows.agg(F.struct(F.sum(F.when(F.col("_stops"), F.col("_most")).otherwise(0)).alias("full"),
                             F.sum(F.when(F.col("_stops"), 0.0).otherwise(F.col("_w"))).alias("open"))).scalar()
    rows = rows.withColumn("_left", left)
    level = F.when(F.col("_left.open") > 0, (F.col("_all.words") - F.col("_left.full")) / F.col("_left.open")).otherwise(F.lit(0.0))
    target = F.when(F.col("_stops"), F.col("_most").cast("double")).otherwise(level * F.col("_w"))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def placed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           schedules: dict[int, list[tuple[float, float]]] = SCHEDULES, carry: bool = True) -> DataFrame:
    """Per document: ``doc``, size, source, source_size, weight, target, and ``_before``, the words of its source ahead
    of it. With ``carry`` the struct holds the whole row, else the id alone."""
    text = text_or_empty(text_col)
    row = whole_row(docs) if carry else F.struct(column(id_col).alias(id_col)).alias("doc")
    key = F.md5(F.coalesce(column(id_col).cast("string"), F.lit("")))
    sized = docs.select(row, column(source_col).cast("string").alias("source"), _words(text).alias("size"), key.alias("_key"),
                        column(id_col).alias("_id"), F.xxhash64(text).alias("_tie"))
    sized = sized.withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    buckets = cut(sized.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum")))
    by_source = Window.partitionBy("source").orderBy("_bucket")
    ahead = buckets.select("source", "_bucket", (F.sum("_sum").over(by_source) - F.col("_sum")).alias("_ahead"))
    goal = targets(buckets.groupBy("source").agg(F.sum("_sum").alias("source_size")), schedules)
    per_bucket = ahead.alias("a").join(goal.alias("g"), F.col("a.source").eqNullSafe(F.col("g.source"))).select(
        "a.source", "a._bucket", "a._ahead", "g.source_size", "g.weight", "g.target")
    inside = Window.partitionBy("source", "_bucket").orderBy("_key", "_id", "size", "_tie")
    running = sized.withColumn("_inside", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    return running.alias("d").join(
        per_bucket.alias("b"),
        F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d._bucket") == F.col("b._bucket"))).select(
        "d.doc", "d.source", "d.size", "b.source_size", "b.weight", "b.target",
        (F.col("b._ahead") + F.col("d._inside")).alias("_before"))


def taken(rows: DataFrame, whole_documents: bool = False,
          schedules: dict[int, list[tuple[float, float]]] = SCHEDULES) -> DataFrame:
    """How often and how far each document is taken, and when first.

    A source is gone through in whole passes, then in order until its target is met. The document at that end is taken
    in part, so that the target is met to the word; with ``whole_documents`` it is taken if its middle is within.
    """
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rows = rows.withColumn("passes", passes)
    rest = F.floor(F.col("target")).cast("long") - F.col("passes") * F.col("source_size")
    if whole_documents:
        inside = (2 * F.col("_before") + F.col("size") <= 2 * rest) & (F.col("size") > 0)
        last = F.when(inside, F.col("size")).otherwise(F.lit(0))
    else:
        last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before")))
    rows = rows.withColumn("last_words", last.cast("long"))
    rows = rows.withColumn("taken", F.col("passes") * F.col("size") + F.col("last_words"))
    whole = F.lit(1.0)
    for w, knots in schedules.items():
        whole = F.when(F.col("weight") == w, F.lit(area(knots))).otherwise(whole)
    first = F.when(F.col("passes") > 0, F.col("size")).otherwise(F.col("last_words"))
    share = (F.col("_before") + first / 2) / F.col("target")
    moment = F.when((F.col("taken") > 0) & (F.col("target") > 0), _moment(F.least(share, F.lit(1.0)), _schedule(F.col("weight"), schedules), whole))
    return rows.withColumn("position", moment)


def drawn(rows: DataFrame, schedules: dict[int, list[tuple[float, float]]] = SCHEDULES) -> DataFrame:
    """A row for each time that rows of ``taken`` are taken: ``_pass`` from 0, ``_words`` taken then, and ``_moment``, at
    which the middle of these words is trained on. The first moment of a document is its position."""
    times = (F.col("passes") + (F.col("last_words") > 0).cast("long")).cast("int")
    rows = rows.where((times > 0) & (F.col("size") > 0)).select(
        "*", F.explode(F.sequence(F.lit(0), times - 1)).alias("_pass"))
    rows = rows.withColumn("_words", F.when(F.col("_pass") < F.col("passes"), F.col("size")).otherwise(F.col("last_words")))
    whole = F.lit(1.0)
    for w, knots in schedules.items():
        whole = F.when(F.col("weight") == w, F.lit(area(knots))).otherwise(whole)
    share = (F.col("_pass") * F.col("source_size") + F.col("_before") + F.col("_words") / 2) / F.col("target")
    return rows.withColumn("_moment", _moment(F.least(share, F.lit(1.0)), _schedule(F.col("weight"), schedules), whole))


def in_order(rows: DataFrame, *order: str | Column, partitions: int | None = None) -> DataFrame:
    """The rows sorted over all partitions, dealt by ranges."""
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        schedules: dict[int, list[tuple[float, float]]] = SCHEDULES, partitions: int | None = None) -> DataFrame:
    """The mixed documents in training order, a row for each time a document is taken, with the columns they came with.

    Whole documents only. The rows are range-partitioned and sorted by their moment.
    """
    rows = taken(placed(docs, id_col, text_col, source_col, schedules), whole_documents=True, schedules=schedules)
    rows = drawn(rows, schedules)
    order = ["_moment", F.col("doc")[id_col].cast("string"), "_pass"]
    return in_order(rows, *order, partitions=partitions).select(*unpack("doc", docs.columns))
