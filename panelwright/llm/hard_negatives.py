"""Hard negatives by a vertical scan of the dimensions (BOND).

Rows are dealt into blocks that hold their vectors by dimension, with the least and greatest value of each. All anchors
visit every block. An anchor reads the dimensions in descending order of its own magnitudes: after each few of them, a
candidate's score lies between what it has so far plus the least and plus the most that the unread dimensions can add, and
candidates that can no longer matter leave the bitmap. Two such searches run:

1. positives: the candidates share the anchor's label; those that can't reach the best few leave;
2. negatives: the candidates have other labels. The scores of the positives make exact windows, and a candidate leaves as
   soon as it lies outside each window, or is certain to come after enough others in each.

What remains at the last dimension has exact integer scores. Blocks keep their best few per anchor (per anchor and
positive), and a window over those picks the final ones. A task holds one block and a batch of anchors, whatever the
number of rows; labels play no part in dealing, so that a label with most of the rows changes nothing.

Cases: rows without an id, label or vector, and vectors with a null or non-finite component, take no part; nor do vectors
of another length than the anchor's, for that anchor. Rows that repeat in id, label and vector count once; rows that share
an id only are different rows. Ties in score go to the smaller id. A window below zero is empty, as its lower bound exceeds
its upper. Components beyond 64 bits are taken as the greatest such number; sums are exact at any size, and scores beyond 64
bits are shown as the greatest. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import column, cut

#: Rows in a block, dimensions read between two looks at the bounds, anchors in an Arrow batch.
BLOCK, STEP, ANCHORS = 8192, 8, 256
#: Sums of products below this are exact in doubles.
EXACT = 2.0**52
LONGS = 2**63 - 1


def eligible(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``id``, ``label`` (as text) and ``v``, the vector as whole numbers."""
    v = F.transform(column(vector_col), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(column(id_col).cast("long").alias("id"), column(label_col).cast("string").alias("label"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite
    ).withColumn("v", F.transform("v", lambda x: F.floor(x * scale))).dropDuplicates(["id", "label", "v"])


class Block:
    """Vectors of one length, by dimension."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches)
        self.rows, self.ids = (table[c].to_numpy() for c in ("row", "id"))
        self.codes: dict[str, int] = {}
        self.labels = np.array([self.codes.setdefault(x, len(self.codes)) for x in table["label"].to_pylist()])
        self.dims = _matrix(table["v"].combine_chunks(), len(self.rows)).T.copy()
        self.low, self.high = (f(axis=1) if self.dims.size else np.zeros(len(self.dims)) for f in (self.dims.min, self.dims.max))

    def scan(self, anchor: np.ndarray, alive: np.ndarray, leave) -> tuple[np.ndarray, np.ndarray]:
        """The candidates that are left at the end, and their scores. ``leave`` gets the bounds of all that are alive and
        says which of them stay."""
        if self.dims.dtype == object or anchor.dtype == object or (
                self.dims.size and float(np.abs(anchor).max()) * max(float(-self.low.min()), float(self.high.max())) * len(anchor) >= EXACT):
            dims, anchor = self.dims.astype(object), np.array([int(x) for x in anchor], dtype=object)
        else:
            dims, anchor = self.dims, anchor.astype(float)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.low, anchor * self.high])
        least, most = ends.min(axis=0)[order], ends.max(axis=0)[order]
        # what the dimensions from each place on can add
        rest_least, rest_most = (np.append(np.cumsum(x[::-1])[::-1], 0) for x in (least, most))
        score = np.zeros(len(alive), dtype=dims.dtype)
        for at in range(0, len(order), STEP):
            read = order[at: at + STEP]
            score = score + anchor[read] @ dims[np.ix_(read, alive)]
            done = min(at + STEP, len(order))
            stay = leave(score + rest_least[done], score + rest_most[done], self.ids[alive])
            if not stay.all():
                alive, score = alive[stay], score[stay]
            if not len(alive):
                break
        return alive, score


def _matrix(vectors: pa.ListArray, n: int) -> np.ndarray:
    """Doubles where these hold the numbers exactly, Python's integers otherwise."""
    flat = vectors.flatten().to_numpy()
    if flat.size and (flat.max() >= 2**40 or flat.min() <= -(2**40)):
        return np.array([int(x) for x in flat], dtype=object).reshape(n, -1)
    return flat.astype(float).reshape(n, len(flat) // n if n else 0)


def _kth(values: np.ndarray, k: int):
    """The k-th greatest value, or None if there are fewer."""
    if len(values) < k:
        return None
    return sorted(values, reverse=True)[k - 1] if values.dtype == object else np.partition(values, len(values) - k)[len(values) - k]


def _first(ids: np.ndarray, score: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The first k by descending score and ascending id."""
    if score.dtype == object:
        best = sorted(range(len(ids)), key=lambda i: (-score[i], ids[i]))[:k]
    else:
        best = np.lexsort((ids, -score))[:k]
    return [(int(ids[i]), int(score[i])) for i in best]


def _visits(batches) -> Iterator[tuple[Block, pa.RecordBatch]]:
    """A block with each batch of anchors; within a key the block's rows come first, so that anchors only pass by."""
    key, held, block = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("block", "length", "anchor")])
        edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for lo, hi in zip([0, *edges], [*edges, batch.num_rows]):
            if (this := tuple(keys[:2, lo])) != key:
                key, held, block = this, [], None
            piece = batch.slice(lo, hi - lo)
            if not keys[2, lo]:
                held.append(piece)
            elif held:
                block = block or Block(held)
                for at in range(0, piece.num_rows, ANCHORS):
                    yield block, piece.slice(at, ANCHORS)


def _positives(k: int):
    def search(batches):
        for block, anchors in _visits(batches):
            out = []
            for row, label, v in _anchors(anchors):
                alive = np.flatnonzero((block.labels == block.codes.get(label, -1)) & (block.rows != row))

                def leave(lower, upper, ids):
                    least = _kth(lower, k)
                    return np.ones(len(lower), bool) if least is None else np.asarray(upper >= least, bool)

                alive, score = block.scan(v, alive, leave)
                out += [(row, i, min(max(s, -LONGS), LONGS), s) for i, s in _first(block.ids[alive], score, k)]
            yield _batch(out, ["row", "id", "score", "exact"])
    return search


def _negatives(k: int, low: int):
    def search(batches):
        for block, anchors in _visits(batches):
            out = []
            wanted = anchors.column("positives").to_pylist()
            for (row, label, v), positives in zip(_anchors(anchors), wanted):
                tops = sorted({int(p["exact"]) for p in positives}, reverse=True)
                floors = [-(-low * p // 100) for p in tops]
                alive = np.flatnonzero(block.labels != block.codes.get(label, -1))

                def leave(lower, upper, ids):
                    stay = np.zeros(len(lower), bool)
                    for top, floor in zip(tops, floors):
                        can = np.asarray((upper >= floor) & (lower <= top), bool)
                        sure = _kth(lower[np.asarray(upper <= top, bool)], k)
                        stay |= can if sure is None else can & np.asarray(upper >= sure, bool)
                    return stay

                alive, score = block.scan(v, alive, leave)
                ids = block.ids[alive]
                best = {}
                for top, floor in zip(tops, floors):
                    inside = np.asarray((score <= top) & (score >= floor), bool)
                    best[top] = _first(ids[inside], score[inside], k)
                out += [(row, p["place"], i, min(max(s, -LONGS), LONGS), s) for p in positives for i, s in best[int(p["exact"])]]
            yield _batch(out, ["row", "place", "id", "score", "exact"])
    return search


def _anchors(batch: pa.RecordBatch):
    vectors = batch.column("v")
    flat, ends = vectors.flatten().to_numpy(), vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
    for i, (row, label) in enumerate(zip(batch.column("row").to_pylist(), batch.column("label").to_pylist())):
        v = flat[ends[i]: ends[i + 1]]
        yield row, label, np.array([int(x) for x in v], dtype=object) if v.size and np.abs(v.astype(float)).max() >= 2.0**40 else v.astype(float)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Exact scores travel as text, as they may be longer than 64 bits."""
    kinds = {"exact": pa.string(), "place": pa.int32()}
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array([str(x) for x in c] if n == "exact" else c, kinds.get(n, pa.int64())) for n, c in zip(names, columns)], names)


def _ranked(found: DataFrame, by: list[str], name: str, k: int) -> DataFrame:
    """The first k of each key; scores are compared by their sign, length and digits where they exceed 64 bits."""
    sign = F.when(F.col("exact").startswith("-"), -1).otherwise(1)
    order = [F.col("score").desc(), (sign * F.length("exact")).desc(),
             F.when(sign > 0, F.col("exact")).desc_nulls_last(), F.when(sign < 0, F.col("exact")).asc_nulls_last(), "id"]
    return found.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= k)


def mine(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 5, low: int = 80, scale: int = 256, block: int = BLOCK) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    ``anchors`` is a condition over ``id`` and ``label``. The positives of an anchor are its first rows of the same label;
    a negative has another label and a score of ``low`` percent of the positive's at least, and the positive's at most.
    """
    points = cut(eligible(rows, id_col, vector_col, label_col, scale).select(F.monotonically_increasing_id().alias("row"), "*"))
    blocks = max(1, -(-points.count() // block))
    asked = points.where(anchors)
    dealt = points.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), F.size("v").alias("length"),
                          F.lit(0).alias("anchor"), "row", "id", "label", "v")

    def visit(who: DataFrame, search, schema: str) -> DataFrame:
        """Every anchor in every block."""
        extra = [c for c in who.columns if c not in points.columns]
        guests = who.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.size("v").alias("length"),
                            F.lit(1).alias("anchor"), "row", "id", "label", "v", *extra)
        both = dealt.unionByName(guests, allowMissingColumns=True)
        return both.repartition(blocks, "block").sortWithinPartitions("block", "length", "anchor").mapInArrow(search, schema)

    near = cut(_ranked(visit(asked, _positives(positives), "row long, id long, score long, exact string"), ["row"], "place", positives))
    windows = near.groupBy("row").agg(F.collect_list(F.struct("place", "exact")).alias("positives"))
    found = visit(asked.join(windows, "row"), _negatives(negatives, low), "row long, place int, id long, score long, exact string")
    best = _ranked(found, ["row", "place"], "rank", negatives)
    return best.alias("n").join(near.alias("p"), ["row", "place"]).join(asked.select("row", F.col("id").alias("anchor_id")), "row").select(
        "anchor_id", F.col("p.id").alias("positive_id"), F.col("n.rank").cast("int").alias("rank"), F.col("n.id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score"))
