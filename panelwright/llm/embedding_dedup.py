"""Near-duplicate vectors by Euclidean p-stable hashing.

A hash projects the unit vector onto a random normal direction, shifts it and cuts the line into cells; a table joins
the cells of several hashes. Vectors in the same bucket of any table are compared by their exact cosine, in double
precision, as blocks of a matrix product. At the default parameters a pair at the threshold of 0.9 meets in some table
with a probability of 0.99, one at 0.95 with 0.9999; more tables raise both.

Equal vectors are one node with a weight. A pair is counted in the first table in which it meets, so links are counted
without being listed; for the components a block passes on one link per vector. A bucket above the block size is cut
into blocks, and pairs of blocks are spread over tasks.

Cases: a vector that is null, empty, zero, or holds null or non-finite values links with nothing. Vectors of different
lengths never link. Rows that repeat are copies and link; ids may be null or repeat, and a component's id is its smallest
that is not null. Extra columns take no part. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import column, cut, groups
from .components import components

TABLES, HASHES, CELL, BLOCK, SEED = 53, 14, 2.2, 1024, 7


def _directions(size: int, tables: int, hashes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    draw = np.random.default_rng([SEED, size])
    return (draw.standard_normal((size, tables * hashes)), draw.uniform(0, CELL, tables * hashes),
            draw.integers(1 << 62, size=hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1))


def _keyed(tables: int, hashes: int):
    """(id, node, vector, buckets) per row; node is null for vectors that can't be compared."""
    known: dict[int, tuple] = {}

    def run(batches):
        for batch in batches:
            nodes, vectors, buckets = ([None] * batch.num_rows for _ in range(3))
            by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
            for i, values in enumerate(batch.column("vector").to_pylist()):
                if values and None not in values:
                    v = np.array(values, np.float64) + 0.0  # no negative zeros
                    if np.isfinite(v).all() and v.any():
                        by_size.setdefault(len(v), []).append((i, v))
            for size, rows in by_size.items():
                if size not in known:
                    known[size] = _directions(size, tables, hashes)
                directions, shifts, odd = known[size]
                all_ = np.stack([v for _, v in rows])
                scaled = all_ / np.abs(all_).max(axis=1, keepdims=True)  # no overflow in the norm
                unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
                cells = np.floor((unit @ directions + shifts) / CELL).astype(np.int64).astype(np.uint64)
                keys = (cells.reshape(len(rows), tables, hashes) * odd).sum(axis=2, dtype=np.uint64) + np.uint64(size)
                keys ^= keys >> np.uint64(33)
                keys = (keys * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(32)).astype(np.uint32)
                for (i, v), u, k in zip(rows, unit, keys):
                    nodes[i], vectors[i], buckets[i] = xxhash.xxh3_128_digest(v.tobytes()), u.tobytes(), k.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(x, pa.binary()) for x in (nodes, vectors, buckets))], ["id", "node", "vector", "buckets"])
    return run


def _block_links(linked: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each row by links within the block."""
    label = np.arange(len(linked))
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label)))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _compare(threshold: float):
    def run(batches):
        out: list[tuple] = []

        def batch():
            columns = list(zip(*out)) if out else [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.binary(), pa.binary(), pa.int64()])], ["node", "root", "n"])

        for (table, _, i, j), rows in groups(batches, ["table", "bucket", "i", "j"]):
            if len(rows) > 1:
                size = len(rows[0]["vector"])
                rows = [r for r in rows if len(r["vector"]) == size] if any(len(r["vector"]) != size for r in rows) else rows
                unit = np.frombuffer(b"".join(r["vector"] for r in rows), np.float64).reshape(len(rows), -1)
                linked = unit @ unit.T >= threshold
                np.fill_diagonal(linked, False)
                if i != j:
                    block = np.array([r["block"] for r in rows])
                    linked &= block[:, None] != block[None, :]
                a, b = np.nonzero(linked)
                if not len(a):
                    continue
                weight = np.array([r["weight"] for r in rows])
                keys = np.frombuffer(b"".join(r["buckets"] for r in rows), np.uint32).reshape(len(rows), -1)[:, :table]
                n = np.zeros(len(rows), np.int64)
                for at in range(0, len(a), 1 << 18):
                    x, y = a[at: at + (1 << 18)], b[at: at + (1 << 18)]
                    first = ~(keys[x] == keys[y]).any(axis=1)
                    n += np.bincount(x[first], weights=weight[y[first]], minlength=len(rows)).astype(np.int64)
                root = _block_links(linked)
                out.extend((r["node"], rows[k]["node"], m) for r, k, m, own in zip(rows, root.tolist(), n.tolist(), range(len(rows))) if m or k != own)
                if len(out) > 50_000:
                    yield batch()
                    out.clear()
        yield batch()
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9,
                    tables: int = TABLES, hashes: int = HASHES) -> DataFrame:
    """Per row: id, n_links (other rows linked directly), component_id and kept."""
    given = vectors.select(column(id_col).alias("id"), column(vector_col).alias("vector"))
    kind = given.schema["id"].dataType.simpleString()
    rows = cut(given.mapInArrow(_keyed(tables, hashes), f"id {kind}, node binary, vector binary, buckets binary"))
    nodes = cut(rows.where("node is not null").groupBy("node").agg(
        F.min("id").alias("least"), F.count("*").alias("weight"), F.max("vector").alias("vector"), F.max("buckets").alias("buckets")))
    # Only names are dealt into buckets; vectors are fetched for the places that are shared.
    in_tables = nodes.select("node", F.posexplode(F.array(*[F.substring("buckets", 4 * t + 1, 4) for t in range(tables)])).alias("table", "bucket"))
    large = in_tables.groupBy("table", "bucket").agg(F.count("*").alias("size")).where(F.col("size") > 1).select(
        "table", "bucket", F.ceil(F.col("size") / BLOCK).cast("long").alias("blocks"))
    dealt = cut(in_tables.join(large, ["table", "bucket"])).withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")).select(
        "table", "bucket", "node", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    dealt = dealt.join(nodes.select("node", "weight", "vector", "buckets"), "node")
    met = dealt.repartition("table", "bucket", "i", "j").sortWithinPartitions("table", "bucket", "i", "j")
    links = cut(met.mapInArrow(_compare(threshold), "node binary, root binary, n bigint"))
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = nodes.select("node", "least", "weight").join(counts, "node", "left").join(roots, "node", "left").withColumn(
        "comp", F.coalesce("root", "node"))
    ids = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    per_node = named.join(ids, "comp").select(
        "node", "component_id", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    out = rows.select("id", "node").join(per_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
