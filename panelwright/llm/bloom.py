"""A Bloom filter of 64-bit hashes, of bounded size, that tasks ask before they send a row on."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Bits for a hash, the fewest and the most in a filter (64 MiB). Beyond that more rows pass; a join behind it drops them.
BITS, LEAST, MOST = 16, 1 << 16, 1 << 29
SEGMENTS = 64


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    last = np.uint64(bits - 1)
    return (hashes >> np.uint64(58)).astype(np.int64) * bits, (hashes & last).astype(np.int64), ((hashes >> np.uint64(29)) & last).astype(np.int64)


def _fill(bits: int):
    """The bits of each segment; rows come sorted by segment."""
    def fill(batches):
        segment, filled = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([segment], pa.int64()), pa.array([np.packbits(filled, bitorder="little").tobytes()], pa.binary())],
                                              ["segment", "bits"])

        for batch in batches:
            hashes = batch.column(0).to_numpy().view(np.uint64)
            of = (hashes >> np.uint64(58)).astype(np.int64)
            for at in np.unique(of).tolist():
                if at != segment:
                    if segment is not None:
                        yield done()
                    segment, filled = at, np.zeros(bits, np.uint8)
                _, p, q = _places(hashes[of == at], bits)
                filled[p] = filled[q] = 1
        if segment is not None:
            yield done()
    return fill


class BloomFilter:
    """The hashes in a column of long integers, which may repeat; broadcast."""

    def __init__(self, rows: DataFrame, key: str):
        count, total = rows.count(), LEAST
        while total < min(MOST, BITS * count):
            total *= 2
        self.bits = total // SEGMENTS
        segment = F.shiftrightunsigned(F.col("key"), 58)
        filled = (rows.select(F.col(key).alias("key")).repartition(SEGMENTS, segment).sortWithinPartitions(segment)
                  .mapInArrow(_fill(self.bits), "segment long, bits binary"))
        whole = np.zeros(total // 8, np.uint8)
        for row in filled.toLocalIterator():  # at most MOST bits altogether
            part = np.frombuffer(bytes(row["bits"]), np.uint8)
            whole[row["segment"] * len(part): (row["segment"] + 1) * len(part)] = part
        self.shared = rows.sparkSession.sparkContext.broadcast(whole.tobytes())

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may be among them."""
        bitmap = np.frombuffer(self.shared.value, np.uint8)
        base, p, q = _places(hashes, self.bits)
        first, second = base + p, base + q
        return ((bitmap[first >> 3] >> (first & 7).astype(np.uint8)) & (bitmap[second >> 3] >> (second & 7).astype(np.uint8)) & 1).astype(bool)
