"""Line deduplication with two Bloom filters.

A first look hashes every line and fills two filters: one of hashes seen once, one of hashes seen again. The filters are
cut into segments by hash, so no machine holds the first filter: tasks send each segment's owner the distinct hashes
they met (eight bytes a line), and the owner sets the bits. Only the second filter, which holds repeated lines alone, is
broadcast, folded to at most ``most_filter_bytes``. A second look sends on the lines that hit it. These suspects are
confirmed exactly, by their SHA-256 and the number of distinct documents, and the confirmed ones leave the documents.
A false hit costs one row in a shuffle and never changes the result.

Cases: a null or empty text is one empty line; empty keys never repeat. Rows that share an id (or have none) are one
document in the counts, and each of them loses the lines. Extra columns are carried in ``doc``. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import column, cut, text_or_empty, unpack, whole_row

WHITE = b" \t\n\x0b\x0c\r"
SEGMENT_BITS = 10
#: Filter bits for each distinct line that a task met, and the fewest in a segment.
BITS_PER_LINE, LEAST_BITS = 12, 1 << 10
HASHES_HELD = 1 << 20
DOCUMENTS_AT_ONCE = 256


def key_of(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z in lower case."""
    return line.strip(WHITE).lower()


def _keys(raw: bytes) -> set[bytes]:
    keys = {line.strip(WHITE) for line in raw.lower().split(b"\n")}
    keys.discard(b"")
    return keys


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, DOCUMENTS_AT_ONCE):
        yield batch.slice(at, DOCUMENTS_AT_ONCE)


def _packed(hashes: list[int]) -> pa.RecordBatch:
    distinct, times = np.unique(np.array(hashes, np.uint64), return_counts=True)
    again = distinct[times > 1]
    starts = np.arange(1, 1 << SEGMENT_BITS, dtype=np.uint64) << np.uint64(64 - SEGMENT_BITS)
    all_, more = np.split(distinct, np.searchsorted(distinct, starts)), np.split(again, np.searchsorted(again, starts))
    held = [i for i, x in enumerate(all_) if len(x)]
    return pa.RecordBatch.from_arrays(
        [pa.array(held, pa.int32()), pa.array([len(all_[i]) for i in held], pa.int64()),
         pa.array([all_[i].tobytes() for i in held], pa.binary()), pa.array([more[i].tobytes() for i in held], pa.binary())],
        ["segment", "n", "seen", "seen_again"])


def _first_look(batches):
    """Per task and segment: the distinct hashes of its lines, and those found in two of its documents."""
    hashes: list[int] = []
    for batch in batches:
        for raw in batch.column(0):
            hashes.extend(map(xxhash.xxh3_64_intdigest, _keys(raw.as_py())))
            if len(hashes) >= HASHES_HELD:
                yield _packed(hashes)
                hashes = []
    if hashes:
        yield _packed(hashes)


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    last = np.uint64(bits - 1)
    return (hashes & last).astype(np.int64), ((hashes >> np.uint64(27)) & last).astype(np.int64)


def _owner(bits: int, folded: int):
    """Fill both filters of each segment from what the tasks sent; give the second one."""
    def fill(batches):
        segment, once, twice = None, None, None

        def done():
            small = twice.reshape(-1, folded).max(axis=0)
            return pa.RecordBatch.from_arrays(
                [pa.array([segment], pa.int32()), pa.array([np.packbits(small, bitorder="little").tobytes()], pa.binary())],
                ["segment", "bits"])

        for batch in batches:
            for at, seen, again in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if at != segment:
                    if segment is not None:
                        yield done()
                    segment, once, twice = at, np.zeros(bits, np.uint8), np.zeros(bits, np.uint8)
                p, q = _places(np.frombuffer(seen, np.uint64), bits)
                known = (once[p] & once[q]) == 1
                twice[p[known]] = twice[q[known]] = 1
                once[p] = once[q] = 1
                p, q = _places(np.frombuffer(again, np.uint64), bits)
                twice[p] = twice[q] = 1
        if segment is not None:
            yield done()
    return fill


def _second_look(filters, bits: int):
    """(row's id, digest, first line) of each distinct line whose hash is in the second filter."""
    def probe(batches):
        bitmap = np.frombuffer(filters.value, np.uint8)
        for whole in batches:
            for batch in _slices(whole):
                rows, keys = [], []
                for i, raw in enumerate(batch.column(1)):
                    mine = _keys(raw.as_py())
                    keys.extend(mine)
                    rows.extend([i] * len(mine))
                h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
                base = (h >> np.uint64(64 - SEGMENT_BITS)).astype(np.int64) * bits
                hit = np.ones(len(h), bool)
                for p in _places(h, bits):
                    p = base + p
                    hit &= (bitmap[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
                found = np.flatnonzero(hit)
                digests = [hashlib.sha256(keys[j]).digest() for j in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.array(rows, np.int64)[found] if len(found) else [], pa.int64())),
                     pa.array(digests, pa.binary())], ["id", "digest"])
    return probe


def _power_of_two(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, n)))))


def suspects(docs: DataFrame, id_col: str, text_col: str, most_filter_bytes: int) -> DataFrame:
    """(id, digest) of every line that may repeat, once per row."""
    spark = docs.sparkSession
    raw = docs.select(text_or_empty(text_col).cast("binary").alias("text"))
    # The hashes are written once: the filter's size follows from their number, and then they fill it.
    sent = cut(raw.mapInArrow(_first_look, "segment int, n bigint, seen binary, seen_again binary"))
    lines = sent.agg(F.sum("n")).first()[0] or 0
    bits = max(LEAST_BITS, _power_of_two(BITS_PER_LINE * lines / (1 << SEGMENT_BITS)))
    bits = min(bits, 1 << 27)
    folded = min(bits, _power_of_two(most_filter_bytes * 8 / (1 << SEGMENT_BITS)))
    owned = sent.repartition("segment").sortWithinPartitions("segment").select("segment", "seen", "seen_again")
    parts = owned.mapInArrow(_owner(bits, folded), "segment int, bits binary").collect()  # most_filter_bytes in all
    bitmap = np.zeros((1 << SEGMENT_BITS, folded // 8), np.uint8)
    for part in parts:
        bitmap[part["segment"]] = np.frombuffer(part["bits"], np.uint8)
    filters = spark.sparkContext.broadcast(bitmap.tobytes())
    keyed = docs.select(column(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("text"))
    kind = keyed.schema["id"].dataType.simpleString()
    return keyed.mapInArrow(_second_look(filters, folded), f"id {kind}, digest binary")


def _drop(batches):
    """The lines that stay; a key in ``later`` goes from its second line on."""
    for batch in batches:
        texts, everywhere, later = (batch.column(n) for n in ("text", "everywhere", "later"))
        kept, lines, dropped = [], [], []
        for i in range(batch.num_rows):
            raw = texts[i].as_py()
            gone, once = everywhere[i].as_py() or (), later[i].as_py() or ()
            if not gone and not once:
                kept.append(raw)
                lines.append(raw.count(b"\n") + 1)
                dropped.append(0)
                continue
            gone, once, left = set(gone), set(once), []
            all_lines = raw.split(b"\n")
            for line in all_lines:
                digest = hashlib.sha256(key_of(line)).digest()
                if digest in gone:
                    continue
                if digest in once:
                    gone.add(digest)
                left.append(line)
            kept.append(b"\n".join(left))
            lines.append(len(all_lines))
            dropped.append(len(all_lines) - len(left))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()),
             pa.array(dropped, pa.int64())], ["doc", "kept_text", "n_lines", "n_dropped"])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2, keep: str = "none",
          most_filter_bytes: int = 64 << 20) -> DataFrame:
    """``doc`` (the row as it came), ``kept_text``, ``n_lines`` before and ``n_dropped``.

    Lines found in at least ``min_docs`` (two or more) documents are dropped in all of them, or with ``keep="first"``
    stay once, in the document with the smallest id.
    """
    if min_docs < 2 or keep not in ("none", "first"):
        raise ValueError("min_docs is 2 or more, keep is none or first")
    found = cut(suspects(docs, id_col, text_col, most_filter_bytes))
    # Written, so that the join exchanges both sides and Spark can split a line that a third of the documents have.
    confirmed = cut(found.groupBy("digest").agg(
        F.count_distinct(F.struct("id")).alias("n"), F.min(F.struct("id")).alias("first")).where(F.col("n") >= min_docs))
    first = (F.col("f.id").eqNullSafe(F.col("c.first.id"))) if keep == "first" else F.lit(False)
    lines = found.alias("f").join(confirmed.alias("c"), "digest").select("f.id", "digest", first.alias("stays"))
    per_doc = lines.groupBy("id").agg(
        F.collect_set(F.when(~F.col("stays"), F.col("digest"))).alias("everywhere"),
        F.collect_set(F.when(F.col("stays"), F.col("digest"))).alias("later"))
    rows = docs.select(whole_row(docs), column(id_col).alias("_id"), text_or_empty(text_col).cast("binary").alias("text"))
    joined = rows.join(per_doc, F.col("_id").eqNullSafe(F.col("id")), "left").select("doc", "text", "everywhere", "later")
    return joined.mapInArrow(_drop, StructType([
        joined.schema["doc"], StructField("kept_text", StringType()), StructField("n_lines", LongType()),
        StructField("n_dropped", LongType())]))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without their repeated lines, with the columns they came with."""
    rows = dedup(docs, id_col, text_col, **options)
    return rows.select(*unpack("doc", docs.columns, **{text_col: F.col("kept_text")}))
