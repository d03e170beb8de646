"""Removal of passages that repeat anywhere in the corpus, byte by byte, through sparse suffix arrays.

A string of ``length`` bytes contains a smallest 32-byte gram, by hash; equal strings contain the same one at the same
place. So the strings that start next to each other and share their smallest gram, the anchor, travel together as one
run of bytes, about 80 starts in 280 bytes, and strings can only repeat among runs with equal grams. Runs that are equal
as a whole repeat as a whole and are settled by counting. Only grams with different runs need the text: there the two
sides of the anchor are suffix-sorted, deep and shallow, and give the extents that runs share.

Steps: scan texts for runs and count them by (gram, run); scan them again for the runs of undecided grams, each from one
text that Bloom filters tell, and sort those per gram; scan them for the places of all covered runs, and send each text its
places. Texts are exchanged once, at the end. Copies of a text count as one there. A gram with more than
``most_runs`` different runs isn't sorted in one task: its windows are counted by digest instead, which gives the same.

Cases: a null text has no bytes. Rows that repeat are copies of each other, so both lose their passages. Ids may be null.
Extra columns take no part; an empty table gives an empty result. Hashes of 64 bits tell grams apart, runs of a gram, and
texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .bloom import BloomFilter
from .common import column, cut, groups, text_or_empty
from .shingles import _BYTE, _PLACE, mixed, pieces
from .suffix_sort import shared

GRAM, MOST_RUNS, HELD = 32, 20_000, 1 << 19
_POSITION = np.uint64((1 << 24) - 1)
_BLOCK = 1 << 22


def _smallest(grams: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of each ``width`` grams in a row stands, the first of equal ones."""
    out = []
    for at in range(0, len(grams) - width + 1, _BLOCK):
        part = grams[at: at + _BLOCK + width - 1]
        low = (part & ~_POSITION) | np.arange(len(part), dtype=np.uint64)
        covered = 1
        while 2 * covered <= width:
            low = np.minimum(low[:-covered], low[covered:])
            covered *= 2
        if covered < width:
            low = np.minimum(low[: len(low) - (width - covered)], low[width - covered:])
        out.append((low & _POSITION).astype(np.int64) + at)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _runs(column: pa.Array, length: int):
    """(first row, bytes, offsets, grams, row, start, end, anchor) for pieces of the column; a run has the bytes from its
    first string's start to its last one's end."""
    for row, data, offsets in pieces(column):
        none = np.zeros(0, np.int64)
        if len(data) < length:
            yield row, data, offsets, np.zeros(0, np.uint64), none, none, none, none
            continue
        grams = _BYTE[data]
        step = 1
        for j in range(5):  # 32 bytes by doubling
            grams = grams[:-step] * _PLACE[j] + grams[step:]
            step *= 2
        grams = mixed(grams)
        anchors = _smallest(grams, length - GRAM + 1)
        starts = np.arange(len(anchors))
        of = np.searchsorted(offsets, starts, "right") - 1
        valid = np.flatnonzero(starts + length <= offsets[of + 1])
        if not len(valid):
            yield row, data, offsets, np.zeros(0, np.uint64), none, none, none, none
            continue
        new = np.flatnonzero(np.concatenate([[True], (anchors[valid[1:]] != anchors[valid[:-1]]) | (of[valid[1:]] != of[valid[:-1]])]))
        first = valid[new]
        last = valid[np.concatenate([new[1:], [len(valid)]]) - 1]
        yield row, data, offsets, grams[anchors[first]], of[first], first, last + length, anchors[first]


def _digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    view = memoryview(np.ascontiguousarray(data))
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(view[a:b]) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _count(length: int):
    """(gram, run, tid, n) for the runs of all texts, counted over many texts of a task first, so that a common run costs a
    row per half million; ``tid`` is the least text that has it."""
    def run(batches):
        held, size = [], 0

        def flush():
            gram, digest, tid = (np.concatenate([h[j] for h in held]) for j in range(3))
            order = np.lexsort((tid, digest, gram))
            gram, digest, tid = gram[order], digest[order], tid[order]
            first = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (digest[1:] != digest[:-1])]))
            n = np.diff(np.concatenate([first, [len(gram)]]))
            return pa.RecordBatch.from_arrays(
                [_signed(gram[first]), _signed(digest[first]), pa.array(tid[first]), pa.array(n)], ["gram", "run", "tid", "n"])

        for batch in batches:
            tids = batch.column("tid").to_numpy()
            for row, data, _, gram, of, start, end, _ in _runs(batch.column("text"), length):
                if len(gram):
                    held.append((gram, _digests(data, start, end), tids[row + of]))
                    size += len(gram)
                if size >= HELD:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()
    return run


def _one_hash(gram: np.ndarray, run: np.ndarray, tid: np.ndarray) -> np.ndarray:
    """A hash of a run together with a text that has it."""
    return mixed(mixed(gram ^ (run * _PLACE[0])) ^ (tid.view(np.uint64) * _PLACE[1]))


def _named(batches):
    for batch in batches:
        gram, run, tid = (batch.column(c).to_numpy() for c in ("gram", "run", "tid"))
        yield pa.RecordBatch.from_arrays([_signed(_one_hash(gram.view(np.uint64), run.view(np.uint64), tid))], ["key"])


def _fetch(length: int, grams: BloomFilter, only: BloomFilter):
    """The runs of undecided grams from the text that was named for them: their bytes and where the anchor is."""
    def run(batches):
        for batch in batches:
            tids = batch.column("tid").to_numpy()
            for row, data, _, gram, of, start, end, anchor in _runs(batch.column("text"), length):
                asked = np.flatnonzero(grams.has(gram)) if len(gram) else []
                if not len(asked):
                    continue
                gram, of, start, end, anchor = (x[asked] for x in (gram, of, start, end, anchor))
                digest = _digests(data, start, end)
                asked = np.flatnonzero(only.has(_one_hash(gram, digest, tids[row + of])))
                if not len(asked):
                    continue
                gram, digest, start, end, anchor = (x[asked] for x in (gram, digest, start, end, anchor))
                _, first = np.unique(np.stack([gram, digest]), axis=1, return_index=True)
                view = memoryview(np.ascontiguousarray(data))
                held = [bytes(view[a:b]) for a, b in zip(start[first].tolist(), end[first].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [_signed(gram[first]), _signed(digest[first]), pa.array((anchor - start)[first], pa.int32()), pa.array(held, pa.binary())],
                    ["gram", "run", "at", "bytes"])
    return run


def _places(length: int, only: BloomFilter):
    """(gram, run, tid, s, e) for every place in a text of a run whose gram the filter has."""
    def run(batches):
        for batch in batches:
            tids = batch.column("tid").to_numpy()
            for row, data, offsets, gram, of, start, end, _ in _runs(batch.column("text"), length):
                asked = np.flatnonzero(only.has(gram)) if len(gram) else []
                if len(asked):
                    gram, of, start, end = (x[asked] for x in (gram, of, start, end))
                    yield pa.RecordBatch.from_arrays(
                        [_signed(gram), _signed(_digests(data, start, end)), pa.array(tids[row + of]), pa.array(start - offsets[of]), pa.array(end - offsets[of])],
                        ["gram", "run", "tid", "s", "e"])
    return run


def _windows(length: int):
    """A digest of each window of a run."""
    def run(batches):
        for batch in batches:
            rows = [(g, r, n, w, xxhash.xxh3_128_digest(x[w: w + length]))
                    for g, r, n, x in zip(*(batch.column(c).to_pylist() for c in ("gram", "run", "n", "bytes"))) for w in range(len(x) - length + 1)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 5, kinds)], ["gram", "run", "n", "at", "bytes"])
    return run


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


def _sort(length: int):
    """Per gram: the covered parts of its runs that occur once."""
    def run(batches):
        rows = []

        def batch():
            columns = list(zip(*rows)) if rows else [()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), _SPANS])], ["gram", "run", "spans"])

        for (gram,), group in groups(batches, ["gram"]):
            lefts = [r["bytes"][: r["at"]][::-1] for r in group]
            rights = [r["bytes"][r["at"]:] for r in group]
            for r, extents in zip(group, shared(lefts, rights, length)):
                if extents and r["n"] == 1:
                    spans = _merged([(r["at"] - a, r["at"] + b) for a, b in extents])
                    rows.append((gram, r["run"], [{"s": a, "e": b} for a, b in spans]))
            if len(rows) >= 10_000:
                yield batch()
                rows.clear()
        yield batch()
    return run


def _remove(batches):
    """Cut the covered places out of each text."""
    for whole in batches:
        for at in range(0, whole.num_rows, 128):
            batch = whole.slice(at, 128)
            kept, n_bytes, n_removed, n_spans = [], [], [], []
            for text, places in zip(batch.column("text"), batch.column("covered").to_pylist()):
                raw = text.as_py()
                gone, left, here = _merged([(p["s"], p["e"]) for p in places or ()]), [], 0
                for s, e in gone:
                    left.append(raw[here:s])
                    here = e
                kept.append(b"".join([*left, raw[here:]]))
                n_bytes.append(len(raw))
                n_removed.append(sum(e - s for s, e in gone))
                n_spans.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                 pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                   most_runs: int = MOST_RUNS) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans and ``kept``, the bytes that no repeated string of that length covers."""
    if length < 2 * GRAM:
        raise ValueError(f"strings have {2 * GRAM} bytes at least")
    text = text_or_empty(text_col)
    texts = docs.select(column(id_col).alias("id"), F.xxhash64(text).alias("tid"), text.cast("binary").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    scanned = "gram bigint, run bigint, tid bigint, n bigint"
    both = texts.select("tid", "text")

    # One exchange by gram serves the counts of runs and, over these, of grams.
    runs = both.mapInArrow(_count(length), scanned).repartition("gram").groupBy("gram", "run").agg(
        F.sum("n").alias("n"), F.min("tid").alias("tid"))
    of_gram = Window.partitionBy("gram")
    known = cut(runs.select("*", F.count("*").over(of_gram).alias("runs"), F.min("n").over(of_gram).alias("fewest")).where("n > 1 or runs > 1"))

    # The texts are read again, and each run of such grams leaves its task once, from the text named for it. The filters let
    # a few others pass; those have no count here.
    asked = known.where("runs > 1 and fewest = 1").select("gram", "run", "n", (F.col("runs") > most_runs).alias("many"), "tid")
    wanted = _fetch(length, BloomFilter(asked, "gram"), BloomFilter(asked.mapInArrow(_named, "key bigint"), "key"))
    fetched = both.mapInArrow(wanted, "gram bigint, run bigint, at int, bytes binary")
    asked = asked.drop("tid")
    found = fetched.unionByName(asked, allowMissingColumns=True).repartition("gram").groupBy("gram", "run").agg(
        F.max("n").alias("n"), F.max("many").alias("many"), F.max(F.struct("at", "bytes")).alias("own")).where("n is not null").select(
        "gram", "run", "n", "own.at", "own.bytes", "many")
    found = cut(found)
    sides = found.where("not many").select("gram", "run", "n", "at", "bytes")
    spans = "array<struct<s:int,e:int>>"
    sorted_ = sides.repartition("gram").sortWithinPartitions("gram", "run").mapInArrow(_sort(length), f"gram bigint, run bigint, spans {spans}")
    windows = found.where("many").select("gram", "run", "n", "bytes").mapInArrow(
        _windows(length), "gram bigint, run bigint, n bigint, at int, bytes binary")
    again = windows.groupBy("gram", "bytes").agg(F.count("*").alias("times")).where("times > 1").select("gram", "bytes")
    windowed = windows.where("n = 1").join(again, ["gram", "bytes"], "left_semi").groupBy("gram", "run").agg(
        F.array_sort(F.collect_list(F.struct(F.col("at").alias("s"), (F.col("at") + length).alias("e")))).cast(spans).alias("spans"))
    settled = known.where("n > 1").select("gram", "run", F.lit(None).cast(spans).alias("spans"))
    covered = settled.unionByName(sorted_).unionByName(windowed)

    where = both.mapInArrow(_places(length, BloomFilter(known, "gram")), "gram bigint, run bigint, tid bigint, s bigint, e bigint")
    place = F.struct("s", "e")
    parts = F.transform("spans", lambda p: F.struct((F.col("s") + p["s"]).alias("s"), (F.col("s") + p["e"]).alias("e")))
    per_text = where.join(covered, ["gram", "run"]).select("tid", F.explode(F.when(F.col("spans").isNull(), F.array(place)).otherwise(parts)).alias("place"))
    per_text = per_text.groupBy("tid").agg(F.collect_set("place").alias("covered"))
    rows = texts.join(per_text, "tid", "left").select("id", "text", "covered")
    return rows.mapInArrow(_remove, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
