"""Best-fit packing of tokenized documents into sequences, certified by lower bounds.

Documents longer than a sequence are cut into pieces of its length. Pieces are dealt into groups of a fixed size; each
group runs best-fit decreasing and compares its sequences with a lower bound from dual feasible functions. A group that
meets the bound is done but for its emptiest sequence; a group with a gap gives up every sequence with room. What is
given up is dealt anew, so that pieces change groups, and packed again, for a fixed number of rounds; ``certificate`` tells
what gap is left over all groups together.

Cases: a null or empty text is one token, the end. Rows with the same id, or none, are documents of their own. Extra
columns take no part. An empty table gives no sequences.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import column, cut, text_or_empty
from .tokens import encoder

GROUP, ROUNDS, END = 200_000, 3, b"\0\0\0\0"
#: The last of the step functions tried for the bound.
STEPS = 64


def _pieces(length: int, path: str | None, with_ids: bool):
    def run(batches):
        held = encoder(path)
        try:
            yield from cut_up(batches, held.encode_all)
        finally:
            held.forget()

    def cut_up(batches, ids_of):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows, number, starts, lengths, crcs, held = [], [], [], [], [], []
                for i, ids in enumerate(ids_of(batch.column("text").to_pylist())):
                    ids += END
                    for piece, start in enumerate(range(0, len(ids), 4 * length)):
                        part = ids[start: start + 4 * length]
                        rows.append(i)
                        number.append(piece)
                        starts.append(start // 4)
                        lengths.append(len(part) // 4)
                        crcs.append(zlib.crc32(part))
                        held.append(part)
                columns = [batch.column("id").take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()), pa.array(starts, pa.int64()),
                           pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(held, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def lower_bound(lengths: np.ndarray, room: int) -> int:
    """The best of the dual feasible bounds on the number of sequences of that room."""
    return bound_of(np.bincount(lengths, minlength=room + 1).astype(np.int64), room)


def bound_of(count: np.ndarray, room: int) -> int:
    """The bound from the number of pieces of each length.

    The first family counts pieces longer than all but e as whole and drops those under e; the second rounds a piece's
    (k + 1)-fold down to whole sequences. Everything is whole numbers.
    """
    size = np.arange(room + 1)
    above, words = count[::-1].cumsum()[::-1], (count * size)[::-1].cumsum()[::-1]
    best = -(-int(words[0]) // room)
    for e in range(1, room // 2 + 1):  # pieces > room - e weigh a whole room, those from e to room - e themselves
        weight = int(above[room - e + 1]) * room + int(words[e] - words[room - e + 1])
        best = max(best, -(-weight // room))
    for k in range(1, STEPS + 1):
        whole = (k + 1) * size
        value = np.where(whole % room == 0, size * k, whole // room * room)
        best = max(best, -(-int((count * value).sum()) // (room * k)))
    return best


def best_fit(lengths: np.ndarray, room: int) -> np.ndarray:
    """Best-fit decreasing: each piece, longest first, goes to the fullest sequence that has room. Gives its number."""
    order = np.argsort(-lengths, kind="stable")
    place = np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(room + 1)]
    open_, used = 0, 0  # open_ has a bit for each amount of room that some sequence has
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fits = open_ >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            sequence = by_room[left].pop()
            if not by_room[left]:
                open_ ^= 1 << left
        else:
            left, sequence, used = room, used, used + 1
        left -= n
        place[i] = sequence
        if not by_room[left]:
            open_ |= 1 << left
        by_room[left].append(sequence)
    return place


def _packed(room: int, last: bool):
    """Pack a group; ``open`` marks pieces of sequences that are given up."""
    def run(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        place = best_fit(lengths, room)
        uids = table.column("uid").to_numpy()
        order = np.lexsort((uids, place))
        sizes = np.bincount(place, weights=lengths).astype(np.int64)
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.flatnonzero(np.concatenate([[True], np.diff(place[order]) > 0]))
        offsets, names = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
        offsets[order] = before - before[first][place[order]]
        names[order] = uids[order][first][place[order]]
        left = room - sizes
        if last:
            given_up = np.zeros(len(sizes), bool)
        elif len(sizes) > lower_bound(lengths, room):
            given_up = left > 0
        else:
            given_up = np.arange(len(sizes)) == np.argmax(left)
        for name, values in (("sequence_id", pa.array(names)), ("offset", pa.array(offsets)), ("open", pa.array(given_up[place]))):
            table = table.append_column(name, values)
        return table.drop_columns(["group"])
    return run


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 2048,
              tokenizer_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, and with ``with_ids`` the ids themselves."""
    rows = docs.select(column(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return rows.mapInArrow(_pieces(length, tokenizer_path, with_ids), schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 2048,
         tokenizer_path: str | None = None, with_ids: bool = False, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``."""
    pieces = tokenized(docs, id_col, text_col, length, tokenizer_path, with_ids)
    pieces = cut(pieces.withColumn("uid", F.monotonically_increasing_id()))  # written, so a piece's number stays
    done = pieces.where(F.col("length") == length).withColumns({"sequence_id": F.col("uid"), "offset": F.lit(0).cast("long")})
    rest = pieces.where(F.col("length") < length)
    for turn in range(rounds):
        groups = -(-rest.count() // group)
        if not groups:
            break
        last = turn == rounds - 1 or (turn > 0 and groups == 1)
        dealt = rest.withColumn("group", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(groups)))
        schema = dealt.drop("group").schema.add("sequence_id", "long").add("offset", "long").add("open", "boolean")
        packed = cut(dealt.groupBy("group").applyInArrow(_packed(length, last), schema))
        done = done.unionByName(packed.where("not open").drop("open"))
        rest = packed.where("open").drop("sequence_id", "offset", "open")
        if last:
            break
    return done.drop("uid")


def certificate(packed: DataFrame, length: int = 2048) -> tuple[int, int]:
    """The sequences of a packing, and the lower bound over all its pieces together: equal numbers prove that no packing has
    fewer; otherwise their difference bounds what the rounds have left open."""
    used = packed.agg(F.count_distinct("sequence_id")).first()[0]
    count = np.zeros(length + 1, np.int64)
    for row in packed.groupBy("length").count().collect():  # at most as many rows as lengths
        count[row["length"]] = row["count"]
    return used, bound_of(count, length)
