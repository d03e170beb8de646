"""Near-duplicate documents by HyperMinHash.

Every distinct shingle set gets registers that keep, of the smallest hash in a bucket of hashes, the number of leading
zeros and ten bits after them: two bytes each. Registers are banded; sets that agree in a band are candidates. Candidates
are first estimated from all registers, corrected for registers that agree by chance, and then confirmed by counting the
common shingles of the full sets.

Groups of copies stay cheap. Equal sets are one node. In the first round the members of a band's bucket are compared
with one hub only; in the second, members that the found links left in different components meet in blocks of a bucket,
with their sets if a likely partner is there, and a block passes on only links that join something. So no link between
components is skipped, and no list of a group's pairs is ever made.

The bands follow from the threshold: they are as long as leaves a pair at it a probability below 5e-5 to be missed by all
(below about 7 %, bands of one register miss more). For 85 % these are 21 bands of six registers, which miss a pair at
90 % with 1e-7; for 80 % they are 25 of five. Sets of very few shingles (fewer than six for 85 %, than four for 80 %) can
only reach the threshold when equal, and equal sets need no search.

Cases: a text without words (or null) has no set and no links. Rows that repeat are copies of each other. Ids may be
null or repeat: a component's id is its smallest id that is not null; rows of a component without any id keep null and
are all kept. Extra columns take no part. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import column, cut, groups, text_or_empty
from .components import components
from .shingles import mixed, shingle_sets

BUCKET_BITS, MANTISSA_BITS = 7, 10
REGISTERS = 126
#: The most that bands may miss of the pairs at the threshold.
MISSED = 5e-5
EMPTY = np.uint16(0xFFFF)
#: The chance that registers of different minima agree: equal leading zeros (1/3) and equal mantissa bits.
CHANCE = 1 / (3 << MANTISSA_BITS)
#: Estimates are trusted to five and a half deviations, and not at all for sets smaller than this.
DEVIATIONS, LEAST_ESTIMATED = 5.5, 32
SPOKES, BLOCK = 1000, 1024
_donors = (mixed(np.arange(64 * (1 << BUCKET_BITS), dtype=np.uint64)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64).reshape(64, -1)


def banding(percent: int) -> tuple[int, int]:
    """(bands, registers in each) for a threshold."""
    missed = lambda rows: (1 - (percent / 100) ** rows) ** (REGISTERS // rows)
    rows = max((r for r in range(1, REGISTERS + 1) if missed(r) <= MISSED), default=1)
    return REGISTERS // rows, rows


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers per set (sorted distinct hashes). Empty registers borrow from others, in a fixed order."""
    size, rest_bits = 1 << BUCKET_BITS, np.uint64(64 - BUCKET_BITS)
    least = np.zeros((len(sets), size), np.uint64)
    full = np.zeros((len(sets), size), bool)
    for i, s in enumerate(sets):
        bucket = (s >> rest_bits).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        least[i, bucket[first]] = s[first] & ((np.uint64(1) << rest_bits) - np.uint64(1))
        full[i, bucket[first]] = True
    part, exponent = np.frexp(least.astype(np.float64))
    zeros = np.minimum(int(rest_bits) - exponent, 62).astype(np.uint16)
    code = (zeros << np.uint16(MANTISSA_BITS)) | np.minimum((2 * part - 1).clip(0) * (1 << MANTISSA_BITS), (1 << MANTISSA_BITS) - 1).astype(np.uint16)
    code[~full] = EMPTY
    own = code.copy()
    for donor in _donors:
        code = np.where((code == EMPTY) & full[:, donor], own[:, donor], code)
    for shift in range(1, size):
        if not (code == EMPTY).any():
            break
        code = np.where(code == EMPTY, np.roll(own, -shift, axis=1), code)
    return code[:, :REGISTERS]


def estimated(agreeing: np.ndarray) -> np.ndarray:
    """The Jaccard similarity from the number of agreeing registers, without those that agree by chance."""
    return (agreeing / REGISTERS - CHANCE) / (1 - CHANCE)


def likely(agreeing: np.ndarray, smaller: np.ndarray, threshold: float) -> np.ndarray:
    """Whether pairs may reach the threshold. Small sets fill fewer registers of their own, so they are given more room."""
    own = REGISTERS * smaller / (smaller + (1 << BUCKET_BITS))
    room = DEVIATIONS * np.sqrt(threshold * (1 - threshold) / np.maximum(own, 1))
    return (smaller < LEAST_ESTIMATED) | (estimated(agreeing) >= threshold - room)


def _sketch(k: int, least: int):
    def run(batches):
        for batch in batches:
            n, keys, kept, sets = [], [], [], []
            for i, s in enumerate(shingle_sets(batch.column("text"), k)):
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                if len(s) >= least:
                    kept.append(i)
                    sets.append(s)
            codes: list[bytes | None] = [None] * len(n)
            for at in range(0, len(sets), 512):
                for i, row in zip(kept[at: at + 512], registers(sets[at: at + 512])):
                    codes[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tid"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(codes, pa.binary())], ["id", "tid", "n", "node", "code"])
    return run


def _matrix(codes: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(codes.to_pylist()), np.uint16).reshape(len(codes), REGISTERS)


def _likely(threshold: float):
    """Pairs (a, b) whose estimate is near the threshold or whose sets are too small for one."""
    def run(batches):
        for batch in batches:
            agree = (_matrix(batch.column("code_a")) == _matrix(batch.column("code_b"))).sum(axis=1)
            smaller = np.minimum(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy())
            keep = pa.array(likely(agree, smaller, threshold))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])
    return run


def _open_pairs(rows: list[dict], codes: np.ndarray, i: int, j: int, band: int, percent: int) -> tuple[np.ndarray, ...]:
    """Likely pairs of a block whose sides are in different components and whose first common band is this one; their
    numbers in rows and the estimates."""
    block = np.array([r["block"] for r in rows])
    left, right = (np.flatnonzero(block == x) for x in (i, j))
    a, b = codes[left], codes[right]
    agree, fresh = np.zeros((len(a), len(b)), np.uint8), np.ones((len(a), len(b)), bool)
    length = banding(percent)[1]
    for t, at in enumerate(range(0, REGISTERS, length)):  # registers left over come last and count as well
        same = [a[:, r, None] == b[None, :, r] for r in range(at, min(at + length, REGISTERS))]
        for x in same:
            agree += x
        if t < band:
            fresh &= ~np.logical_and.reduce(same)
    names: dict[bytes, int] = {}
    comp, n = np.array([names.setdefault(r["comp"], len(names)) for r in rows]), np.array([r["n"] for r in rows])
    fresh &= comp[left][:, None] != comp[right][None, :]
    fresh &= likely(agree, np.minimum(n[left][:, None], n[right][None, :]), percent / 100)
    if i == j:
        fresh &= left[:, None] < right[None, :]
    x, y = np.nonzero(fresh)
    return left[x], right[y], agree[x, y]


def _across(percent: int):
    """The members of a block that have a likely partner there."""
    names = ["band", "i", "j", "b", "block", "node", "comp"]

    def run(batches):
        for (_, i, j), rows in groups(batches, ["band", "i", "j"]):
            codes = np.stack([np.frombuffer(r["code"], np.uint16) for r in rows])
            x, y, _ = _open_pairs(rows, codes, i, j, rows[0]["b"], percent)
            met = [rows[k] for k in np.union1d(x, y).tolist()]
            if met:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in met], k) for c, k in zip(names, kinds)], names)
    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    common = int((a[at] == b).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _partners(mine: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the other sets are similar enough, all counted at once."""
    sizes = np.array([len(s) for s in others])
    flat = np.concatenate(others)
    at = np.searchsorted(mine, flat)
    at[at == len(mine)] = 0
    common = np.add.reduceat((mine[at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * common >= percent * (len(mine) + sizes - common)


def _join(percent: int):
    """Within a block of full sets: links between components. Pairs estimated above the threshold come first, the most
    similar leading; then each member meets the rest of its likely partners together. What is joined is passed by."""
    def run(batches):
        for (_, i, j), rows in groups(batches, ["band", "i", "j"]):
            sets = [np.frombuffer(r["set"], np.uint64) for r in rows]
            for r, s in zip(rows, sets):
                r["n"] = len(s)
            x, y, agree = _open_pairs(rows, registers(sets), i, j, rows[0]["b"], percent)
            parent = {r["comp"]: r["comp"] for r in rows}

            def top(c: bytes) -> bytes:
                while parent[c] != c:
                    parent[c] = parent[parent[c]]
                    c = parent[c]
                return c

            a, b = [], []

            def link(p: int, q: int) -> None:
                parent[top(rows[p]["comp"])] = top(rows[q]["comp"])
                a.append(rows[p]["node"])
                b.append(rows[q]["node"])

            def apart(p: int, q: int) -> bool:
                small, large = sorted((len(sets[p]), len(sets[q])))
                return 100 * small >= percent * large and top(rows[p]["comp"]) != top(rows[q]["comp"])

            order = np.argsort(-agree.astype(np.int16), kind="stable")
            for k in order[estimated(agree[order]) >= percent / 100].tolist():
                p, q = int(x[k]), int(y[k])
                if apart(p, q) and _similar(sets[p], sets[q], percent):
                    link(p, q)
            starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else []
            for at, end in zip(starts, [*starts[1:], len(x)]):
                p = int(x[at])
                others = [q for q in y[at:end].tolist() if apart(p, q)]
                if others:
                    for q, similar in zip(others, _partners(sets[p], [sets[q] for q in others], percent).tolist()):
                        if similar and top(rows[p]["comp"]) != top(rows[q]["comp"]):
                            link(p, q)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
    return run


def _send_to_blocks(k: int):
    names = ["band", "i", "j", "b", "block", "comp"]

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sent = [(node, to, s.tobytes()) for node, goes, s in zip(batch.column("node").to_pylist(), batch.column("asked").to_pylist(),
                                                                        shingle_sets(batch.column("text"), k)) for to in goes]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                columns = [pa.array([to[c] for _, to, _ in sent], t) for c, t in zip(names, kinds)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([x for x, _, _ in sent], pa.binary()), pa.array([x for _, _, x in sent], pa.binary())],
                                                 [*names, "node", "set"])
    return run


def _send(k: int):
    """The full set of each asked document, once for every hub it is compared with."""
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                hubs, salts, is_hub, nodes, sets = [], [], [], [], []
                asked = batch.column("asked").to_pylist()
                for node, goes, s in zip(batch.column("node").to_pylist(), asked, shingle_sets(batch.column("text"), k)):
                    raw = s.tobytes()
                    for to in goes:
                        hubs.append(to["hub"])
                        salts.append(to["salt"])
                        is_hub.append(to["is_hub"])
                        nodes.append(node)
                        sets.append(raw)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hubs, pa.binary()), pa.array(salts, pa.int64()), pa.array(is_hub, pa.int32()),
                     pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], ["hub", "salt", "is_hub", "node", "set"])
    return run


def _confirm(percent: int):
    """A hub comes first among its rows; then each other set is compared with it."""
    def run(batches):
        hub, shingles = None, None
        for batch in batches:
            a, b = [], []
            for to, is_hub, node, raw in zip(*(batch.column(c) for c in ("hub", "is_hub", "node", "set"))):
                mine = np.frombuffer(raw.as_py(), np.uint64)
                if is_hub.as_py():
                    hub, shingles = to.as_py(), mine
                    continue
                if to.as_py() != hub:
                    raise ValueError("a set came without its hub")
                if _similar(shingles, mine, percent):
                    a.append(node.as_py())
                    b.append(hub)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
    return run


class Search:
    """The steps over one table of documents; what several steps read is written to the checkpoint folder once."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int):
        self.k, self.percent = k, percent
        text = text_or_empty(text_col)
        self.texts = docs.select(column(id_col).alias("id"), F.xxhash64(text).alias("tid"), text.cast("binary").alias("text"))
        kind = self.texts.schema["id"].dataType.simpleString()
        least = -(-percent // (100 - percent))  # below, one shingle more or less is already too much
        self.rows = cut(self.texts.mapInArrow(
            _sketch(k, least), f"id {kind}, tid bigint, n bigint, node binary, code binary"))
        self.nodes = cut(self.rows.where("node is not null").groupBy("node").agg(
            F.min("id").alias("least"), F.min(F.struct("tid", "id")).alias("who"), F.max("n").alias("n"),
            F.max("code").alias("code")))

    def members(self) -> DataFrame:
        """(b, band, node, hub, size): the rows of buckets with two or more nodes."""
        n, length = banding(self.percent)
        bands = self.nodes.where("code is not null").select("node", F.posexplode(F.array(*[
            F.xxhash64(F.lit(b), F.substring("code", 2 * length * b + 1, 2 * length)) for b in range(n)])).alias("b", "band"))
        # Written, so that the join exchanges both sides and Spark can split a large bucket.
        shared = cut(bands.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("size")).where("size > 1"))
        return cut(bands.join(shared, "band"))

    def likely(self, pairs: DataFrame) -> DataFrame:
        a = self.nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("code").alias("code_a"))
        b = self.nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("code").alias("code_b"))
        return pairs.join(a, "a").join(b, "b").mapInArrow(_likely(self.percent / 100), "a binary, b binary")

    def asked_texts(self, asked: DataFrame) -> DataFrame:
        """(node, asked, text): one document's text for each asked node."""
        asked = asked.join(self.nodes.select("node", "who"), "node").select("node", "asked", F.col("who.tid").alias("t"), F.col("who.id").alias("i"))
        same = (F.col("tid") == F.col("t")) & F.col("id").eqNullSafe(F.col("i"))
        return self.texts.join(asked, same).select("node", "asked", "text")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets are similar enough; b is the hub, its other sides come in portions."""
        pairs = cut(pairs)
        portions = pairs.groupBy("b").agg(F.ceil(F.count("*") / SPOKES).cast("long").alias("portions"))
        spokes = pairs.join(portions, "b").select(
            F.col("a").alias("node"), F.col("b").alias("hub"), F.pmod(F.xxhash64("a"), "portions").alias("salt"), F.lit(0).alias("is_hub"))
        hubs = portions.select(F.col("b").alias("node"), F.col("b").alias("hub"),
                               F.explode(F.sequence(F.lit(0).cast("long"), F.col("portions") - 1)).alias("salt"), F.lit(1).alias("is_hub"))
        asked = spokes.unionByName(hubs).groupBy("node").agg(F.collect_list(F.struct("hub", "salt", "is_hub")).alias("asked"))
        texts = self.asked_texts(asked)
        sets = texts.mapInArrow(_send(self.k), "hub binary, salt bigint, is_hub int, node binary, set binary")
        met = sets.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.desc("is_hub"))
        return cut(met.mapInArrow(_confirm(self.percent), "a binary, b binary"))

    def across(self, members: DataFrame, roots: DataFrame) -> DataFrame:
        """Confirmed links (a, b) between nodes of a bucket that are still in different components."""
        known = members.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node"))
        open_ = known.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select("band")
        rows = known.join(open_, "band").select(
            "b", "band", "node", "comp", F.ceil(F.col("size") / BLOCK).cast("long").alias("blocks"))
        rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
        rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        rows = rows.join(self.nodes.select("node", "n", "code"), "node").select(
            "b", "band", "node", "comp", "block", "n", "code", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        met = rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
        place = "band bigint, i bigint, j bigint, b int, block bigint"
        partners = cut(met.mapInArrow(_across(self.percent), f"{place}, node binary, comp binary"))
        asked = partners.groupBy("node").agg(F.collect_list(F.struct("band", "i", "j", "b", "block", "comp")).alias("asked"))
        sets = self.asked_texts(asked).mapInArrow(_send_to_blocks(self.k), f"{place}, comp binary, node binary, set binary")
        met = sets.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
        return cut(met.mapInArrow(_join(self.percent), "a binary, b binary"))

    def components(self) -> DataFrame:
        """(node, root) of the nodes with links."""
        members = self.members()
        stars = members.where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
        links = self.confirmed(self.likely(stars))
        roots = components(links)
        more = self.across(members, roots)
        if more.isEmpty():
            return roots
        return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 85) -> DataFrame:
    """Per row: ``id``, ``tid`` (a hash of its text), ``n_shingles``, ``component_id`` and ``kept``."""
    search = Search(docs, id_col, text_col, k, percent)
    roots = search.components()
    named = search.nodes.select("node", "least").join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node"))
    ids = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    per_node = named.join(ids, "comp").select("node", "component_id")
    rows = search.rows.select("id", "tid", "n", "node").join(per_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.select("id", "tid", F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.col("id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 85) -> DataFrame:
    """The documents that stand for their component, with the columns they came with."""
    kept = near_duplicates(docs, id_col, text_col, k, percent).where("kept").select("id", "tid").distinct()
    rows = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("doc"), column(id_col).alias("_id"),
                       F.xxhash64(text_or_empty(text_col)).alias("_tid"))
    same = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_tid") == F.col("tid"))
    return rows.join(kept, same, "left_semi").select(*[F.col("doc")[c].alias(c) for c in docs.columns])
