"""Words that differ by one edit, grouped under the spelling that is far more frequent.

Two words one edit apart share a long beginning or a long end: with h half of a word's length, either its first h
characters are those of its neighbour, or all but its first h are. So each word is looked up twice, among the words with
its beginning and, spelled backwards, among those with its end. Words with such a part and a length that fits meet in one
bucket, sorted.

A bucket is searched as a sorted list: the edit matrix of a query has a band of three cells for each character of a list
word, and a list word takes over the rows of the characters that it shares with the word before it (the longest common
prefix of neighbours), so a row is made once for each different prefix. Where a row has no cell within one edit, all words
with that prefix are skipped at once. All queries of a batch of buckets advance together, a character at a time.

Buckets are counted beforehand. One with more than ``HOT`` words is dealt as a grid of cells, in which a part of its queries
meets a part of its list, so that a beginning shared by a third of all words isn't one task's. Counting combines before the
shuffle. Chains of forms are followed by doubling; as each form is ten times as frequent, they have few steps.

Cases: a null or empty text has no words. A document without an id counts as one with an empty id. Repeated rows count
each. Words of any length are compared whole. Ties between forms go to the smallest in code-point order. An empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import column, cut, text_or_empty

RUN = r"[A-Za-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Buckets that words are dealt into; the words from which a bucket becomes a grid; rows and queries worked on at a time.
BUCKETS, HOT, BATCH, QUERIES = 1 << 20, 20_000, 40_000, 8_000
#: A form is this many times as frequent. A chain has fewer steps than a 64-bit count has decimal digits.
TIMES, DOUBLINGS = 10, 5
LIST, QUERY = 1, 2


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7,
          altered: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``word`` and ``n``. ``altered`` turns an id and a lower-cased run into the word that is counted, never a longer one."""
    runs = docs.select(F.coalesce(column(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.translate(text_or_empty(text_col), CAPITALS, SMALL), F.lit(RUN), F.lit(0))).alias("run"))
    word = altered(F.col("id"), F.col("run")) if altered else F.col("run")
    return (runs.where(F.length("run") >= least).select(word.alias("word")).where(F.length("word") >= least)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def _dealt(vocabulary: DataFrame, least: int) -> DataFrame:
    """A row per word, direction and length of the queries that may meet it: ``bucket``, ``kind`` (twice the query's length,
    plus 1 if backwards), ``w`` (as spelled in that direction), ``n`` and ``role``."""
    size = F.length("word")
    rows = vocabulary.select(
        "n", size.alias("size"), F.explode(F.array(*[F.struct(F.lit(b).alias("back"), w.alias("w")) for b, w in
                                                    ((0, F.col("word")), (1, F.reverse("word")))])).alias("d"))
    rows = rows.select("n", "size", "d.*", F.explode(F.expr("array(size - 1, size, size + 1)")).alias("of")).where(F.col("of") >= least)
    part = F.expr("substring(w, 1, if(back = 0, of div 2, of - of div 2))")
    kind = F.col("of") * 2 + F.col("back")
    return rows.select(F.pmod(F.xxhash64(kind, part), F.lit(BUCKETS)).cast("int").alias("bucket"), kind.cast("int").alias("kind"), "w", "n",
                       F.when(F.col("of") == F.col("size"), LIST + QUERY).otherwise(LIST).alias("role"))


def _cells(rows: DataFrame, hot: int) -> DataFrame:
    """Rows with the cell of their bucket: a bucket beyond ``hot`` words is a grid of parts of its queries and of its list."""
    grids = rows.groupBy("bucket").count().where(F.col("count") > hot).select("bucket", F.ceil(F.col("count") / hot).cast("int").alias("side"))
    # at most all rows / hot, and BUCKETS, pairs of integers
    rows = rows.join(F.broadcast(cut(grids)), "bucket", "left")
    own, all_of = F.pmod(F.xxhash64("w"), F.col("side")).cast("int"), F.sequence(F.lit(0), F.col("side") - 1)
    as_list = F.transform(all_of, lambda k: F.struct((k * F.col("side") + own).alias("cell"), F.lit(LIST).alias("role")))
    as_query = F.transform(all_of, lambda k: F.struct((own * F.col("side") + k).alias("cell"), F.lit(QUERY).alias("role")))
    places = (F.when(F.col("side").isNull(), F.array(F.struct(F.lit(0).alias("cell"), F.col("role").alias("role"))))
              .when(F.col("role") == LIST, as_list).otherwise(F.concat(as_list, as_query)))
    return rows.select("bucket", "kind", "w", "n", F.explode(places).alias("at")).select("bucket", "at.cell", "kind", "w", "n", "at.role")


class SortedList:
    """Words of several groups, sorted in each; a group has one kind in one cell. Words may be only queries or only list."""

    def __init__(self, group: np.ndarray, half: np.ndarray, text: list[str]):
        self.text = text
        self.sizes = np.fromiter(map(len, text), np.int64, len(text))
        self.at = np.concatenate([[0], np.cumsum(self.sizes + 3)])[:-1]
        # three characters that no word has end each word, so that the band may look beyond it
        self.chars = np.frombuffer("\x00\x00\x00".join([*text, ""]).encode("utf-32-le"), np.uint32)
        self.prefix = self._prefixes(group)
        # words that share their first half: where its run starts and ends
        starts = np.flatnonzero(self.prefix < half)
        run = np.searchsorted(starts, np.arange(len(text)), "right") - 1
        self.first, self.last = starts[run], np.append(starts, len(text))[run + 1]
        self.half = half

    def _prefixes(self, group: np.ndarray) -> np.ndarray:
        """The length of what each word shares with the one before, -1 where another group starts."""
        prefix = np.full(len(self.text), -1, np.int64)
        alive, depth = np.flatnonzero(group[1:] == group[:-1]) + 1, 0
        while len(alive):
            prefix[alive] = depth
            a, b = self.chars[self.at[alive - 1] + depth], self.chars[self.at[alive] + depth]
            alive = alive[(a == b) & (a != 0)]
            depth += 1
        return prefix

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) one edit apart with equal first halves."""
        found = [(np.empty(0, np.int64),) * 2]
        depth = int(self.half[queries].min()) if len(queries) else 0
        waiting = queries[np.argsort(self.half[queries], kind="stable")]
        q = lo = hi = np.empty(0, np.int64)
        band = np.empty((3, 0), np.int8)
        while len(q) or len(waiting):
            # queries whose first half ends here start with no edit so far
            n = int(np.searchsorted(self.half[waiting], depth, "right"))
            new, waiting = waiting[:n], waiting[n:]
            q, lo, hi = np.concatenate([q, new]), np.concatenate([lo, self.first[new]]), np.concatenate([hi, self.last[new]])
            band = np.concatenate([band, np.repeat(np.array([[1], [0], [1]], np.int8), n, axis=1)], axis=1)
            if not len(q):
                depth = int(self.half[waiting[0]])
                continue
            # the different characters that follow: runs of the list with one more character in common
            starts = np.flatnonzero(self.prefix <= depth)
            run = np.searchsorted(starts, lo, "right") - 1
            many = np.searchsorted(starts, hi - 1, "right") - run
            node = np.repeat(np.arange(len(q)), many)
            run = run[node] + np.arange(len(node)) - np.repeat(np.cumsum(many) - many, many)
            q, lo, hi = q[node], starts[run], np.append(starts, len(self.text))[run + 1]
            char = self.chars[self.at[lo] + depth]
            band, size = band[:, node], self.sizes[q]
            over = char == 0
            if over.any():
                gap = size - depth + 1
                ends = over & (gap >= 0) & (gap <= 2)
                ends[ends] = band[gap[ends], np.flatnonzero(ends)] == 1
                for k in range(int((hi - lo)[ends].max()) if ends.any() else 0):
                    at = ends & (hi - lo > k)
                    found.append((q[at], lo[at] + k))
                q, lo, hi, char, band, size = q[~over], lo[~over], hi[~over], char[~over], band[:, ~over], size[~over]
            own = self.at[q]
            old, differs = band, [self.chars[own + np.minimum(depth + k, size)] != char for k in (-1, 0, 1)]
            band = np.empty_like(old)
            band[0] = np.minimum(old[0] + differs[0], old[1] + 1)
            band[1] = np.minimum(np.minimum(old[1] + differs[1], old[2] + 1), band[0] + 1)
            band[2] = np.minimum(old[2] + differs[2], band[1] + 1)
            for k in range(3):
                band[k][depth + k > size] = 2
            live = band.min(axis=0) <= 1
            q, lo, hi, band = q[live], lo[live], hi[live], np.minimum(band[:, live], 2)
            depth += 1
        return tuple(np.concatenate(x) for x in zip(*found))


def _search(batches) -> Iterator[pa.RecordBatch]:
    for table in _whole_buckets(batches):
        bucket, cell, kind, n, role = (table[c].to_numpy() for c in ("bucket", "cell", "kind", "n", "role"))
        text = table["w"].to_pylist()
        edge = (bucket[1:] != bucket[:-1]) | (cell[1:] != cell[:-1]) | (kind[1:] != kind[:-1])
        size, back = kind // 2, kind % 2
        listed = SortedList(np.concatenate([[0], np.cumsum(edge)]), np.where(back == 0, size // 2, size - size // 2), text)
        queries, near, best = np.flatnonzero(role & QUERY), {}, {}
        for at in range(0, len(queries), QUERIES):
            for i, j in zip(*map(np.ndarray.tolist, listed.near(queries[at: at + QUERIES]))):
                if not role[j] & LIST:
                    continue
                form = text[j]
                if back[i]:
                    form, word, half = form[::-1], text[i][::-1], int(size[i]) // 2
                    if form[:half] == word[:half]:
                        continue  # found by their beginning
                near[i] = near.get(i, 0) + 1
                this = (-int(n[j]), form)
                if i not in best or this < best[i]:
                    best[i] = this
        yield pa.RecordBatch.from_arrays([
            pa.array([text[i][::-1] if back[i] else text[i] for i in near], pa.string()), pa.array(near.values(), pa.int64()),
            pa.array([-best[i][0] for i in near], pa.int64()), pa.array([best[i][1] for i in near], pa.string())],
            ["word", "n_near", "form_n", "form"])


def _whole_buckets(batches) -> Iterator[pa.Table]:
    """Some buckets at a time, each whole; a bucket has a few times HOT rows at most."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            bucket, cell = batch.column("bucket").to_numpy(), batch.column("cell").to_numpy()
            if rows >= BATCH:
                last = held[-1].slice(held[-1].num_rows - 1)
                other = np.flatnonzero((bucket != last.column("bucket")[0].as_py()) | (cell != last.column("cell")[0].as_py()))
                if len(other):
                    yield pa.Table.from_batches([*held, batch.slice(0, int(other[0]))])
                    held, rows, batch = [], 0, batch.slice(int(other[0]))
                    continue
                held.append(batch)
                rows += batch.num_rows
                break
            piece = batch.slice(0, BATCH - rows)
            held.append(piece)
            rows += piece.num_rows
            batch = batch.slice(piece.num_rows)
    if rows:
        yield pa.Table.from_batches(held)


def variants(vocabulary: DataFrame, least: int = 7, hot: int = HOT) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of each row of ``vocabulary``, different words of at least
    ``least`` characters with their counts."""
    vocabulary = cut(vocabulary.select("word", "n"))
    cells = _cells(_dealt(vocabulary, least), hot)
    found = cells.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell", "kind", "w").mapInArrow(
        _search, "word string, n_near long, form_n long, form string")
    most = F.min(F.when(F.col("form_n").isNotNull(), F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("w"))))
    all_words = vocabulary.select("word", "n", F.lit(0).alias("n_near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"))
    rows = (all_words.unionByName(found.select("word", F.lit(None).cast("long").alias("n"), "n_near", "form_n", "form"))
            .groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), most.alias("most")))
    frequent = -F.col("most.n") >= TIMES * F.col("n")
    rows = cut(rows.select("word", "n", "n_near", F.when(frequent, F.col("most.w")).alias("form"), F.when(frequent, -F.col("most.n")).alias("form_n")))
    return rows.join(_roots(rows), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(rows: DataFrame) -> DataFrame:
    """``word`` and ``root`` of the words that have a form."""
    roots = rows.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = cut(roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return roots
