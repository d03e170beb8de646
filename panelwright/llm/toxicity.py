"""Toxicity of text written to escape filters: a noisy channel undoes the disguise, then the restored text is scored.

Language model: a model of four characters over 30 classes (letters a to z, other letters, digits, other characters, white
space), interpolated down to single characters (Witten and Bell), counted over all documents. Tasks count densely and send
one row for each different sequence, of which there are at most 30**4; so the table that is broadcast has a fixed bound.

Channel: a stretch of text is a word, or single characters set apart by blanks. Its lattice has an arc for each reading: a
character as it stands, a letter that it may stand for (``1d10t``), a separator put between letters that is dropped
(``i.d.i.o.t``, ``i d i o t``), a run of one letter shortened to one or two (``idiooot``). Viterbi decoding finds the path of
greatest probability under channel and model. Stretches of letters only, without such a run, have one path and stay.

Score: a logistic regression over the words of the restored text and their beginnings, by presence and by share of the text.
It is fitted on at most ``MOST_ROWS`` labelled rows (those with the smallest hash of their id); copies of a text, told by the
least hash of their word windows, count as one document together. Words and beginnings enter by a likelihood-ratio test at a
level of 1 % over all that are tested; the ``MOST_TRAITS`` with the highest ratio make the model. Texts are never shuffled.

Cases: a null or empty text has no words and the score of the intercept. Texts of any length are read whole. Rows that
repeat are scored each. A label counts as 1 if any row of its id says so; null labels are no labels. Without labels, or with
one class alone, the score is the smoothed share of label 1. An id that is null counts as an empty text when documents are
held out. An empty table gives an empty result; extra columns are carried in ``doc``.
"""

from __future__ import annotations

import collections
import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import column, cut, text_or_empty, whole_row

#: Rows that the classifier is fitted on, traits in it, level of the test that lets traits in, strength of the L2 penalty.
MOST_ROWS, MOST_TRAITS, LEVEL, PENALTY = 20_000, 256, 0.01, 0.1
#: Lengths of the beginnings of words that are traits.
BEGINNINGS = (4, 5, 6, 7)
#: Classes of characters: 0 white space, 1 to 26 letters, then these. Five bits each.
OTHER_LETTER, DIGIT, SYMBOL, CLASSES, BITS = 27, 28, 29, 30, 5
SEQUENCES = 1 << (4 * BITS)
#: What a character may stand for (fixed values).
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il",
    "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¥": "y",
}
#: Between two letters, these may hide a vowel (fixed values).
MASKS, HIDDEN = "*#%", "aeiou"
PAIRS = {"()": "o", "|)": "d", "|<": "k", "/\\": "a", "\\/": "v"}
SEPARATORS = frozenset(" \t.,-_*~'·/\\:")
#: Logarithms of the channel's probabilities; a substitution shares its own among its readings.
SUBSTITUTED, DROPPED, SHORTENED = math.log(0.2), math.log(0.1), math.log(0.2)

STRETCH = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)|\S+")
TRIPLE = re.compile(r"([^\W\d_])\1\1")
LETTERS = re.compile(r"[^\W\d_]+")
EDGES = ".,;:?\"'()[]{}"
PLAIN_EDGES = EDGES + "!"
#: Stretches remembered by a task.
REMEMBERED = 200_000


def _class_of(code: int) -> int:
    c = chr(code).lower()
    if c.isspace():
        return 0
    if "a" <= c[0] <= "z":
        return ord(c[0]) - 96
    return DIGIT if c.isdigit() else OTHER_LETTER if c.isalpha() else SYMBOL


CLASS = np.array([_class_of(k) for k in range(1 << 16)], np.uint8)


def classes(text: str) -> np.ndarray:
    """The class of each character; a run of white space is one character."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.where(codes < len(CLASS), CLASS[np.minimum(codes, len(CLASS) - 1)], SYMBOL)
    return found[~((found == 0) & (np.concatenate([[1], found[:-1]]) == 0))] if len(found) else found


def _sequences(batches) -> Iterator[pa.RecordBatch]:
    counts, held = np.zeros(SEQUENCES, np.int64), []
    for batch in batches:
        for text in batch.column("text").to_pylist():
            # a document between blanks; at most a million characters at a time, overlapping by what a sequence needs
            text = f" {text} "
            for at in range(0, len(text), 1 << 20):
                k = classes(text[max(0, at - 3): at + (1 << 20)]).astype(np.int32)
                held.append((k[:-3] << 3 * BITS) | (k[1:-2] << 2 * BITS) | (k[2:-1] << BITS) | k[3:])
            if sum(map(len, held)) > 1 << 22:
                counts += np.bincount(np.concatenate(held), minlength=SEQUENCES)
                held = []
    counts += np.bincount(np.concatenate([np.empty(0, np.int32), *held]), minlength=SEQUENCES)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen])], ["sequence", "n"])


def language_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The logarithm of the probability of a character after three others, by the number of the sequence."""
    rows = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(_sequences, "sequence int, n long")
    table = rows.groupBy("sequence").agg(F.sum("n").alias("n")).toArrow()  # at most CLASSES ** 4 rows
    counts = np.zeros(SEQUENCES)
    counts[table["sequence"].to_numpy()] = table["n"].to_numpy()
    return interpolated(counts)


def interpolated(counts: np.ndarray) -> np.ndarray:
    """Each order gives way to the next lower by the number of different characters seen after a context."""
    size = 1 << BITS
    by_order = [counts.reshape((size,) * 4)]
    while by_order[-1].ndim > 1:
        by_order.append(by_order[-1].sum(axis=0))
    p = np.where(np.arange(size) < CLASSES, 1 / CLASSES, 1e-9)
    for c in reversed(by_order):
        total, kinds = c.sum(axis=-1, keepdims=True), (c > 0).sum(axis=-1, keepdims=True)
        p = np.where(total > 0, (c + kinds * p) / np.maximum(total + kinds, 1), p)
    return np.log(p).reshape(-1)


def arcs(text: str, i: int) -> list[tuple[int, str, float]]:
    """The readings of what starts at i: where they go on, what they read, and the channel's part of the cost."""
    c = text[i]
    found = [(i + 1, c, 0.0)]
    stands_for = STANDS_FOR.get(c, "")
    if c in MASKS and 0 < i < len(text) - 1 and text[i - 1].isalpha() and text[i + 1].isalpha():
        stands_for = HIDDEN
    found += [(i + 1, x, SUBSTITUTED - math.log(len(stands_for))) for x in stands_for]
    if text[i: i + 2] in PAIRS:
        found.append((i + 2, PAIRS[text[i: i + 2]], SUBSTITUTED))
    if c in SEPARATORS and 0 < i < len(text) - 1:
        found.append((i + 1, "", DROPPED))
    if c.isalpha() and (i == 0 or text[i - 1] != c):
        end = i + 1
        while end < len(text) and text[end] == c:
            end += 1
        if end - i > 1:
            found.append((end, c, SHORTENED))
        if end - i > 2:
            found.append((end, c + c, SHORTENED))
    return found


def decode(text: str, model) -> str:
    """The most probable reading of a stretch. Of equal ones, the first that keeps more as it stands."""
    all_arcs = [arcs(text, i) for i in range(len(text))]
    if all(len(a) == 1 for a in all_arcs):
        return text
    layers: list[dict] = [{} for _ in range(len(text) + 1)]
    layers[0][0] = (0.0, None)
    mask = (1 << 3 * BITS) - 1
    for i in range(len(text)):
        if not layers[i]:
            continue
        ways = [(layers[j], out, [int(CLASS[min(ord(x), 0xFFFF)]) for x in out], cost) for j, out, cost in all_arcs[i]]
        for context, (value, back) in layers[i].items():
            for layer, out, symbols, cost in ways:
                at, v = context, value + cost
                for y in symbols:
                    v += model[at << BITS | y]
                    at = (at << BITS | y) & mask
                old = layer.get(at)
                if old is None or v > old[0]:
                    layer[at] = (v, (back, out))
        layers[i] = None  # the paths hold what is needed of it
    _, back = max(((v + model[at << BITS], back) for at, (v, back) in layers[-1].items()), key=lambda x: x[0])
    read = []
    while back is not None:
        back, out = back
        read.append(out)
    return "".join(reversed(read))


def plain_word(stretch: str, runs: bool) -> str | None:
    """The word of a stretch that has one reading: letters, perhaps between punctuation. ``runs``: whether some letter may
    stand three times in a row."""
    core = stretch if stretch.isalpha() else stretch.strip(PLAIN_EDGES)
    return core if core.isalpha() and not (runs and TRIPLE.search(core)) else None


class Restorer:
    """Restores stretches and remembers them."""

    def __init__(self, model):
        self.model, self.seen = model, {}

    def stretch(self, text: str) -> str:
        if plain_word(text, True) is not None or not any(map(str.isalpha, text)):
            return text  # numbers and signs without a letter are taken as such
        core = text.strip(EDGES)
        if not core:
            return text
        at = text.index(core)
        return text[:at] + decode(core, self.model) + text[at + len(core):]

    def text(self, text: str) -> str:
        return STRETCH.sub(lambda m: self.stretch(m[0]), text.lower())

    def words(self, stretch: str) -> tuple[str, ...]:
        """The words of a restored stretch."""
        words = self.seen.get(stretch)
        if words is None:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            words = self.seen[stretch] = tuple(LETTERS.findall(self.stretch(stretch)))
        return words


def _restorer(shared) -> Restorer:
    return Restorer(array("d", shared.value.tobytes()))


def restored(docs: DataFrame, model: np.ndarray, text_col: str = "text") -> DataFrame:
    """``doc`` (the whole row) and ``restored``, the lower-cased text without its disguise."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        restorer = _restorer(shared)
        for batch in batches:
            texts = [restorer.text(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], ["doc", "restored"])

    rows = docs.select(whole_row(docs), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(work, rows.select("doc", F.col("text").alias("restored")).schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def traits(word: str) -> list[str]:
    """A word and its beginnings: words of one stem are often marked together."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


def counted(text: str, restorer: Restorer) -> tuple[collections.Counter, int]:
    """How often the restored text has each trait, and its words."""
    found, words = collections.Counter(), 0
    for stretch, times in collections.Counter(STRETCH.findall(text.lower())).items():
        for word in restorer.words(stretch):
            words += times
            for trait in traits(word):
                found[trait] += times
    return found, words


def strength(times, words):
    """How much of a text a trait is: in percent of its words, 3 at most."""
    return min(100 * times / words, 3.0) if words else 0.0


@dataclass
class Classifier:
    """Weights for a trait's presence and for its strength."""

    intercept: float
    weights: dict[str, tuple[float, float]]

    def score(self, found: dict[str, int], words: int) -> float:
        parts = [self.weights[f] for f in found]
        total = math.fsum([self.intercept, *(a + b * strength(found[f], words) for f, (a, b) in zip(found, parts))])
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))


class Scorer:
    """Scores texts; remembers which weighed traits a stretch has that is not plain."""

    def __init__(self, classifier: Classifier, restorer: Restorer):
        self.classifier, self.restorer, self.seen = classifier, restorer, {}
        shortest = min(BEGINNINGS)
        self.starts = {f.rstrip("*")[:shortest] for f in classifier.weights}
        self.shortest = shortest

    def _weighed(self, word: str) -> list[str]:
        return [f for f in traits(word) if f in self.classifier.weights] if word[: self.shortest] in self.starts else []

    def _hits(self, stretch: str) -> tuple[int, list[str]]:
        words = LETTERS.findall(self.restorer.stretch(stretch))
        return len(words), [f for w in words for f in self._weighed(w)]

    def __call__(self, text: str) -> tuple[float, list[str]]:
        """The score, and the traits found that speak for label 1."""
        text = text.lower()
        found, n, seen, starts, short = collections.Counter(), 0, self.seen, self.starts, self.shortest
        runs = TRIPLE.search(text) is not None
        for stretch in STRETCH.findall(text):
            word = plain_word(stretch, runs)
            if word is not None:
                n += 1
                if word[:short] in starts:
                    found.update(self._weighed(word))
                continue
            hit = seen.get(stretch)
            if hit is None:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                hit = seen[stretch] = self._hits(stretch)
            n += hit[0]
            if hit[1]:
                found.update(hit[1])
        return self.classifier.score(found, n), sorted(f for f in found if sum(self.classifier.weights[f]) > 0)


def _window_print(words: list[str]) -> int:
    """The least hash of five words in a row; texts that are nearly the same tend to share it."""
    windows = range(max(1, len(words) - 4))
    return min(xxhash.xxh64_intdigest(" ".join(words[i: i + 5])) for i in windows) >> 1


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray, learnt_from: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", most_rows: int = MOST_ROWS) -> Classifier:
    """``learnt_from`` is a condition over ``id``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    named = labels.select(column(id_col).alias("id"), column(label_col).cast("int").alias("label")).where("label IS NOT NULL AND id IS NOT NULL")
    # at most most_rows pairs
    chosen = named.where(learnt_from).groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(most_rows)

    def work(batches):
        restorer = _restorer(shared)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [counted(t, restorer) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([_window_print(t.lower().split()) for t in texts], pa.int64()),
                 pa.array([n for _, n in found], pa.int64()), pa.array([list(c.items()) for c, _ in found], pa.map_(pa.string(), pa.int64()))],
                ["label", "copies", "words", "traits"])

    rows = docs.select(column(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), "id").select("label", "text")
    rows = cut(rows.mapInArrow(work, "label int, copies long, words long, traits map<string, long>"))
    weight = rows.groupBy("copies").agg((1 / F.count(F.lit(1))).alias("weight"))
    rows = rows.join(F.broadcast(weight), "copies")
    total = rows.agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("bad")).first()
    n, bad = total["n"] or 0.0, total["bad"] or 0.0
    plain = Classifier(math.log((bad + 0.5) / (n - bad + 0.5)), {})
    if not 0 < bad < n:
        return plain
    held = cut(rows.select(F.explode(F.map_keys("traits")).alias("trait"), "weight", (F.col("weight") * F.col("label")).alias("bad"))
               .groupBy("trait").agg(F.sum("weight").alias("n"), F.sum("bad").alias("bad")))
    # twice the logarithm of the likelihood ratio of a trait's share of label 1, in texts with it and without
    part = lambda k, of, p: F.when(k > 1e-9, k * F.log(k / (of * p))).otherwise(0.0)
    k, m = F.col("bad"), F.col("n")
    other_k, other_m = F.greatest(F.lit(0.0), bad - k), F.greatest(F.lit(0.0), n - m)
    ratio = 2 * (part(k, m, bad / n) + part(m - k, m, 1 - bad / n) + part(other_k, other_m, bad / n) + part(other_m - other_k, other_m, 1 - bad / n))
    least = 2 * math.log(max(held.count(), 1) / LEVEL)
    chosen_traits = [r["trait"] for r in held.select("trait", ratio.alias("ratio")).where(F.col("ratio") >= least)
                     .orderBy(F.round("ratio", 6).desc(), "trait").limit(MOST_TRAITS).collect()]
    if not chosen_traits:
        return plain
    # at most most_rows rows of at most MOST_TRAITS traits
    table = rows.select("label", "weight", "words", F.map_filter("traits", lambda f, _: f.isin(chosen_traits)).alias("traits")).toArrow()
    place = {f: i for i, f in enumerate(chosen_traits)}
    x = np.zeros((table.num_rows, 2 * len(place) + 1))
    x[:, -1] = 1
    for i, (words, found) in enumerate(zip(table["words"].to_pylist(), table["traits"].to_pylist())):
        for f, times in found:
            x[i, 2 * place[f]: 2 * place[f] + 2] = 1, strength(times, words)
    beta = logistic(x, table["label"].to_numpy().astype(float), table["weight"].to_numpy())
    return Classifier(float(beta[-1]), {f: (float(beta[2 * i]), float(beta[2 * i + 1])) for f, i in place.items()})


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton's method; the last column, the intercept, isn't penalised."""
    # sums in a fixed order, so that reruns agree
    order = np.lexsort((*x.T, y, weight))
    x, y, weight = x[order], y[order], weight[order]
    beta, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], PENALTY)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty * beta
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), slope)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def scored(docs: DataFrame, classifier: Classifier, model: np.ndarray, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``doc`` (the whole row, or the columns to ``carry``), ``score`` from 0 to 1 and ``traits``, those found that speak for label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        scorer = Scorer(classifier, _restorer(shared))
        for batch in batches:
            found = [scorer(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array([x for x, _ in found], pa.float64()), pa.array([f for _, f in found], pa.list_(pa.string()))],
                ["doc", "score", "traits"])

    row = whole_row(docs) if carry is None else F.struct(*[column(c).alias(c) for c in carry]).alias("doc")
    rows = docs.select(row, text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(work, rows.select("doc", F.lit(0.0).alias("score"), F.array(F.lit("")).alias("traits")).schema)
