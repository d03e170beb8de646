"""Toxicity, spelling variants and hard negatives: against brute force on small tables, with nulls, ties, repeats and clashes."""

import collections
import itertools
import math
import random
import re
from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.llm import hard_negatives, queries, spelling, toxicity


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[p + (len(a) >= len(b)):] == b[p + (len(b) >= len(a)):]


def variants(counts: dict[str, int]) -> set[tuple]:
    out = {}
    for w, n in counts.items():
        near = sorted((x for x in counts if one_edit(w, x)), key=lambda x: (-counts[x], x))
        form = near[0] if near and counts[near[0]] >= 10 * n else None
        out[w] = (form, n, len(near), counts[form] if form else None)
    root = lambda w: root(out[w][0]) if out[w][0] else w
    return {(w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items()}


@pytest.mark.parametrize("hot", [20_000, 5])
def test_variants(spark, hot):
    """All words of few letters, and long ones; with a small limit every bucket is a grid of cells."""
    pick = random.Random(3)
    base = ["".join(pick.choice("abß") for _ in range(pick.randint(7, 9))) for _ in range(150)]
    base += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "x" * 3000, "x" * 1500 + "y" + "x" * 1499, "x" * 3001, "ÿ×÷ÿ×÷ÿ×", "ÿ×÷ÿ×÷ÿ"]
    counts = {w: 10 ** pick.randint(0, 4) for w in base}
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), hot=hot)
    assert set(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect())) == variants(counts)
    assert got.count() == len(counts)


def test_chains_of_forms(spark):
    counts = {"chained" + "s" * k: 10 ** (k + 1) for k in range(12)}
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert {r.root for r in got.collect()} == {"chained" + "s" * 11}


def test_words(spark):
    rows = [(1, "Repeated REPEATED, repeated-repeatez\x00Über", 1), (1, "Repeated", 2), (None, "repeated", 0), (2, None, 0), (3, "", 0), (4, "Élève_élèves ÉLÈVES", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word int")
    want = {"repeated": 5, "repeatez": 1, "élèves": 1, "ÉlÈves": 1}
    assert {r.word: r.n for r in spelling.words(docs, least=6).collect()} == want
    assert spelling.variants(spelling.words(docs.where("doc_id = 9"))).count() == 0
    lost = spelling.words(docs, least=6, altered=queries.one_letter_lost)
    assert lost.agg(F.sum("n")).first()[0] <= 8


def negatives(rows, is_anchor, k=5, low=80):
    """(anchor, positive, rank, negative, score, score) of (id, label, vector) rows."""
    good = {(i, str(c), tuple(math.floor(256 * x) for x in v)) for i, c, v in rows
            if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in good:
        if not is_anchor(a[0]):
            continue
        scores = sorted(((sum(x * y for x, y in zip(a[2], r[2])), r) for r in good if r != a and len(r[2]) == len(a[2])),
                        key=lambda x: (-x[0], x[1][0]))
        for p, row in [x for x in scores if x[1][1] == a[1]][:k]:
            inside = [(n, r[0]) for n, r in scores if r[1] != a[1] and low * p <= 100 * n <= 100 * p][:k]
            out += [(a[0], row[0], rank + 1, i, p, n) for rank, (n, i) in enumerate(inside)]
    return collections.Counter(out)


@pytest.mark.parametrize("block", [8192, 7])
def test_hard_negatives(spark, block):
    pick = random.Random(5)
    rows = [(i, pick.choice([0, 0, 0, 1, 2]), [pick.choice([-0.5, -0.25, 0.0, 0.25, 0.5, 0.75]) + pick.random() / 9 for _ in range(20)]) for i in range(160)]
    rows += [(200 + i, i % 2, [1.0, 0.5, 0.25]) for i in range(30)]  # ties, shorter vectors
    rows += [(300, 0, None), (301, None, [0.1] * 20), (None, 1, [0.1] * 20), (302, 1, [0.1, None] * 10), (303, 1, [float("nan")] * 20),
             (304, 1, [float("inf")] * 20), (305, 1, []), (306, 0, []), (20, rows[20][1], rows[20][2]), (40, 2, [0.5] * 20), (307, 1, [0.0] * 20)]
    table = spark.createDataFrame([(*r, 7, 7) for r in rows], "vec_id long, label int, embedding array<double>, row int, score int")
    got = hard_negatives.mine(table, F.col("id") % 10 == 0, block=block)
    assert collections.Counter(map(tuple, got.collect())) == negatives(rows, lambda i: i % 10 == 0)
    assert hard_negatives.mine(table.where("vec_id < 0"), F.lit(True)).count() == 0


def test_hard_negatives_of_great_components(spark):
    """Sums beyond 53 and 63 bits are compared exactly."""
    rows = [(i, i % 2, [float(2**45 + 4 * i), float(2**45 - i), 1.0]) for i in range(12)] + [(20 + i, i % 2, [2.0**30 + i, 2.0**30, 3.0]) for i in range(12)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = hard_negatives.mine(table, F.col("id") % 4 == 0)
    top = 2**63 - 1
    want = collections.Counter()
    for (a, p, rank, i, x, y), n in negatives(rows, lambda i: i % 4 == 0).items():
        want[a, p, rank, i, min(x, top), min(y, top)] += n
    assert collections.Counter(map(tuple, got.collect())) == want


def test_vertical_scan_leaves_no_one_out():
    """The scan keeps whatever a condition on final scores needs, for bounds of either sign."""
    pick = np.random.default_rng(1)
    import pyarrow as pa
    v = pick.integers(-9, 9, (60, 33))
    block = hard_negatives.Block([pa.RecordBatch.from_pydict(
        {"row": list(range(60)), "id": list(range(60)), "label": ["a"] * 60, "v": pa.array(v.tolist(), pa.list_(pa.int64()))})])
    anchor = pick.integers(-9, 9, 33)
    want = v @ anchor
    looks = []

    def leave(lower, upper, ids):
        assert (lower <= want[ids]).all() and (want[ids] <= upper).all()
        looks.append(len(ids))
        return upper >= np.sort(lower)[-5]

    alive, score = block.scan(anchor.astype(float), np.arange(60), leave)
    assert (score == want[alive]).all() and set(np.argsort(-want, kind="stable")[:3]) <= set(alive.tolist()) and looks[-1] < looks[0]


def readings(text, i=0):
    """Every path through a lattice: what it reads and the channel's cost."""
    if i == len(text):
        yield "", 0.0
        return
    for j, out, cost in toxicity.arcs(text, i):
        for rest, more in readings(text, j):
            yield out + rest, cost + more


def probability(read, model):
    at, total = 0, 0.0
    for y in [*(int(toxicity.CLASS[ord(c)]) for c in read), 0]:
        total += model[at << 5 | y]
        at = (at << 5 | y) & 0x7FFF
    return total


def test_decoding_finds_the_best_path():
    pick = random.Random(7)
    sample = "you idiot, the trash is here. loser! in 2024 a moron said stupid things 100 % of it www.a.b " * 3
    counts = np.zeros(toxicity.SEQUENCES)
    k = toxicity.classes(sample).astype(int)
    np.add.at(counts, (k[:-3] << 15) | (k[1:-2] << 10) | (k[2:-1] << 5) | k[3:], 1)
    model = array("d", toxicity.interpolated(counts).tobytes())
    for _ in range(150):
        text = "".join(pick.choice("idot1!0l $aa.") for _ in range(pick.randint(1, 7))).strip() or "a"
        best = max(cost + probability(read, model) for read, cost in readings(text))
        got = toxicity.decode(text, model)
        assert max(cost + probability(read, model) for read, cost in readings(text) if read == got) == pytest.approx(best)
    for disguised, plain in {"1d10t": "idiot", "i d i o t": "idiot", "tr@sh": "trash", "stuuuupid": "stupid", "l.o.s.e.r": "loser", "m0r0n": "moron"}.items():
        assert toxicity.Restorer(model).text(disguised) == plain
    untouched = "the 2024 things, of 100 % idiot. !!! ... 3"
    assert toxicity.Restorer(model).text(untouched) == untouched


def test_language_model_counts_every_document(spark):
    texts = ["ab ab", None, "", "  Aé1!\n\n", "x" * 5000, "日本 𝒳 ok"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    counts = np.zeros(toxicity.SEQUENCES)
    for t in texts:
        k = [0, *(toxicity._class_of(ord(c)) if ord(c) < 65536 else toxicity.SYMBOL for c in re.sub(r"\s+", " ", (t or "").strip())), 0]
        for w in zip(k, k[1:], k[2:], k[3:]):
            counts[w[0] << 15 | w[1] << 10 | w[2] << 5 | w[3]] += 1
    assert np.allclose(toxicity.language_model(docs), toxicity.interpolated(counts))
    model = np.exp(toxicity.interpolated(counts)).reshape(-1, 32)
    assert np.allclose(model[:, : toxicity.CLASSES].sum(axis=1), 1, atol=1e-6)


DISGUISE = str.maketrans({"i": "1", "o": "0", "a": "@", "s": "$", "e": "3"})


def test_toxicity_is_found(spark):
    """Held-out labels of the given documents, and the same texts with the marked words in disguise."""
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op11_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert sum(r.toxic == r.predicted for r in rows) >= 0.93 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    model = toxicity.language_model(docs)
    classifier = toxicity.fit(docs, labels, model, ~toxicity.held_out(F.col("id")))
    marked = [w for w in classifier.weights if not w.endswith("*")]
    assert len(marked) >= 5
    shown = got.where("predicted = 1").join(docs, "doc_id").select("text").limit(20).collect()
    hide = re.compile(r"\b(" + "|".join(marked) + r")\b")
    scorer = toxicity.Scorer(classifier, toxicity.Restorer(array("d", model.tobytes())))
    disguised = [hide.sub(lambda m: m[0].translate(DISGUISE), r.text) for r in shown]
    assert sum(scorer(t)[0] >= 0.5 for t in disguised) >= 0.9 * len(disguised)
    spaced = [hide.sub(lambda m: ".".join(m[0]), r.text) for r in shown]
    assert sum(scorer(t)[0] >= 0.5 for t in spaced) >= 0.9 * len(spaced)


def test_toxicity_cases(spark):
    pick = random.Random(2)
    plain = lambda: " ".join(pick.choice("the plain words of a text that go on and on".split()) for _ in range(40))
    rows = [(i, plain() + (" vile vile" if i % 3 == 0 else " fine"), 5) for i in range(90)]
    rows += [(None, None, 5), (1000, "", 5), (1001, " \t\n", 5), (1002, "V 1 L E v1le words", 5), (1003, "x " * 100_000 + "vi" * 50_000, 5), (3, rows[3][1], 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(1, None), (None, 1), (3, 0), (5000, 1)], "doc_id long, toxic int")
    model = toxicity.language_model(docs)
    classifier = toxicity.fit(docs, labels, model, ~toxicity.held_out(F.col("id")))
    got = toxicity.scored(docs, classifier, model)
    assert got.select("doc.*").columns == docs.columns and got.count() == len(rows)
    for r in got.collect():
        assert (r.score >= 0.5) == (r.doc.text is not None and "vile" in r.doc.text or r.doc.doc_id == 1002)
    assert toxicity.scored(docs.where("doc_id = -1"), classifier, model).count() == 0
    for none in (labels.where("toxic = 7"), labels.where("toxic = 0 AND doc_id <> 3")):
        flat = toxicity.fit(docs, none, model, F.lit(True))
        assert flat.weights == {} and flat.intercept <= 0
    assert toxicity.restored(docs.where("doc_id = 1002"), model).first().restored.startswith("vile vile")
    assert toxicity.fit(docs, labels, model, F.lit(True), most_rows=30) == toxicity.fit(docs.repartition(7), labels, model, F.lit(True), most_rows=30)


def test_held_out_rule(spark):
    import zlib
    got = spark.range(40).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_one_edit_is_what_it_says():
    words = ["".join(w) for n in range(4) for w in itertools.product("ab", repeat=n)]
    for a in words:
        near = {a[:i] + c + a[i + d:] for i in range(len(a) + 1) for c in ("", "a", "b") for d in (0, 1)} - {a}
        assert all(one_edit(a, b) == (b in near) for b in words)
