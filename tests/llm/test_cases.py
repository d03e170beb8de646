"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, against brute force."""

import collections

import numpy as np
import pytest

from panelwright.llm import curriculum, embedding_dedup, html_blocks, html_extract, hyperminhash, line_dedup, packing, pii, quality_rules, suffix_dedup

from . import brute

LONG = " ".join(f"w{i % 977}x{i * 7919 % 10007}" for i in range(30_000))
SAME = "One line.\nAnother line with words in it, shared by some.\n\n  ONE LINE.  \nthe end"
NEAR = " ".join(f"near{i}" for i in range(200))
ROWS = [
    (1, SAME, "b"), (2, SAME, "a"), (3, SAME.upper(), None), (None, SAME, "a"), (None, None, "a"), (4, None, None), (5, "", "b"), (6, " \t\n", "é"),
    (7, LONG, "b"), (7, LONG, "b"), (8, LONG + " tail", "z"), (9, NEAR, "a"), (10, NEAR.replace("near5 ", "far5 "), "a"),
    (11, "x" * 700, "a"), (12, "ab" * 300 + "\n" + "!! " * 50, "a"), (13, "short", "a"), (14, "short", "a"), (14, "Short text\nshort", "a"),
    (15, NEAR.replace("near150", "y").replace("near20 ", "z "), "b"), (16, "日本語 テキスト " * 60, "b"), (17, "a\x00b \x1c c d" * 40, "b"),
]
#: Names that the operators use themselves.
CLASH = ["id", "doc", "n", "node", "text_", "size", "target", "length", "kept", "digest", "_text", "tid"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, *range(len(CLASH))) for r in ROWS]
    kind = "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in CLASH)
    return spark.createDataFrame(rows, kind).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("doc_id = -1")


def bag(rows):
    return collections.Counter(map(tuple, rows))


def test_quality_rules(docs, empty):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = quality_rules.ledger(docs).select("doc.doc_id", *names, (~quality_rules.passes("v1")).alias("f"), quality_rules.passes("v2").alias("k"))
    assert bag(got.collect()) == bag((i, *brute.quality(t).values()) for i, t, _ in ROWS)
    kept = quality_rules.kept(docs)
    assert kept.columns == docs.columns and kept.count() == sum(brute.quality(t)["kept"] for _, t, _ in ROWS)
    assert quality_rules.ledger(empty).count() == 0
    rows = quality_rules.ledger(docs)
    for r in quality_rules.ablation(rows, "v2").collect():
        bit = {x.name: 1 << x.bit for x in quality_rules.RULES}[r.rule]
        masks = [x.failed & quality_rules.mask(quality_rules.POLICIES["v2"]) for x in rows.select("failed").collect()]
        assert (r.n_failed, r.n_failed_alone) == (sum(bool(m & bit) for m in masks), masks.count(bit))


@pytest.mark.parametrize("keep", ["none", "first"])
def test_line_dedup(docs, empty, keep):
    got = line_dedup.dedup(docs, min_docs=3, keep=keep).select("doc.doc_id", "kept_text", "n_lines", "n_dropped")
    assert bag(got.collect()) == bag(brute.line_dedup([r[:2] for r in ROWS], 3, keep == "first"))
    assert line_dedup.deduplicated(docs, min_docs=3, keep=keep).columns == docs.columns
    assert line_dedup.dedup(empty).count() == 0


def test_line_dedup_with_full_filters(docs):
    """Filters of the least size hit for nearly every line; the result is the same."""
    got = line_dedup.dedup(docs, min_docs=3, most_filter_bytes=1024).select("doc.doc_id", "kept_text", "n_lines", "n_dropped")
    assert bag(got.collect()) == bag(brute.line_dedup([r[:2] for r in ROWS], 3))


def test_hyperminhash(docs, empty):
    got = hyperminhash.near_duplicates(docs).select("id", "n_shingles", "component_id", "kept")
    assert bag(got.collect()) == bag(brute.near_duplicates([r[:2] for r in ROWS]))
    assert hyperminhash.one_of_each(docs).columns == docs.columns
    assert hyperminhash.near_duplicates(empty).count() == 0


def test_hyperminhash_chain_in_blocks(spark, monkeypatch):
    """A chain of texts, each near the next one only, is one component; so it is when buckets are cut into small blocks."""
    monkeypatch.setattr(hyperminhash, "BLOCK", 4)
    monkeypatch.setattr(hyperminhash, "SPOKES", 3)
    words = [f"c{i}" for i in range(300)]
    rows = []
    for i in range(40):
        words = [f"n{i}.{k}" if k // 5 == i else w for k, w in enumerate(words)]
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = hyperminhash.near_duplicates(frame).select("id", "n_shingles", "component_id", "kept")
    assert bag(got.collect()) == bag(brute.near_duplicates(rows))


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_hyperminhash_at_the_threshold(spark, percent):
    """Pairs at and around the threshold, of sets down to the smallest that can reach it."""
    rows = []
    for n in (4, 5, 6, 8, 19, 20, 40, 100, 300):
        for extra in range(n + 1):
            if extra in (0, 1, 2) or abs(100 * n - percent * (n + extra)) < 400:
                words = [f"p{n}.{extra}.{k}" for k in range(n + 4 + extra)]
                rows += [(len(rows), " ".join(words[:n + 4])), (len(rows) + 1, " ".join(words))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = hyperminhash.near_duplicates(frame, percent=percent).select("id", "n_shingles", "component_id", "kept")
    assert bag(got.collect()) == bag(brute.near_duplicates(rows, percent))


def test_bands_follow_from_the_threshold():
    assert hyperminhash.banding(85) == (21, 6) and hyperminhash.banding(80) == (25, 5)
    for percent in range(8, 100):
        bands, length = hyperminhash.banding(percent)
        assert bands * length <= hyperminhash.REGISTERS and (1 - (percent / 100) ** length) ** bands <= 5e-5


@pytest.mark.parametrize("most_runs", [20_000, 1])
def test_suffix_dedup(docs, empty, most_runs):
    got = suffix_dedup.remove_repeats(docs, length=200, most_runs=most_runs)
    assert bag((r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()) == bag(brute.repeats([r[:2] for r in ROWS], 200))
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_curriculum(docs, empty):
    got = curriculum.taken(curriculum.placed(docs, carry=False)).collect()
    targets, _ = brute.mix(ROWS)
    taken = collections.Counter()
    for r in got:
        target, size = targets[r.source]
        assert r.source_size == size and r.target == pytest.approx(target) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        assert (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1)
    assert len(got) == len(ROWS) and all(abs(taken[s] - t) < 1 for s, (t, _) in targets.items())
    assert curriculum.taken(curriculum.placed(empty)).count() == 0 and curriculum.mix(empty).count() == 0
    again = curriculum.taken(curriculum.placed(docs.repartition(5), carry=False))
    assert bag((r.doc.doc_id, r.taken) for r in again.collect()) == bag((r.doc.doc_id, r.taken) for r in got)


def test_curriculum_moves_sources_in_time(spark):
    """Light sources come early and heavy ones late, as their schedules say, and the shares stay."""
    rows = [(i, "a b c d", "xyz"[i % 3]) for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = curriculum.taken(curriculum.placed(frame)).groupBy("source").agg({"position": "avg", "taken": "sum"}).collect()
    mean = {r.source: r["avg(position)"] for r in first}
    assert mean["x"] == pytest.approx(5 / 12, abs=0.01) and mean["y"] == pytest.approx(0.5, abs=0.01)
    order = [r.source for r in curriculum.mix(frame, partitions=4).collect()]
    half = len(order) // 2
    assert order[:half].count("x") > order[half:].count("x") and order[:half].count("z") < order[half:].count("z")


def test_packing(docs, empty, spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    got = packing.pack(docs, group=7).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert bag((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == bag(brute.pieces([r[:2] for r in ROWS], tokenizer, 2048))
    check_places([(r.sequence_id, r.offset, r.length) for r in got], 2048)
    assert packing.pack(empty).count() == 0
    ids = packing.tokenized(docs, with_ids=True).collect()
    assert all(len(r.ids) == 4 * r.length for r in ids)


def check_places(rows, room):
    filled = collections.defaultdict(list)
    for name, offset, length in rows:
        filled[name].append((offset, length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    return len(filled)


def test_bounds_never_exceed_the_best_packing():
    draw = np.random.default_rng(3)
    for _ in range(40):
        lengths = draw.integers(1, 21, size=8)
        best = fewest(sorted(lengths.tolist(), reverse=True), 20)
        assert packing.lower_bound(lengths, 20) <= best <= packing.best_fit(lengths, 20).max() + 1


def fewest(lengths, room):
    def fits(k, rest, bins):
        if not rest:
            return True
        tried = set()
        for i, left in enumerate(bins):
            if left >= rest[0] and left not in tried:
                tried.add(left)
                if fits(k, rest[1:], [*bins[:i], left - rest[0], *bins[i + 1:]]):
                    return True
        return False
    return next(k for k in range(1, len(lengths) + 1) if fits(k, lengths, [room] * k))


def test_embeddings(spark):
    draw = np.random.default_rng(1)
    base = draw.standard_normal((60, 16))
    rows = [(i, v.tolist(), i) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 7] + 0.05 * draw.standard_normal(16)).tolist(), 0) for i in range(40)]
    rows += [(200, base[0].tolist(), 1), (201, (3 * base[0]).tolist(), 1), (201, (3 * base[0]).tolist(), 1), (None, base[0].tolist(), 2), (202, None, 0),
             (203, [], 0), (204, [0.0] * 16, 0), (205, [float("nan")] * 16, 0), (206, [1.0, None] * 8, 0), (207, base[0][:8].tolist(), 0), (None, None, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int").repartition(3)
    got = embedding_dedup.near_duplicates(frame).collect()
    joined = brute.Sets(len(rows))
    n = [0] * len(rows)
    good = [v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v) for _, v, _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            x, y = rows[a][1], rows[b][1]
            if good[a] and good[b] and len(x) == len(y) and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                n[a], n[b] = n[a] + 1, n[b] + 1
                joined.join(a, b)
    least = {}
    for i, (name, *_) in enumerate(rows):
        if name is not None:
            least[joined.top(i)] = min(name, least.get(joined.top(i), name))
    want = [(name, n[i], least.get(joined.top(i)), name == least.get(joined.top(i))) for i, (name, *_) in enumerate(rows)]
    assert bag(tuple(r) for r in got) == bag(want)
    assert embedding_dedup.near_duplicates(frame.where("vec_id = -1")).count() == 0


def test_embeddings_at_the_threshold(spark):
    """Of 1,500 pairs at a cosine just above 0.9, one in a hundred may be missed; far more were with 32 tables."""
    draw = np.random.default_rng(4)
    a, b = draw.standard_normal((2, 1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9001 * a + np.sqrt(1 - 0.9001**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4))
    kept = {r.id: r.component_id for r in got.collect()}
    assert sum(kept[i + 1500] == kept[i] for i in range(1500)) >= 0.98 * 1500


def test_pii(docs, empty, spark):
    texts = [(1, "mail a.b+c@x-y.example.com, or 1.2.3.4 and 1.2.3.400; card 4111 1111-1111 1111 +1 (555) 123-4567"), (None, None), (2, ""),
             (2, "password=b7db7aa4a5fcc78305 the 12.05.2021, version 3.0 and 1999"), (3, "é ü joe [at] site dot com é 10@b.c")]
    got = {r.id: r for r in pii.find(spark.createDataFrame(texts, "doc_id long, text string").where("text <> '' or text is null")).collect()}
    assert [s.kind for s in got[1].base] == ["email", "ip", "card", "phone"]
    assert [tuple(s) for s in got[1].base][:2] == [("email", 5, 26), ("ip", 31, 38)]
    assert not got[2].base and [s.kind for s in got[2].spans] == ["secret"]
    assert got[None].spans == [] and [tuple(s) for s in got[3].base] == [("email", 28, 34)]
    assert pii.find(empty).count() == 0 and pii.find(docs).count() == len(ROWS)
    weights, sentences = pii.default_weights(), pii.labelled(300, seed=123)
    right = found = held = 0
    for text, spans in sentences:
        decoded = set(pii.decode(text, weights))
        right, found, held = right + len(decoded & set(spans)), found + len(decoded), held + len(spans)
    assert right / found > 0.93 and right / held > 0.92


def test_pii_long_runs_of_digits():
    assert pii.base_spans("9" * 5000 + ".1.1.1") == [] and pii.base_spans("1.1.256.1") == []
    assert pii.base_spans("0" * 5000 + "9.1.1.255") == [("ip", 0, 5009)] and pii.base_spans("0.0.0.0") == [("ip", 0, 7)]


def test_pii_islands_equal_whole_texts():
    """Decoding around triggers gives what decoding a whole text gives."""
    weights = pii.default_weights()
    sentences = pii.labelled(60, seed=9)
    for k in range(0, 60, 3):
        text = (" " + "mot " * 50).join(t for t, _ in sentences[k: k + 3])
        assert pii.added_spans(text, [], weights) == pii.decode(text, weights)


def test_html(spark):
    pages = [(1, "u", "<nav><a href=x>Home</a></nav><article><h1>T &amp; x</h1><p>First long enough sentence here, with words.<p>Second   one<br>too.</article><footer>&copy; us</footer>", 1),
             (2, "u", None, 1), (2, "u", "", 1), (None, None, "<div class='ad'>Buy", 1), (3, "u", "<script>var x='<p>no</p>'", 1)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, text int")
    got = {(r.page.page_id, r.page.text, r.text) for r in html_extract.extracted(frame).collect()}
    assert (1, 1, "T & x\nFirst long enough sentence here, with words.\nSecond one too.") in got
    assert {t for i, _, t in got if i != 1} == {""} and html_extract.extracted(frame.where("page_id = 9")).count() == 0
    model, held_out = html_extract.default_model(), html_extract.labelled_pages(200, seed=1234)
    exact = sum(html_extract.decode(page, *model) == marks for page, marks in held_out)
    assert exact >= 0.93 * len(held_out)


@pytest.mark.parametrize("page, want", [
    *[(f"<article><p>a</p><{t} src=x><p>b</p></article><p>c", ["a", "b", "c"]) for t in "svg object canvas math audio video select noscript template".split()],
    *[(f"<p>a <{t}>not this</{t}>b</p><p>c</p>", ["a b", "c"]) for t in "svg canvas audio video select noscript template script style iframe".split()],
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</p>", ["Let x=2 be."]), ("<p>See <object data=x><param name=y>the plan</object> here.", ["See the plan here."]),
    ("<div><p>a<video></p><p>b</p></div><div><video>no</video><p>c</p></div>", ["a", "b", "c"]), ("<p>a<video>no<video>no</video>no</video>b", ["ab"]),
    ("<p>a<svg><title>t</svg>b</p><p>c", ["ab", "c"]), ("<p>a<script>x='</p><p>b'", ["a"]), ("<p>a</p><textarea>b<p>c", ["a"]),
])
def test_silent_elements(page, want):
    """Silent elements end no block; those never closed cost no text after them; formulas and objects are text."""
    assert [b.text for b in html_blocks.blocks(page)] == want
