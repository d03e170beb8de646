"""The whole pipeline against the brute-force versions of its stages, each on what the one before kept."""

import collections
import math

from tokenizers import Tokenizer

import corpus_pipeline

from . import brute


def test_pipeline(spark, sf):
    public_tokenizers = __import__("public_tokenizers")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows = [r for r in rows if brute.quality(r[1])["kept"]]
    source = {r[0]: r[2] for r in rows}
    rows = [(i, text) for i, text, _, _ in brute.line_dedup([r[:2] for r in rows], 10, keep_first=True)]
    kept = {i for i, _, _, keep in brute.near_duplicates(rows) if keep}
    rows = [(i, t, source[i]) for i, t in rows if i in kept]
    targets, before = brute.mix(rows)
    mixed = []
    for i, text, s in rows:
        target, size = targets[s]
        n, ahead = before[i, s]
        passes = math.floor(target / size) if size else 0
        rest = math.floor(target) - passes * size
        times = passes + (2 * ahead + n <= 2 * rest) if n else 0
        mixed += [(i, text)] * times
    want = brute.pieces(mixed, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 2048)

    got = corpus_pipeline.run(spark, sf).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == collections.Counter(want)
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for filled in places.values():
        at = 0
        for offset, length in sorted(filled):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= math.ceil(sum(r.length for r in got) / 2048) * 1.02 + 1


def test_stages_return_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(40), sf).columns == docs.columns
