"""What the packing reports of itself."""

import collections

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from panelwright.llm import packing, queries, tokens

from . import brute


def test_pieces_of_the_query(spark, sf):
    """Every piece of every document, against the tokenizer by itself."""
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op5_best_fit_packing"](spark, sf).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    want = brute.pieces(docs, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 2048)
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)


def test_ids_of_odd_texts():
    """Texts of any script, sign and white space, by parts and by the tokenizer at once; also with caches that run over."""
    pick, encoder = np.random.default_rng(9), tokens.encoder()
    signs = list("abcXYZ  '\t\n.,!%0129²½ªµÀßéİıŉǅɏ×÷¿ǀ-_'s're<|>") + ["日本", "\u0301", "\x1c", "<|endoftext|>", "\xa0", "\x85", "ﬁ", "İİ", "'S 'LL"]
    texts = ["".join(pick.choice(signs, pick.integers(0, 30))) for _ in range(1500)]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    before = tokens.PARTS, tokens.TOGETHER
    try:
        for tokens.PARTS, tokens.TOGETHER in (before, (50, 200)):
            got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_all(texts)]
            assert got == want
    finally:
        tokens.PARTS, tokens.TOGETHER = before
        encoder.forget()


def test_certificate_of_the_packing(spark, sf):
    packed = queries.QUERIES["op5_best_fit_packing"](spark, sf)
    rows = packed.select("sequence_id", "length", "offset").collect()
    used, bound = packing.certificate(packed)
    assert used == len({r.sequence_id for r in rows}) >= bound >= -(-sum(r.length for r in rows) // 2048)
    assert used - bound <= 1
    room = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert room.get(r.sequence_id, 0) == r.offset
        room[r.sequence_id] = r.offset + r.length
    assert max(room.values()) <= 2048


def test_certificate_of_nothing(spark):
    empty = spark.createDataFrame([], "sequence_id long, length long")
    assert packing.certificate(empty) == (0, 0)


def test_bounds_of_counts_and_lengths_agree():
    pick = np.random.default_rng(2)
    for room in (10, 64):
        lengths = pick.integers(1, room + 1, 200)
        assert packing.lower_bound(lengths, room) == packing.bound_of(np.bincount(lengths, minlength=room + 1), room) > 0
    assert packing.lower_bound(np.zeros(0, np.int64), 10) == 0
