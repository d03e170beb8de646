"""The registered queries: SQL twins, and brute force where SQL can't express them."""

import collections
import hashlib

import duckdb
import pandas
import pytest

from panelwright.llm import queries

from . import brute


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_twin(spark, sf, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    got = queries.QUERIES[name](spark, sf)
    want = db.execute(queries.SQL[name]).fetchdf()
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    plain = lambda row: tuple(None if pandas.isna(v) else v for v in row)
    rows = lambda frame: collections.Counter(map(plain, frame[order].itertuples(index=False, name=None)))
    assert rows(got.toPandas()) == rows(want)


def documents(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def test_op10(spark, sf):
    got = queries.QUERIES["op10_hyperminhash"](spark, sf).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(brute.near_duplicates(documents(spark, sf)))


def test_op3(spark, sf):
    got = queries.QUERIES["op3_suffix_array_dedup"](spark, sf).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute.repeats(documents(spark, sf), 200)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_op4_training_order(spark, sf):
    """Moments and words of all times that documents are taken, and both queries' rows in that order."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    want = {(i, k): (n, t) for i, k, n, t in brute.moments(rows)}
    got = queries.QUERIES["op4_curriculum_order"](spark, sf).collect()
    assert {(r.doc_id, r["pass"]): r.words for r in got} == {x: n for x, (n, _) in want.items()} and len(got) == len(want)
    assert all(abs(r.position - want[r.doc_id, r["pass"]][1]) < 1e-7 for r in got)
    assert [r.position for r in got] == sorted(r.position for r in got)
    first = {}
    for r in got:
        first.setdefault(r.doc_id, r.position)
    mixed = queries.QUERIES["op4_curriculum_mix"](spark, sf).collect()
    order = [first.get(r.doc_id, 2) for r in mixed]
    assert order == sorted(order) and {r.doc_id for r in mixed if r.taken} == set(first)
