"""The lookup table and the placement, against brute force."""

import collections
import hashlib

import pytest

from panelwright.llm import queries, sharding

from .test_cases import ROWS, bag, docs, empty  # noqa: F401


def filled(shards, slots):
    """Turn by turn, from whole preference lists."""
    number = lambda text: int(hashlib.sha256(text.encode()).hexdigest()[:16], 16)
    wishes = [iter([(number(f"offset:{s}") + j * (number(f"step:{s}") % (slots - 1) + 1)) % slots for j in range(slots)]) for s in shards]
    table = {}
    while len(table) < slots:
        for k, wish in enumerate(wishes):
            if len(table) < slots:
                table[next(x for x in wish if x not in table)] = k
    return [table[i] for i in range(slots)]


@pytest.mark.parametrize("n,slots", [(1, 7), (3, 13), (7, 1009), (5, 5)])
def test_table(n, slots):
    shards = [f"s{i}" for i in range(n)]
    assert sharding.lookup_table(shards, slots) == filled(shards, slots)


def test_table_is_even_and_stable():
    table = sharding.lookup_table(queries.SHARDS)
    held = collections.Counter(table)
    assert max(held.values()) - min(held.values()) <= 1
    fewer = sharding.lookup_table(queries.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(table, fewer) if a != 63)
    assert moved < 0.1 * len(table)
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 12)


def slot_of(key, text, slots):
    return int(hashlib.md5((str(key) if key is not None else text or "").encode()).hexdigest()[:15], 16) % slots


def test_placement(spark, docs, empty, tmp_path):  # noqa: F811
    shards = ["a", "b", "c"]
    table = sharding.lookup_table(shards, 101)
    got = sharding.placed(docs, shards, slots=101).select("doc.doc_id", "slot", "shard")
    want = [(i, s, shards[table[s]]) for i, t, _ in ROWS for s in [slot_of(i, t, 101)]]
    assert bag(got.collect()) == bag(want)
    assert sharding.placed(empty, shards).count() == 0
    sharding.write(docs, str(tmp_path / "out"), shards, slots=101)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(ROWS) and set(docs.columns) < set(back.columns)
    assert bag(back.select("doc_id", "_shard").collect()) == bag((i, s) for i, _, s in want)


def test_query(spark, sf):
    got = queries.QUERIES["op9_lookup_sharding"](spark, sf).collect()
    table = sharding.lookup_table(queries.SHARDS)
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert bag(tuple(r) for r in got) == bag((i, s, queries.SHARDS[table[s]]) for i, t in rows for s in [slot_of(i, t, sharding.SLOTS)])
