import datetime as dt

from pyspark.sql import functions as F

from conftest import plan, rows
from panelwright.operators import dedup, feeds, grid, incremental, lookup, resolve, topk, totals
from panelwright.sources.rows import inline_rows


def day(n):
    return dt.datetime(2024, 1, n)


VERSIONS = [("a", 1, day(1)), ("a", 2, day(3)), ("a", 3, day(3)), ("b", 4, None), ("b", 5, day(2)), (None, 6, day(1))]


def versions(spark):
    return inline_rows(spark, "k string, v int, LOA_DAT timestamp", VERSIONS)


def test_latest_version_breaks_ties_and_ignores_missing_stamps(spark):
    got = rows(dedup.latest_version(versions(spark), ["k"]).select("k", "v"), "v")
    assert got == [("a", 3), ("b", 5), (None, 6)]


def test_latest_version_expression_key(spark):
    df = versions(spark).filter("k is not null")
    assert dedup.latest_version(df, {"key": F.lit("same")}).count() == 1


def test_latest_version_cuts_hot_keys_before_the_shuffle(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    text = plan(dedup.latest_version(lines, ["l_returnflag"], "l_shipdate"))
    assert text.count("WindowGroupLimit") == 2  # partial in the task, final after the exchange


def test_watermark(spark):
    df = versions(spark)
    assert incremental.watermark_value(None) == incremental.EPOCH
    assert incremental.watermark_value(df.filter("false")) == incremental.EPOCH
    assert incremental.watermark_value(df) == day(3)
    assert incremental.incremental_slice(df, None).count() == 5  # a row without a stamp is not newer
    got = incremental.incremental_slice(df, df.filter("v = 5"))
    assert rows(got.select("v"), "v") == [(2,), (3,)]


def test_reload_replaces_periods_once_and_keeps_unknown_ones(spark):
    schema = "PER_DSC int, v int"
    target = inline_rows(spark, schema, [(1, 10), (2, 20), (2, 21), (None, 9)])
    batch = inline_rows(spark, schema, [(2, 22), (None, 8)])
    once = incremental.reload_periods(target, batch)
    assert rows(once, F.col("PER_DSC").asc_nulls_last(), "v") == [(1, 10), (2, 22), (None, 8), (None, 9)]
    emptied = incremental.reload_periods(target, batch, periods=inline_rows(spark, "PER_DSC int", [(1,), (2,)]))
    assert rows(emptied, F.col("PER_DSC").asc_nulls_last(), "v") == [(2, 22), (None, 8), (None, 9)]


def mapping(spark):
    return inline_rows(spark, "SRC_DSC string, CHL_SRC string, CHL_COD int",
                       [("P", " x ", 1), ("P", "Y", 2), ("P", "y", 3), ("Q", "z", 4), ("P", None, 5)])


def test_lookup_keeps_every_row_once(spark):
    df = inline_rows(spark, "i int, label string", [(1, "X"), (2, "y "), (3, "z"), (4, None)])
    got = rows(lookup.map_code(df, mapping(spark), "P", "label", "CHL_SRC", "CHL_COD").select("i", "CHL_COD"), "i")
    assert got == [(1, 1), (2, 3), (3, 99), (4, 99)]
    keep = lookup.map_code(df, mapping(spark), "P", "label", "CHL_SRC", "CHL_COD", default=None)
    assert rows(keep.select("i", "CHL_COD"), "i") == [(1, 1), (2, 3), (3, None), (4, None)]


def test_constant_lookup_needs_no_join(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    coded = lines.withColumn("c", lookup.constant_code(mapping(spark), "P", "x", "CHL_SRC", "CHL_COD"))
    assert coded.select("c").distinct().collect()[0][0] == 1
    assert "Join" not in plan(coded)
    missing = lines.limit(1).select(lookup.constant_code(mapping(spark), "P", "none", "CHL_SRC", "CHL_COD"))
    assert missing.first()[0] == 99


def test_pair_lookup(spark):
    df = inline_rows(spark, "i int, feed string, k int", [(1, "P", 7), (2, "Q", 7), (3, "R", 7)])
    m = inline_rows(spark, "SRC_DSC string, L string, C int", [("P", "7", 70), ("Q", "8", 80)])
    got = lookup.map_code_pair(df, m, ["P", "Q"], "feed", "k", "L", "C")
    assert rows(got.select("i", "C"), "i") == [(1, 70), (2, None), (3, None)]


def test_feeds(spark):
    a, b = inline_rows(spark, "x int, y int", [(1, 2)]), inline_rows(spark, "x int", [(3,)])
    assert rows(feeds.union_aligned([a, b]), "x") == [(1, 2), (3, None)]
    assert rows(feeds.union_feeds({"A": b, "B": b}), "SRC_DSC") == [(3, "A"), (3, "B")]
    added = feeds.add_member(a, {"x": F.lit(99)}, ["y"])
    assert rows(added, "x") == [(1, 2), (99, 2)]
    empty = feeds.add_member(a.filter("false"), {"x": F.lit(99)}, ["y"])
    assert rows(empty) == [(99, None)]
    tall = feeds.wide_to_tall(inline_rows(spark, "i int, p int, q int", [(1, 5, None), (2, 6, 7)]), ["i"],
                              {"P": F.col("p"), "Q": F.col("q")}, "flag", "value")
    assert rows(tall, "i", "flag") == [(1, "P", 5), (2, "P", 6), (2, "Q", 7)]
    long = feeds.long_form(inline_rows(spark, "i int, p int, q int", [(1, 5, None)]), ["i"], {"p": "L", "q": "L-1"},
                           "period", "sales")
    assert rows(long, "period") == [(1, "L", 5), (1, "L-1", None)]


def test_or_join_equals_nested_loop(spark):
    fact = inline_rows(spark, "code string, i int", [("a", 1), ("e1", 2), ("b", 3), (None, 4), ("zz", 5)])
    master = inline_rows(spark, "c string, e string, name string",
                         [("a", "e1", "p1"), ("a", "a", "p2"), ("b", None, "p3"), (None, None, "p4"), ("e1", "x", "p5")])
    melted = resolve.resolve_by_any_key(fact, "code", master, ["c", "e"], ["name"])
    loop = fact.join(master, (F.col("code") == F.col("c")) | (F.col("code") == F.col("e")), "left")
    assert rows(melted.select("i", "name"), "i", "name") == rows(loop.select("i", "name"), "i", "name")
    assert "NestedLoop" not in plan(melted)
    single = resolve.resolve_by_any_key(fact, "code", master, ["c", "e"], ["name"], unique=True)
    assert rows(single.select("i", "name"), "i") == [(1, "p1"), (2, "p5"), (3, "p3"), (4, None), (5, None)]


def test_not_in_ignores_nulls(spark):
    df = inline_rows(spark, "k string", [("a",), ("b",), (None,)])
    known = inline_rows(spark, "k string", [("a",), (None,)])
    assert rows(resolve.not_in(df, "k", known, "k")) == [("b",)]


def members(spark):
    return inline_rows(spark, "g string, m string, v decimal(18,4)",
                       [("x", "a", 1), ("x", "b", 3), (None, "a", 5), (None, "c", None)])


def test_totals(spark):
    whole = totals.with_totals(members(spark), {"t": "v"})
    assert {float(r["t"]) for r in whole.collect()} == {9.0}
    by = totals.with_totals(members(spark), {"t": "v"}, ["g"])
    got = [(g, m, float(t)) for g, m, t in rows(by.select("g", "m", "t"), F.col("g").asc_nulls_last(), "m")]
    assert got == [("x", "a", 4.0), ("x", "b", 4.0), (None, "a", 5.0), (None, "c", 5.0)]
    pct = totals.percent_of_total(members(spark), "v", "pct", ["g"])
    assert rows(pct.filter("g = 'x'").select("pct"), "pct") == [(0.25,), (0.75,)]


def test_totals_read_the_fact_once(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    sums = lines.groupBy("l_partkey").agg(F.sum("l_quantity").alias("v"))
    df = totals.with_totals(sums, {"t": "v"})
    df.collect()
    assert "ReusedExchange" in plan(df)
    assert "Window" not in plan(df)


def test_dense_months(spark):
    monthly = inline_rows(spark, "k string, pidx int, v decimal(18,4)", [("a", 1, 10), ("a", 4, 40), ("b", 2, 20)])
    got = [(k, p, float(v)) for k, p, v in rows(grid.dense_months(monthly, ["k"], ["v"]), "k", "pidx")]
    assert got == [("a", 1, 10.0), ("a", 2, 0.0), ("a", 3, 0.0), ("a", 4, 40.0),
                   ("b", 1, 0.0), ("b", 2, 20.0), ("b", 3, 0.0), ("b", 4, 0.0)]


def test_top(spark):
    df = inline_rows(spark, "m string, v int", [("b", 2), ("a", 2), ("c", 3), ("d", None)])
    assert rows(topk.top(df, 2, "v", "m")) == [("c", 3), ("a", 2)]
    assert rows(topk.first_members(df, "m", 3)) == [("a",), ("b",), ("c",)]
    assert topk.only_members(df, "m", topk.top(df, 1, "v", "m")).count() == 1


def test_hot_key_is_split_in_the_resolving_join(spark):
    """A third of the rows under one key: the join splits that key's partition at run time."""
    fact = spark.range(60000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 5000) END AS code", "id", "repeat('x', 40) AS pad")
    master = spark.range(5000).selectExpr("concat('k', id) AS c", "CASE WHEN id = 1 THEN 'hot' END AS e", "id AS name")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB", "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = resolve.resolve_by_any_key(fact.repartition(8), "code", master, ["c", "e"], ["name"], unique=True)
        got = df.groupBy(F.col("name").isNull()).count()
        df.write.format("noop").mode("overwrite").save()
        assert rows(got) == [(False, 60000)]
        df.collect()
        assert "skew=true" in plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_orphans_and_unlisted_members(spark):
    from panelwright.plans import quality
    from workload.star_view import COLUMNS

    fact = inline_rows(spark, "k int, value double", [(1, 1.0), (1, 2.0), (9, 1.0), (None, -1.0)])
    dim = inline_rows(spark, "d int", [(1,), (2,)])
    got = dict(rows(quality.referential_report(fact, {"d": ("k", dim, "d")})))
    assert got == {"orphan_d": 1, "null_k": 1, "null_value": 0, "negative_value": 1}
    members = inline_rows(spark, "p_type string", [("ECONOMY",), ("STANDARD",), ("NEW",), (None,)])
    assert [r[0] for r in rows(members.selectExpr(COLUMNS["category_id"][1]))] == [1, 6, 99, 99]
