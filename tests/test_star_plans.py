"""Plans of the star join: what is exchanged, what is read, and that the forms of the star agree."""

import collections
import contextlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import plan
from panelwright.plans import star
from workload import star_view


@contextlib.contextmanager
def settings(spark, **values):
    names = {k: "spark.sql." + k.replace("__", ".") for k in values}
    before = {n: spark.conf.get(n) for n in names.values()}
    for k, v in values.items():
        spark.conf.set(names[k], v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def bag(df, columns):
    return collections.Counter(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("name", ["wide_fact", "flat_extract"])
def test_no_exchange_on_keys_of_few_values(spark, sf, name):
    """With large tables never broadcast, the fact is exchanged for large dimensions only. Joined before the derived rows, as
    in the extract, it needs each table once."""
    with settings(spark, autoBroadcastJoinThreshold="4096"):
        text = plan(contract.queries()[name](spark, sf))
    assert not re.search(r"hashpartitioning\((channel_id|sales_type_id|kpi_flag_id|period_id|category_id)", text)
    assert "SortMergeJoin" in text
    for table in ("part", "customer", "lineitem") if name == "flat_extract" else ("customer", "lineitem"):
        assert len(re.findall(rf"{table}\.parquet", text)) == 1, table


def test_both_ways_to_the_wide_rows(spark, sf):
    base = star.base_fact(star_view.mart(spark, sf))
    dims = star_view.dims(spark, sf)
    columns = ["period_id", "pidx", "year", "manufacturer", "category", "channel", "sales_type", "metric", "value"]
    joined_last = star.wide_fact(star.tall_fact(base, dims["DIM_PROD"]), dims, columns)
    assert bag(star.wide_from_base(base, dims, columns), columns) == bag(joined_last, columns)
    assert star.wide_from_base(base, dims, ["pidx", "kpi_flag_id", "value"]).columns == ["pidx", "kpi_flag_id", "value"]


def test_unknown_members_keep_their_rows(spark, sf):
    dims = star_view.dims(spark, sf)
    base = spark.createDataFrame([(202401, -1, 77, 99, 1, 5.0), (202401, None, None, None, 2, 6.0)],
                                 "period_id int, product_id int, channel_id int, sales_type_id int, kpi_flag_id int, value double").withColumn(
        "value", F.col("value").cast("decimal(18,4)"))
    rows = star.wide_from_base(base, dims, ["manufacturer", "channel", "sales_type", "metric", "value"]).collect()
    assert sorted((r.manufacturer, r.channel, r.sales_type, r.metric, float(r.value)) for r in rows if r.sales_type) == [
        (None, None, "NOT_ASSIGNED", "Volumen Kg", 5.0)]
    assert len(rows) == 2


def test_colocated_star(spark, sf, tmp_path):
    """The fact in buckets meets the product dimension without an exchange, also where nothing large is broadcast."""
    dims = star_view.dims(spark, sf)
    fact = star_view.fact(spark, sf)
    spark.sql("CREATE DATABASE IF NOT EXISTS COLOCATED")
    try:
        star.write_colocated(spark, fact, dims, "COLOCATED", str(tmp_path), 4)
        stored, stored_dims = star.read_colocated(spark, "COLOCATED")
        columns = ["manufacturer", "channel", "sales_type", "metric", "period_id", "month_long", "value"]
        size = lambda df, *names: int(str(df.select(*names)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        small = max(size(stored_dims["DIM_CHANNEL"], "channel_id", "channel"), size(stored_dims["DIM_CALENDAR"], "period_id", "month_long"),
                    size(stored_dims["DIM_UNITS"], "kpi_flag_id", "metric"), size(stored_dims["DIM_SALES_TYPE"], "sales_type_id", "sales_type"))
        assert small < size(stored_dims["DIM_PROD"], "product_id", "manufacturer")
        with settings(spark, autoBroadcastJoinThreshold=str(small)):
            wide = star.wide_fact(stored, stored_dims, columns)
            text = plan(wide)
            assert "SortMergeJoin" in text and "Exchange hashpartitioning" not in text
            got = bag(wide, columns)
        assert got == bag(star.wide_fact(fact, dims, columns), columns)
    finally:
        spark.sql("DROP DATABASE IF EXISTS COLOCATED CASCADE")
