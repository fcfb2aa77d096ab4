"""Sliced windows equal plain ones, distributed ranks equal ordinary ones."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from courierlens.operators import ranks
from courierlens.operators.density import even_slices
from courierlens.operators.features import client_departure_features, reach_features
from courierlens.operators.slices import forward_fill, heavy_keys, next_in_key, number_rows, slice_heavy_keys, whole, with_slice
from courierlens.operators.trace import iqr_outliers
from courierlens.params import EventParams
from courierlens.sources.points import TRACE_ORDER, attributed_points, traces_of


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 80)}"
        value = f"v{rng.randint(0, 9)}" if rng.random() < 0.1 else None
        data.append((key, start + timedelta(seconds=rng.randint(0, 40000)), i, value))
    return spark.createDataFrame(data, "key string, time timestamp, id long, value string").cache()


@pytest.mark.parametrize("seconds", [7, 600, 10**6])
def test_windows(rows, seconds):
    order = ["time", "id"]
    whole = Window.partitionBy("key").orderBy(*order)
    so_far = whole.rowsBetween(Window.unboundedPreceding, 0)
    sliced = with_slice(rows, "time", seconds)
    filled = forward_fill(sliced, ["key"], order, {"value": "filled"})
    numbered = number_rows(filled, ["key"], order, "n", total="size")
    ours = next_in_key(numbered, ["key"], order, "id", "next").select("id", "filled", "n", "size", "next")
    plain = rows.select(
        "id",
        F.last("value", ignorenulls=True).over(so_far).alias("filled"),
        F.row_number().over(whole).cast("long").alias("n"),
        F.count("*").over(Window.partitionBy("key")).alias("size"),
        F.lead("id").over(whole).alias("next"),
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_only_heavy_keys_are_sliced(rows):
    heavy = heavy_keys(rows, "key", 500)
    assert [r["key"] for r in heavy.collect()] == ["hot"]
    sliced = slice_heavy_keys(rows, "key", "time", 600, heavy)
    counts = {r["key"]: r["n"] for r in sliced.groupBy("key").agg(F.countDistinct("slice").alias("n")).collect()}
    assert counts.pop("hot") > 50 and set(counts.values()) == {1}
    whole = Window.partitionBy("key").orderBy("time", "id")
    ours = number_rows(sliced, ["key"], ["time", "id"], "n").select("id", "n").collect()
    plain = rows.select("id", F.row_number().over(whole).alias("n")).collect()
    assert sorted(map(tuple, ours)) == sorted(map(tuple, plain))


@pytest.fixture(scope="module")
def one_second(spark):
    """20,000 points of one route within a second, 3,000 of them in one moment, 1,000 without a time, and a quiet route."""
    moment = (
        F.when(F.col("id") < 1000, None).when(F.col("id") < 4000, 500_000).otherwise(F.xxhash64("id").bitwiseAND(2**40 - 1) % 1_000_000)
    )
    dense = spark.range(20000).select(
        F.lit("hot").alias("route_id"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + moment).alias("time"),
        (F.lit(41.0) + (F.col("id") * 7 % 1009) * 1e-6).alias("lat"),
        (F.lit(29.0) + (F.col("id") * 11 % 997) * 1e-6).alias("lon"),
    )
    quiet = spark.range(50).select(
        F.lit("quiet").alias("route_id"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 30_000_000).alias("time"),
        (F.lit(41.0) + F.col("id") * 1e-5).alias("lat"),
        F.lit(29.0).alias("lon"),
    )
    return dense.unionByName(quiet).cache()


def test_dense_slices_are_cut(one_second):
    sliced = even_slices(one_second, ["route_id"], TRACE_ORDER, 600, 500)
    sizes = sliced.groupBy("route_id", "slice").agg(F.count("*").alias("n"), F.min("time").alias("a"), F.max("time").alias("b"))
    hot = sizes.filter("route_id = 'hot'").orderBy("slice").collect()
    assert len(hot) == 40 and {r["n"] for r in hot} == {500}
    assert all(r["a"] is None for r in hot[-2:]) and all(r["a"] is not None for r in hot[:-2])
    assert all(one["b"] <= two["a"] for one, two in zip(hot[:-2], hot[1:-2], strict=False))
    assert [r["n"] for r in sizes.filter("route_id = 'quiet'").orderBy("slice").collect()] == [20, 20, 10]
    # as many tasks as slices have a part of the route
    spread = sliced.repartition(64, "route_id", "slice").withColumn("task", F.spark_partition_id())
    assert spread.filter("route_id = 'hot'").select("task").distinct().count() > 16
    assert sorted(map(str, sliced.drop("slice").collect())) == sorted(map(str, one_second.collect()))


def test_features_of_dense_routes_equal_those_of_whole_slices(spark, one_second):
    orders = spark.createDataFrame(
        [(r, "UTC", "r", "c", 29.0, 41.0) for r in ("hot", "quiet")],
        "_id_oid string, time_zone string, delivery_route_oid string, courier_courier_oid string,"
        "delivery_address_location__coordinates_lon double, delivery_address_location__coordinates_lat double",
    ).withColumn("reach_date", F.lit(datetime(2024, 1, 1)))
    found = []
    for most in (500, None):
        p = EventParams(slice_rows=most)
        trace = traces_of(one_second, orders, p)
        reached = reach_features(trace, "client", p, include_all=True)
        left = client_departure_features(trace, p).drop("slice", "prev_point", "prev_point_2")
        found.append([sorted(map(str, reached.collect())), sorted(map(str, left.collect()))])
    assert len(found[0][0]) == 20050
    assert found[0] == found[1]


def test_ids_are_filled_over_the_parts_of_a_dense_slice(spark, one_second):
    """One courier's pings of a second keep their last order, however many parts the second has."""
    pings = one_second.filter("route_id = 'hot' and time is not null").select(
        F.lit(None).cast("string").alias("courierid"),
        F.lit(1.0).alias("acc"),
        F.lit(900).alias("status"),
        F.col("time").alias("createdat"),
        "lat",
        "lon",
        F.when(F.floor(F.col("lat") * 1e6) % 701 == 0, F.concat(F.lit("o"), F.floor(F.col("lon") * 1e6))).alias("orderid"),
    )
    found = [
        sorted(map(str, attributed_points(pings, ["orderid"], EventParams(slice_rows=most)).collect())) for most in (300, None)
    ]
    assert len(found[0]) == 19000 and found[0] == found[1]
    assert any("orderid_filled='o" in row and "raw_orderid=None" in row for row in found[0])


@pytest.mark.parametrize("count", [1, 5, 64])
def test_ntile(spark, count):
    rng = random.Random(9)
    data = []
    for client in range(997):
        # a third of all clients share one value, some have none
        some = 0.0 if rng.random() < 0.34 else (None if rng.random() < 0.05 else rng.choice([rng.random(), rng.randint(0, 9)]))
        data.append((client, rng.randint(0, 1), float(some) if some is not None else None, rng.randint(1, 4)))
    data += [(5000, 2, 1.0, 1), (5001, 2, 0.0, 1)]
    frame = spark.createDataFrame(data, "client long, grp int, a double, b long").cache()
    sorts = {"up": ("a", True), "down": ("a", False), "many": ("b", False)}
    ours = ranks.ntile_columns(frame, "grp", "client", sorts, 4, count).select("client", *sorts)

    def tile(column):
        return F.ntile(4).over(Window.partitionBy("grp").orderBy(column, "client"))

    plain = frame.select(
        "client",
        tile(F.col("a").asc_nulls_last()).alias("up"),
        tile(F.col("a").desc_nulls_first()).alias("down"),
        tile(F.col("b").desc_nulls_first()).alias("many"),
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_ntile_of_text_and_missing_ties(spark):
    """Ids may be text or missing, and many rows may share a value and have no id at all."""
    data = [(f"c{i}", "x", float(i % 3)) for i in range(300)] + [(None, "x", None)] * 300 + [("only", None, 1.0)]
    frame = spark.createDataFrame(data, "client string, grp string, a double")
    ours = ranks.ntile_columns(frame, "grp", "client", {"up": ("a", True), "down": ("a", False)}, parts=7)
    sizes = {(r["grp"], r["up"]): r["count"] for r in ours.groupBy("grp", "up").count().collect()}
    assert sizes == {("x", 1): 150, ("x", 2): 150, ("x", 3): 150, ("x", 4): 150, (None, 1): 1}
    assert {r["down"] for r in ours.filter("client is null").collect()} == {1, 2}
    plain = frame.filter("client is not null").withColumn("n", F.ntile(4).over(Window.partitionBy("grp").orderBy("a", "client")))
    again = ranks.ntile_columns(frame.filter("client is not null"), "grp", "client", {"n": ("a", True)})
    assert sorted(map(str, again.collect())) == sorted(map(str, plain.select(*again.columns).collect()))


def test_a_large_group_is_numbered_by_many_tasks(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("g"), "id").repartition(5)
    placed = ranks.in_tasks(rows, ["g", "id"], 12)
    assert placed.filter("g is null").select("_task").distinct().count() >= 3
    window = Window.partitionBy("g").orderBy("id")
    plain = rows.withColumns({"n": F.row_number().over(window), "m": F.count("*").over(Window.partitionBy("g"))})
    ours = ranks.numbered(rows, ["g"], ["id"], "n", "m", 12)
    assert sorted(map(str, ours.select("g", "id", "n", "m").collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("parts", [1, 10, 64])
def test_values_at_ranks(spark, parts):
    rng = random.Random(4)
    values = [1.5] * 400 + [rng.random() * 3 for _ in range(801)]
    rng.shuffle(values)
    frame = spark.createDataFrame([(v,) for v in values], "value double").repartition(4)
    ordered = sorted(values)
    wanted = [1, 2, 300, 301, 600, 900, 1201]
    assert ranks.values_at_ranks(frame, "value", wanted, parts) == {r: ordered[r - 1] for r in wanted}
    assert ranks.quartiles(frame, "value") == pytest.approx(tuple(np.quantile(values, [0.25, 0.75])))


def test_iqr_outliers(spark):
    frame = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 10)], "v double")
    assert ranks.quartiles(frame, "v") == (1.75, 4.75)
    assert sorted(r["v"] for r in iqr_outliers(frame, "v").collect()) == [1.0, 2.0, 3.0]
    assert sorted(r["v"] for r in iqr_outliers(frame, "v", whisker=2.0).collect()) == [1.0, 2.0, 3.0, 10.0]
    assert iqr_outliers(frame.limit(0), "v").count() == 0
    assert iqr_outliers(frame, "v", approx=True).count() > 0


def test_missing_keys_are_one_group_and_no_row_is_lost(spark):
    start = datetime(2024, 1, 1)
    data = [(None, start + timedelta(seconds=i), i, "a" if i == 0 else None) for i in range(0, 60, 20)]
    frame = spark.createDataFrame(data, "key string, time timestamp, id long, value string")
    sliced = with_slice(frame, "time", 7).withColumn("k", whole("key"))
    filled = forward_fill(sliced, ["k"], ["time", "id"], {"value": "filled"})
    rows = number_rows(filled, ["k"], ["time", "id"], "n", total="size").select("id", "filled", "n", "size").collect()
    assert sorted(map(tuple, rows)) == [(0, "a", 1, 3), (20, "a", 2, 3), (40, "a", 3, 3)]


def test_nan_does_not_count_as_a_value(spark):
    frame = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, float("nan"), None)], "v double")
    assert sorted(r["v"] for r in iqr_outliers(frame, "v").collect()) == [1.0, 2.0, 3.0, 4.0]
