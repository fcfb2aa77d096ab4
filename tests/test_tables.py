"""Prediction tables, orders and run windows on small frames."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from traces import at, micros

from courierlens import contracts
from courierlens.catalog.fixtures import END, START, fixtures
from courierlens.operators import tables, trace, windows
from courierlens.sources import orders as so
from courierlens.sources import points as sp
from courierlens.sources import samples


@pytest.fixture(scope="module")
def fx(spark):
    return fixtures(spark, "/root/testdata/sf0.001")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_sixteen_tables_and_their_contracts():
    assert len(contracts.PREDICTION_TABLES) == 16 and len(contracts.DEDUPLICATED_TABLES) == 12
    names = {name for name, _ in contracts.PREDICTION_TABLES.values()}
    assert set(contracts.DEDUPLICATED_TABLES) <= names
    assert contracts.table_of("reach", 3) == ("reach_date_prediction", "reach")
    assert contracts.prediction_schema("delivery").names == [
        "prediction_id", "order_id", "predicted_delivery_date", "predicted_delivery_dateL", "latitude", "longitude", "predictedat",
    ]
    made = contracts.schema_from_kinds({"a": "object", "b": "int64", "c": "bool"}, {"b": T.DoubleType()})
    assert [f.dataType for f in made.fields] == [T.StringType(), T.DoubleType(), T.BooleanType()]


def test_written_predictions_come_back(spark, tmp_path):
    made = spark.createDataFrame(
        [("a", at(1), at(2), 1 / 3, 2.0), ("b", None, None, None, None)],
        "_id_oid string, time timestamp, time_l timestamp, lat double, lon double",
    )
    path = str(tmp_path / "run")
    tables.write_predictions(made, "reach", path)
    first = tables.load_staged(spark, path, "reach")
    assert rows(first.select("order_id", "predicted_reach_date", "predicted_reach_dateL", "latitude", "longitude")) == rows(made)
    assert first.schema.names == contracts.prediction_schema("reach").names
    twice = tables.load_staged(spark, path, "reach", existing=first.cache())
    assert twice.count() == 4 and twice.select("prediction_id").distinct().count() == 4
    latest = tables.keep_latest(twice.cache(), "prediction_id", ["order_id"])
    assert latest.count() == 2
    assert latest.agg(F.min("prediction_id")).first()[0] > first.agg(F.max("prediction_id")).first()[0]


def test_maintenance_twice_is_maintenance_once(fx):
    once = tables.keep_latest(fx.predictions, "prediction_id", ["order_id"])
    assert rows(tables.keep_latest(once, "prediction_id", ["order_id"])) == rows(once)
    fresh = fx.predictions.filter("prediction_id % 10 = 0")
    upserted = tables.upsert(fx.predictions, fresh, "order_id")
    assert rows(tables.upsert(upserted, fresh, "order_id")) == rows(upserted)
    aligned = tables.align_batches(fx.raw_orders, fx.job_predictions, START, END)
    assert rows(aligned) != rows(fx.job_predictions.select(*aligned.columns))
    assert rows(tables.align_batches(fx.raw_orders, aligned, START, END)) == rows(aligned)


def test_a_later_null_replaces_an_earlier_value(spark):
    made = spark.createDataFrame([(1, "a", 5.0), (2, "a", None)], "prediction_id long, order_id string, v double")
    assert rows(tables.keep_latest(made, "prediction_id", ["order_id"])) == [(2, "a", None)]


def test_unpredicted_orders_repeat_only_on_request(spark):
    orders = spark.createDataFrame([("a",), ("b",), ("c",)], "_id_oid string")
    made = spark.createDataFrame([("a", None), ("a", None), ("a", 1), ("b", 1)], "order_id string, d int")
    assert rows(trace.only_unpredicted(orders, made, "d")) == [("a",), ("a",), ("c",)]
    assert rows(trace.only_unpredicted(orders, made, "d", repeat=False)) == [("a",), ("c",)]


def test_job_straddling_the_window(spark):
    """The job counts by its last delivery, and its dates come from all its orders, also those without a job."""
    hour = 3_600_000_000
    data = [
        ("a1", "a", 1, -hour // 2, 5), ("a2", "a", 2, hour // 2, 9), ("b1", "b", 1, hour // 2, 1), ("b2", "b", 2, 3 * hour // 2, 2),
        ("n1", None, 1, hour // 4, 3), ("n2", None, 1, hour // 3, 7),
    ]
    orders = spark.createDataFrame(
        [(i, j, b, at(d), at(o)) for i, j, b, d, o in data],
        "_id_oid string, delivery_job_oid string, delivery_batch_index int, deliver_date timestamp, onway_date timestamp",
    ).withColumns({"status": F.lit(900), "domaintype": F.lit(1), "country_oid": F.lit("1")})
    for column in so.MARKET_COLUMNS:
        if column not in orders.columns:
            orders = orders.withColumn(column, F.lit(None).cast("timestamp"))
    zones = spark.createDataFrame([("1", "UTC")], contracts.TIME_ZONES)
    found = so.market_orders(orders, zones, str(at(0).replace(tzinfo=None)), str(at(hour).replace(tzinfo=None)))
    assert rows(found.select("_id_oid", micros("onway_date"))) == [("a1", 9), ("a2", 9), ("n1", 7), ("n2", 7)]


def test_sample_is_repeatable(fx):
    one = samples.sample_orders(fx.raw_orders, START, END, 10, seed=1)
    assert rows(one.select("_id_oid")) == rows(samples.sample_orders(fx.raw_orders.repartition(5), START, END, 10, seed=1).select("_id_oid"))
    assert rows(one.select("_id_oid")) != rows(samples.sample_orders(fx.raw_orders, START, END, 10, seed=2).select("_id_oid"))


def test_hour_windows(spark):
    made = windows.hour_windows(spark, "2024-01-01 00:00:00", "2024-01-01 02:30:00").collect()
    assert [(r["window_start"].hour, r["window_end"].hour) for r in made] == [(0, 1), (1, 2), (2, 3)]
    assert windows.hour_windows(spark, "2024-01-01", "2024-01-01").count() == 0
    frame = spark.sql("select timestamp'2024-01-01 01:00:00' as t union all select timestamp'2024-01-01 03:00:00'")
    placed = windows.in_windows(frame, "t", "2024-01-01 00:00:00", "2024-01-01 02:30:00")
    assert sorted((r["t"].hour, r["window_start"].hour) for r in placed.collect()) == [(1, 0), (1, 1), (3, 2)]


def test_route_docs(spark):
    docs = spark.createDataFrame(
        [("a", [([29.0, 41.0], at(0), 5.0), ([29.1, 41.1], at(1), None)]), ("b", []), ("c", None)], contracts.ROUTE_DOCS
    )
    flat = sp.flatten_route_docs(docs).select("route_id", "index", "lon", "lat", "acc")
    assert rows(flat) == [("a", 0, 29.0, 41.0, 5.0), ("a", 1, 29.1, 41.1, None)]


def test_null_counts(spark):
    frame = spark.createDataFrame([(1, None), (2, None), (None, None)], "a int, b string").withColumn("c", F.lit(1))
    assert rows(windows.null_counts(frame)) == [("a", 1, 3), ("b", 3, 3)]
