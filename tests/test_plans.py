"""The physical plans are the ones wanted: shuffles, pushdown, no Python."""

from __future__ import annotations

import re

import pytest

from courierlens.catalog.fixtures import END, START, fixtures
from courierlens.catalog.registry import QUERIES
from courierlens.operators.tables import keep_latest
from courierlens.params import EventParams
from courierlens.plans import pipelines as pl
from courierlens.sources import orders as so
from courierlens.sources.points import route_points, traces_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fx(spark):
    made = fixtures(spark, SF_DIR)
    made.trace_events, made.anchors  # noqa: B018
    return made


def first_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, column: str) -> list[str]:
    """Details of the scans that read a column."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    parts = [part.strip() for part in text.split("\n\n")]
    return [part for part in parts if re.match(r"\(\d+\) Scan parquet", part) and column in part]


def shuffles_by_route(df) -> tuple[int, int]:
    """How often the rows of a trace are shuffled by route and slice, and how often that is read again."""
    df.collect()
    plan = first_plan(df).split("== Initial Plan ==")[0]
    wide = r"Exchange hashpartitioning\(route_id#\d+, slice#\d+L, \d+\), REPARTITION_BY_COL"
    lines = [line for line in plan.splitlines() if re.search(wide, line)]
    again = [line for line in lines if "ReusedExchange" in line]
    return len(lines) - len(again), len(again)


def test_partitions_and_columns_are_pruned(fx):
    points = scans(route_points(fx.points, fx.orders, 1, "2024-01-01 00:10:00", "2024-01-01 00:20:00"), "orderid")
    assert points and all("PartitionFilters: [isnotnull(dt" in scan for scan in points)
    assert all("event_type" not in scan for scan in points)


def test_order_filters_reach_the_scan(spark, fx, tmp_path):
    path = str(tmp_path / "orders")
    fx.raw_orders.write.parquet(path)
    stored = spark.read.parquet(path)
    found = so.market_orders(stored, fx.zones, START, END)
    read = scans(found, "status")
    assert len(read) == 3
    # the rows and the jobs read the orders; what is said of orders without a job reads the jobs again
    found.collect()
    final = first_plan(found).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[_id_oid|FileScan parquet [^\n]*delivery_job_oid", final)) == 2
    assert all("In(status, [" in scan and "GreaterThanOrEqual(deliver_date" in scan for scan in read)
    assert all("cancel_date" not in scan for scan in read)


def other_point_shuffles(df) -> list[str]:
    """Exchanges that carry the place of every point and are not by route and slice."""
    plan = first_plan(df).split("== Initial Plan ==")[0]
    bare = r"Exchange hashpartitioning\(route_id#\d+, \d+\)"
    lines = plan.splitlines()
    found = [(i, line) for i, line in enumerate(lines) if re.search(bare, line) and "Reused" not in line]
    # what is shuffled by route alone has been brought down to one row per slice
    return [line for i, line in found if not any("Aggregate" in below for below in lines[i + 1 : i + 4])]


def test_trace_is_shuffled_once_by_route(spark, fx):
    """The join, the rows and the slice summaries read one exchange; every window runs behind it."""
    points = pl.stage(route_points(fx.points, None, 1, START, END, indexed=False), "plan-points")
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with tables that are too large for it
    try:
        for made in (pl.reach(fx.orders, points, 1), pl.depart(fx.orders, points, 1), pl.depart_from_client(fx.orders, points, 4)):
            assert shuffles_by_route(made) == (1, 1)
            assert other_point_shuffles(made) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_points_of_a_line_are_cut_and_lengthened_once(spark, monkeypatch):
    """Slices are counted once per line, and the points with the tails of the next routes are written before they are read."""
    from courierlens.sources import points as sp
    from traces import trace_frame

    trace = {name: [(i * 1_000_000, 41.0, 29.0, name) for i in range(at, at + 5)] for at, name in ((0, "a"), (9, "b"))}
    points = pl.stage(trace_frame(spark, trace).select("route_id", "time", "lat", "lon"), "plan-line")
    at = "timestamp '1970-01-01 00:00:02'"
    places = ", ".join(f"29.0 as {lon}, 41.0 as {lat}" for lon, lat in (pl.PLACES["client"], pl.PLACES["warehouse"]))
    orders = spark.sql(
        f"select explode(array('a', 'b')) as _id_oid, 'j' as delivery_job_oid, 1 as delivery_batch_index, 'Europe/London' as time_zone, "
        f"{at} as reach_date, {at} as deliver_date, {at} as onway_date, {places}"
    )
    cut, plain = [], sp.even_slices
    monkeypatch.setattr(sp, "even_slices", lambda df, *rest: cut.append(df) or plain(df, *rest))
    made = pl.line_events(["reach", "depart", "depart_from_client"], orders, points, 1)
    assert [sorted(r["_id_oid"] for r in made[e].collect()) for e in ("reach", "depart_from_client")] == [["a", "b"]] * 2
    assert len(cut) == 2  # those of the line, and those with the tails
    assert "next_route_id" not in first_plan(pl.depart_from_client(orders, points, 1))


def test_a_hot_route_is_joined_in_many_tasks(spark):
    """Orders go to the slices of their route, so no task joins more of a route than one slice."""
    from traces import trace_frame

    hot = [(i * 1_000_000, 41.0, 29.0, "hot") for i in range(3000)]
    points = trace_frame(spark, {"hot": hot}).select("route_id", "time", "lat", "lon")
    orders = spark.createDataFrame([("hot", 1), ("hot", 1), ("other", 2)], "_id_oid string, mark int")
    trace = traces_of(points, orders, EventParams(slice_seconds=60))
    assert trace.count() == 3000
    assert trace.groupBy("route_id", "slice").count().agg({"count": "max"}).first()[0] <= 60


def test_latest_row_is_limited_before_the_shuffle(fx):
    plan = first_plan(keep_latest(fx.predictions, "prediction_id", ["order_id"]))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(order_id") < plan.index("Partial")


def test_first_reach_is_limited_before_the_shuffle(spark, fx):
    plan = first_plan(QUERIES["predict_reach"](spark, SF_DIR))
    final, partial = plan.index("rank(time"), plan.rindex("rank(time")
    assert final < plan.index("Exchange hashpartitioning(_id_oid") < partial
