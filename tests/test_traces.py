"""Hand-made traces with answers worked out on paper."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from traces import at, metres_away, micros, trace_frame

from courierlens.functions.geo import distance_bin, haversine_km, whole_metres
from courierlens.functions.rules import decide, to_local, to_local_fixed
from courierlens.operators import events as ev
from courierlens.operators import features as ft
from courierlens.plans import pipelines as pl


def one_column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_bin_edges(spark):
    metres = [0, 49, 50, 99, 100, 149, 150, 249, 250, 399, 400, 649, 650, 1049, 1050]
    bins = one_column(spark, metres, "long").select("v", distance_bin(F.col("v")).alias("b")).orderBy("v").collect()
    assert [r["b"] for r in bins] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6, 7]
    assert one_column(spark, [None], "long").select(distance_bin(F.col("v")).alias("b")).first()["b"] is None
    with pytest.raises(Exception, match="non-negative"):
        one_column(spark, [-1], "long").select(distance_bin(F.col("v"))).collect()


def test_metres_round_half_to_even(spark):
    rounded = one_column(spark, [0.5, 1.5, 2.5, 3.49], "double").select(whole_metres(F.col("v")).alias("m")).collect()
    assert sorted(r["m"] for r in rounded) == [0, 2, 2, 3]


def test_haversine_of_antipodes_and_same_place(spark):
    row = spark.range(1).select(
        haversine_km(F.lit(0.0), F.lit(0.0), F.lit(180.0), F.lit(0.0)).alias("far"),
        haversine_km(F.lit(29.0), F.lit(41.0), F.lit(29.0), F.lit(41.0)).alias("near"),
    ).first()
    assert row["far"] == pytest.approx(3.141592653589793 * 6371) and row["near"] == 0.0


def test_rule_without_score_is_false(spark):
    values = one_column(spark, [None, float("nan"), -1.0, 0.0, 1.0], "double")
    made = values.select(decide([F.col("v")], [1.0], 0.0).alias("d"))
    assert sorted(r["d"] for r in made.collect()) == [False, False, False, True, True]


def test_local_time(spark):
    moment = datetime(2022, 4, 19, 13, 30)
    frame = spark.createDataFrame([("Europe/Istanbul",), (None,)], "zone string").withColumn("t", F.lit(moment))
    rows = frame.select("zone", to_local(F.col("t"), F.col("zone")).alias("l"), to_local_fixed(F.col("t")).alias("i"))
    hours = {r["zone"]: (r["l"].hour, r["i"].hour) for r in rows.collect()}
    assert hours == {"Europe/Istanbul": (16, 16), None: (13, 16)}


@pytest.mark.parametrize(
    ("metres", "seconds", "reached"),
    [(10, 1, False), (10, 2, True), (60, 19, False), (60, 20, True), (120, 150, False), (120, 151, True)],
)
def test_seconds_needed_in_a_bin(spark, metres, seconds, reached):
    trace = metres_away(metres, 5000, 5000, step=seconds)
    trace[2] = (trace[1][0] + 1, *trace[2][1:])
    features = ft.reach_features(trace_frame(spark, {"a": trace}), "client", include_all=True)
    assert (ev.first_reach(features).count() == 1) is reached


def test_point_limits(spark):
    near = {n: metres_away(*[20 + 60 * i for i in range(n)]) for n in (2, 3, 4)}
    frame = trace_frame(spark, {str(n): t for n, t in near.items()}, place="client")
    reached = ft.reach_features(frame, "client", include_all=True)
    assert {r[0] for r in reached.select("route_id").distinct().collect()} == {"3", "4"}
    frame = trace_frame(spark, {str(n): t for n, t in near.items()}, place="warehouse")
    # the first two rows and the last have no centred mean
    left = ft.depart_features(frame, "warehouse").groupBy("route_id").count().collect()
    assert {r["route_id"]: r["count"] for r in left} == {"4": 1}


def test_stay_restarts_after_leaving_a_bin(spark):
    features = ft.reach_features(trace_frame(spark, {"a": metres_away(10, 10, 70, 10, 10)}), "client", include_all=True)
    rows = features.orderBy("time").select("distance_bin", "time_passed_in_bin", "distance_bin_group").collect()
    assert [tuple(r) for r in rows] == [(0, 60, 1), (0, 120, 1), (1, 60, 2), (0, 60, 3), (0, 60, 3)]


def test_dwell_drops_days_and_parts_of_seconds(spark):
    gap = 86_400_000_000 + 5_900_000
    trace = [(0, 41.0, 29.0, "o"), (gap, 41.0, 29.0, "o"), (gap + 1_000_000, 41.0, 29.0, "o")]
    features = ft.reach_features(trace_frame(spark, {"a": trace}), "client", include_all=True)
    assert [r["tbe"] for r in features.orderBy("time").select("tbe").collect()] == [5, 1, 0]


def test_zero_step_and_point_on_target_are_no_candidates(spark):
    trace = metres_away(10, 40, 80, 0, 160, 200)
    trace[2] = (trace[1][0], *trace[2][1:])
    frame = trace_frame(spark, {"a": trace}, place="warehouse")
    rows = ft.client_departure_features(frame.withColumnsRenamed(dict(zip(ft.PLACES["warehouse"], ft.PLACES["client"]))))
    by_time = rows.orderBy("time", "lat").select("smooth_speed_to_client", "dbw_client_log").collect()
    assert [r["smooth_speed_to_client"] is None for r in by_time] == [True, True, True, True, False, True]
    assert by_time[3]["dbw_client_log"] is None


def client_case(spark, seconds_after_reach: int, reach: int = 0):
    """Four points near the client, then far; the sign is the fifth point."""
    step = seconds_after_reach / 4
    trace = metres_away(20, 20, 20, 20, 500, 1500, step=1)
    trace = [(int(i * step * 1_000_000), *p[1:]) for i, p in enumerate(trace)]
    frame = trace_frame(spark, {"a": trace}, {"a": {"reach": reach, "deliver": 10**12}})
    return ev.first_client_departure(ft.client_departure_features(frame)).select(micros("time")).collect()


def test_ninety_second_rule(spark):
    assert client_case(spark, 90) != client_case(spark, 91)
    # the point before the sign is the answer
    assert [r["time"] for r in client_case(spark, 91)] == [int(91 / 4 * 3 * 1_000_000)]


def test_sign_itself_if_the_point_before_is_too_early(spark):
    # reached between the fourth and the fifth point; more than 90 s before the latter
    step = 100_000_000
    trace = [(i * step, *p[1:]) for i, p in enumerate(metres_away(20, 20, 20, 20, 500, 1500, 3000))]
    frame = trace_frame(spark, {"a": trace}, {"a": {"reach": 3 * step + 5_000_000, "deliver": 10**12}})
    rows = ev.first_client_departure(ft.client_departure_features(frame)).select(micros("time")).collect()
    assert [r["time"] for r in rows] == [4 * step]


def predictions(spark, rows):
    return spark.createDataFrame(
        [(i, at(t) if t is not None else None, at(t) if t is not None else None, 1.0, 2.0) for i, t in rows],
        "_id_oid string, time timestamp, time_l timestamp, lat double, lon double",
    )


def test_first_batch_is_given_to_the_job(spark):
    orders = spark.createDataFrame(
        [("a1", "a", 1), ("a2", "a", 2), ("a3", "a", 3), ("b1", "b", 1), ("b2", "b", 2), ("c2", "c", 2), ("n", None, 1)],
        "_id_oid string, delivery_job_oid string, delivery_batch_index int",
    )
    made = predictions(spark, [("a1", 10), ("a2", 20), ("b2", 30), ("c2", 40), ("n", 50)])
    rows = ev.propagate_first_batch(made, orders).select("_id_oid", micros("time")).collect()
    assert {r["_id_oid"]: r["time"] for r in rows} == {"a1": 10, "a2": 10, "a3": 10, "b1": None}
    done = ev.complete_over_orders(orders, ev.propagate_first_batch(made, orders))
    assert done.filter("time is null").count() == 4 and done.count() == 7


def test_midpoint_rounds_towards_the_reach_time(spark):
    reach = predictions(spark, [("a", 100), ("b", 100), ("c", None)])
    left = predictions(spark, [("a", 105), ("b", 95), ("c", 7)])
    rows = ev.delivery_midpoint(reach, left).select("_id_oid", micros("time")).collect()
    assert {r["_id_oid"]: r["time"] for r in rows} == {"a": 102, "b": 98}


def test_order_without_trace(spark):
    orders = trace_frame(spark, {"a": metres_away(10, 10, 10), "z": metres_away(10)}).drop(
        "route_id", "time", "lat", "lon", "raw_order_id"
    ).distinct()
    points = trace_frame(spark, {"a": metres_away(10, 10, 10)}).select("route_id", "time", "lat", "lon", "raw_order_id")
    rows = pl.reach(orders, points, 4).collect()
    assert {r["_id_oid"]: r["time"] is None for r in rows} == {"a": False, "z": True}
    assert pl.deliver(orders, points, 4).count() == 0


def test_empty_merchant_trace_gives_nothing(spark):
    orders = trace_frame(spark, {"a": metres_away(10, 10, 10)}, place="merchant").drop(
        "route_id", "time", "lat", "lon", "raw_order_id"
    ).distinct()
    points = trace_frame(spark, {"a": metres_away(10, 10)}).select("route_id", "time", "lat", "lon", "raw_order_id")
    assert pl.reach_to_merchant(orders, points, 2).count() == 0


def test_event_tokens():
    assert pl.events_for(["depart", "reach"], 2) == ["depart_from_merchant", "depart_from_courier_warehouse"]
    assert pl.events_for(["deliver", "reach_to_merchant"], 1) == ["deliver"]
    with pytest.raises(ValueError, match="unknown"):
        pl.events_for(["arrive"], 1)
