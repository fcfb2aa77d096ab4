"""Random traces against the loops of ``naive``, with slices shorter than the traces."""

from __future__ import annotations

import random

import naive
import pytest
from pyspark.sql import functions as F
from traces import METRE, PLACE, micros, trace_frame

from courierlens.operators import events as ev
from courierlens.operators import features as ft
from courierlens.params import EventParams

SLICES = [30, 300, 86400]


def random_traces(seed: int, count: int = 150) -> dict:
    rng = random.Random(seed)
    traces = {}
    for number in range(count):
        t, north, points = 0, rng.uniform(-300, 300), set()
        for _ in range(rng.randint(1, 25)):
            t += rng.choice([0, 1_000_000, 7_300_000, 45_000_000, 200_000_001]) if rng.random() < 0.3 else rng.randint(1, 90) * 1_000_000
            if rng.random() < 0.02:
                t += 86_400_000_000
            north += rng.uniform(-120, 120)
            lat = PLACE[1] if rng.random() < 0.03 else round(PLACE[1] + north * METRE, 7)
            raw = f"t{number}" if rng.random() < 0.9 else None
            points.add((t, lat, round(PLACE[0] + rng.uniform(-20, 20) * METRE, 7), raw))
        # equal places at equal times would leave the order of rows open
        seen = {}
        for point in points:
            seen[point[:3]] = point
        traces[f"t{number}"] = sorted(seen.values(), key=lambda p: p[:3])
    return traces


@pytest.fixture(scope="module")
def traces():
    return random_traces(11)


def attributes(traces: dict) -> dict:
    rng = random.Random(5)
    marks = {}
    for route, points in traces.items():
        first, last = points[0][0], points[-1][0]
        onway, reach = rng.randint(first - 1_000_000, last), rng.randint(first - 1_000_000, last)
        marks[route] = {"onway": onway, "reach": reach, "deliver": reach + rng.choice([30_000_000, 300_000_000])}
    return marks


def found(df) -> dict:
    out: dict = {}
    for row in df.select("_id_oid", micros("time"), "lat", "lon").collect():
        out.setdefault(row["_id_oid"], []).append((row["time"], row["lat"], row["lon"]))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("seconds", SLICES)
def test_reach(spark, traces, seconds):
    p = EventParams(slice_seconds=seconds)
    features = ft.reach_features(trace_frame(spark, traces), "client", p, include_all=True)
    rows = features.select(
        "route_id", micros("time"), "lat", "lon", "distance_bin", "tbe", "time_passed_in_bin", "distance_bin_group", "previous_distance_bin"
    ).collect()
    ours = sorted(tuple(r) for r in rows)
    expected = sorted(
        (route, r["t"], r["lat"], r["lon"], r["bin"], r["tbe"], r["in_bin"], r["run"], r["prev"])
        for route, points in traces.items()
        for r in naive.reach_rows(points, PLACE)
    )
    assert ours == expected
    hits = {r: naive.first_reach(points, PLACE) for r, points in traces.items()}
    assert found(ev.first_reach(features, p)) == {r: hit for r, hit in hits.items() if hit}


@pytest.mark.parametrize("seconds", SLICES)
@pytest.mark.parametrize("use_onway", [True, False])
def test_depart(spark, traces, seconds, use_onway):
    p = EventParams(slice_seconds=seconds)
    marks = attributes(traces)
    frame = trace_frame(spark, traces, marks, "warehouse")
    ours = found(ev.first_depart(ft.depart_features(frame, "warehouse", p), p, use_onway))
    expected = {
        r: naive.first_depart(points, PLACE, marks[r]["onway"] if use_onway else None) for r, points in traces.items()
    }
    assert ours == {r: [hit] for r, hit in expected.items() if hit}
    assert len(ours) > 10


@pytest.mark.parametrize("seconds", SLICES)
def test_client_departure(spark, traces, seconds):
    p = EventParams(slice_seconds=seconds)
    marks = attributes(traces)
    features = ft.client_departure_features(trace_frame(spark, traces, marks), p)
    ours = found(ev.first_client_departure(features, p))
    expected = {
        r: naive.first_client_departure(points, PLACE, marks[r]["reach"], marks[r]["deliver"])
        for r, points in traces.items()
    }
    assert ours == {r: [hit] for r, hit in expected.items() if hit}
    assert len(ours) > 10


def test_movement_values(spark, traces):
    p = EventParams(slice_seconds=60)
    rows = ft.client_departure_features(trace_frame(spark, traces), p).select(
        "route_id", micros("time"), "lat", "lon", "smooth_speed_to_client", "smooth_speed_to_prev_event", "dbw_client_log"
    )
    ours = {tuple(r)[:4]: tuple(r)[4:] for r in rows.collect()}
    for route, points in traces.items():
        for r in naive.movement_rows(points, PLACE):
            values = ours.pop((route, r["t"], r["lat"], r["lon"]))
            expected = (r["s_to"], r["s_along"], r["log"])
            assert [v is None for v in values] == [v is None for v in expected]
            assert [v for v in values if v is not None] == pytest.approx([v for v in expected if v is not None], abs=1e-6)
    assert not ours


def test_one_hot_route_is_spread(spark):
    """A route with a third of all rows runs in many groups, none larger than a slice."""
    hot = [(i * 1_000_000, PLACE[1] + (i % 97) * METRE, PLACE[0], "hot") for i in range(3000)]
    cold = {f"c{n}": [(i * 1_000_000, PLACE[1], PLACE[0], "c") for i in range(20)] for n in range(300)}
    p = EventParams(slice_seconds=60)
    frame = trace_frame(spark, {"hot": hot, **cold})
    from courierlens.sources.points import spread_trace

    largest = spread_trace(frame, p).groupBy("route_id", "slice").count().agg(F.max("count")).first()[0]
    assert largest <= 60
    rows = ft.reach_features(frame, "client", p, include_all=True).filter("route_id = 'hot'")
    ours = [tuple(r) for r in rows.select(micros("time"), "time_passed_in_bin").orderBy("time").collect()]
    assert ours == [(r["t"], r["in_bin"]) for r in naive.reach_rows(hot, PLACE)]
