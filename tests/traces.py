"""Small frames for trace tests."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from courierlens.operators.features import PLACES

START = datetime(2022, 4, 19, 13, 30, tzinfo=timezone.utc)
PLACE = (29.0, 41.0)
METRE = 1 / 111194.92664455874  # degrees of latitude
COLUMNS = "route_id string, time timestamp, lat double, lon double, raw_order_id string"


def at(micros: int) -> datetime:
    return START + timedelta(microseconds=micros)


def micros(column: str):
    return (F.unix_micros(column) - int(START.timestamp() * 1_000_000)).alias(column)


def trace_frame(spark, traces: dict, orders: dict | None = None, place: str = "client"):
    """Trace frame of {route: [(micros, lat, lon, raw id)]}; ``orders`` adds attributes per route."""
    rows = [(route, at(t), lat, lon, raw) for route, points in traces.items() for t, lat, lon, raw in points]
    lon, lat = PLACES[place]
    frame = (
        spark.createDataFrame(rows, COLUMNS)
        .withColumn("_id_oid", F.col("route_id"))
        .withColumn(lon, F.lit(PLACE[0]))
        .withColumn(lat, F.lit(PLACE[1]))
    )
    defaults = {
        "time_zone": "UTC",
        "delivery_route_oid": "r",
        "courier_courier_oid": "c",
        "onway": 0,
        "reach": 0,
        "deliver": 0,
    }
    given = [
        (route, *[(orders or {}).get(route, {}).get(k, v) for k, v in defaults.items()]) for route in traces
    ]
    attributes = spark.createDataFrame(
        [(r, z, d, c, at(o), at(a), at(x)) for r, z, d, c, o, a, x in given],
        "route_id string, time_zone string, delivery_route_oid string, courier_courier_oid string,"
        "onway_date timestamp, reach_date timestamp, deliver_date timestamp",
    )
    return frame.join(attributes, "route_id")


def metres_away(*distances: float, step: int = 60, raw: str | None = "o"):
    """Points at the given distances north of the place, ``step`` seconds apart."""
    return [(i * step * 1_000_000, PLACE[1] + d * METRE, PLACE[0], raw) for i, d in enumerate(distances)]
