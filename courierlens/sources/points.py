"""Courier location points and the traces cut out of them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.functions.rules import real_id
from courierlens.operators.density import even_slices
from courierlens.operators.slices import SLICE, by_slice, forward_fill, number_rows, whole, with_slice
from courierlens.operators.trace import filter_by_ids
from courierlens.params import ARTISAN, FOOD, MARKET, EventParams

# Hour partition format and the id column of each business line.
DT_FORMAT = "%Y-%m-%dT%H-00-00Z"
DT_FORMAT_SQL = "yyyy-MM-dd'T'HH'-00-00Z'"
ORDER_ID_COLUMN = {FOOD: "foodorder", ARTISAN: "artisanorder"}
MARKET_ID_COLUMN = "orderid"
HOURS_BEFORE, HOURS_AFTER = 2, 1

# position of a point in its trace; the coordinates only settle equal times
TRACE_ORDER = ("time", "lat", "lon")


def in_partitions(points: DataFrame, start: str, end: str, hours_before: int = 0, hours_after: int = 0) -> DataFrame:
    """Points of the hour partitions between two times; prunes partitions when ``dt`` is one."""
    first = datetime.fromisoformat(start) - timedelta(hours=hours_before)
    last = datetime.fromisoformat(end) + timedelta(hours=hours_after)
    return points.filter(F.col("dt").between(first.strftime(DT_FORMAT), last.strftime(DT_FORMAT)))


def attributed_points(points: DataFrame, id_columns: Sequence[str], p: EventParams = EventParams()) -> DataFrame:
    """Every point with the orders it belongs to, one per id column.

    ``raw_<column>`` is the id the point carries, ``<column>_filled`` that or
    else the courier's last known one. Any number of columns takes one shuffle.
    Points without a courier are kept, as the points of one.
    """
    raw = points.select(
        F.col("courierid").alias("courier_oid"),
        "acc",
        "status",
        F.col("createdat").cast("timestamp").alias("time"),
        "lat",
        "lon",
        *[real_id(F.col(c)).alias(f"raw_{c}") for c in id_columns],
    )
    keyed = raw.withColumn("_courier", whole("courier_oid"))
    sliced = even_slices(keyed, ["_courier"], TRACE_ORDER, p.slice_seconds, p.slice_rows)
    fills = {f"raw_{c}": f"{c}_filled" for c in id_columns}
    return forward_fill(sliced, ["_courier"], TRACE_ORDER, fills).drop(SLICE, "_courier")


def id_column_of(domain_type: int) -> str:
    return ORDER_ID_COLUMN.get(domain_type, MARKET_ID_COLUMN)


def points_of(attributed: DataFrame, domain_type: int) -> DataFrame:
    """The attributed points of one business line under ``route_id`` and ``raw_order_id``."""
    column = id_column_of(domain_type)
    return attributed.select(
        "courier_oid",
        "acc",
        "status",
        "time",
        "lat",
        "lon",
        F.col(f"raw_{column}").alias("raw_order_id"),
        F.col(f"{column}_filled").alias("route_id"),
    ).filter(F.col("route_id").isNotNull())


def window_points(
    points: DataFrame, domain_types: Sequence[int], start: str, end: str, p: EventParams = EventParams()
) -> DataFrame:
    """Attributed points of a run window for several business lines at once."""
    columns = sorted({id_column_of(d) for d in domain_types})
    return attributed_points(in_partitions(points, start, end, HOURS_BEFORE, HOURS_AFTER), columns, p)


def route_points(
    points: DataFrame,
    orders: DataFrame | None,
    domain_type: int,
    start: str,
    end: str,
    p: EventParams = EventParams(),
    indexed: bool = True,
) -> DataFrame:
    """Traces of the wanted orders: points whose forward-filled order id is one of them.

    ``orders`` is any frame with ``_id_oid``; None keeps every attributed point.
    """
    traced = points_of(window_points(points, [domain_type], start, end, p), domain_type)
    if orders is not None:
        wanted = orders.select(F.col("_id_oid").alias("route_id")).distinct()
        traced = traced.join(wanted, "route_id", "left_semi")
    if not indexed:
        return traced
    spread = with_slice(traced, "time", p.slice_seconds).repartition("route_id", SLICE)
    return number_rows(spread, ["route_id"], TRACE_ORDER, "index").drop(SLICE)


def courier_trajectory(
    points: DataFrame,
    couriers: Sequence[str] | DataFrame,
    start: str,
    end: str,
    p: EventParams = EventParams(),
) -> DataFrame:
    """Delivering points of some couriers with their order; the fill sees every status."""
    window = in_partitions(filter_by_ids(points, "courierid", couriers), start, end)
    traced = points_of(attributed_points(window, [MARKET_ID_COLUMN], p), MARKET)
    return traced.filter(F.col("status") == 900).select(
        "acc", "time", "lat", "lon", F.col("route_id").alias("_id_oid")
    )


def flatten_route_docs(docs: DataFrame) -> DataFrame:
    """One row per location of a nested route document, numbered from zero."""
    return docs.select(F.col("_id").cast("string").alias("route_id"), F.posexplode("route").alias("index", "at")).select(
        "route_id",
        "index",
        F.col("at.coordinates")[0].alias("lon"),
        F.col("at.coordinates")[1].alias("lat"),
        F.col("at.time").alias("time"),
        F.col("at.acc").alias("acc"),
    )


def spread_trace(trace: DataFrame, p: EventParams = EventParams()) -> DataFrame:
    """Shuffle a trace once, ready for the windows of ``operators.features``; one that already is stays as it is."""
    return trace if SLICE in trace.columns else by_slice(with_slice(trace, "time", p.slice_seconds), ["route_id"])


def sliced_points(points: DataFrame, p: EventParams = EventParams()) -> DataFrame:
    """Points with the slices ``traces_of`` cuts; for several events of the same points they are cut once."""
    return even_slices(points, ["route_id"], TRACE_ORDER, p.slice_seconds, p.slice_rows)


def traces_of(points: DataFrame, orders: DataFrame, p: EventParams = EventParams()) -> DataFrame:
    """Points with the attributes of their order, as ``spread_trace`` leaves them.

    The points are shuffled once, by route and slice. Not they but the orders
    go to where the join is: an order is repeated for every slice its route
    has points in, so a route with a third of all points is joined in as many
    tasks as it has slices, and the windows behind need no further shuffle.
    Repeated orders count once, repeated points stay. Slices are cut where a
    route is dense. The points are read three times, twice for their slices
    only; hand over a stored table. Points that ``sliced_points`` has cut
    already are read twice.
    """
    sliced = points if SLICE in points.columns else sliced_points(points, p)
    held = sliced.select("route_id", SLICE).distinct()
    once = orders.distinct()
    placed = held.join(once, held["route_id"] == once["_id_oid"])
    return by_slice(sliced, ["route_id"]).join(placed, ["route_id", SLICE])
