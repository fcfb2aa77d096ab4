"""Samples of orders and their recorded routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.operators.trace import filter_by_ids
from courierlens.params import FINISHED_STATUSES, MARKET

# What a sampled order consists of.
SAMPLE_COLUMNS = [
    "delivery_route_oid",
    "_id_oid",
    "courier_courier_oid",
    "checkoutdatel",
    "deliver_date",
    "reach_date",
    "client_location__coordinates_lon",
    "client_location__coordinates_lat",
    "deliver_location__coordinates_lon",
    "deliver_location__coordinates_lat",
    "reach_location__coordinates_lon",
    "reach_location__coordinates_lat",
    "delivery_address_location__coordinates_lon",
    "delivery_address_location__coordinates_lat",
]


def sample_orders(
    orders: DataFrame,
    start: str,
    end: str,
    n: int = 10000,
    seed: int = 0,
    courier_ids: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """``n`` random finished market orders by local checkout time.

    Orders are drawn by a digest of id and seed, so the same seed gives the
    same sample wherever and however often the job runs.
    """
    finished = orders.filter(
        F.col("status").isin(*FINISHED_STATUSES)
        & F.col("checkoutdatel").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
        & (F.col("domaintype") == MARKET)
    )
    draw = F.md5(F.concat_ws(":", F.col("_id_oid"), F.lit(str(seed))))
    chosen = filter_by_ids(finished, "courier_courier_oid", courier_ids)
    return chosen.select(*[c for c in SAMPLE_COLUMNS if c in orders.columns]).orderBy(draw, "_id_oid").limit(n)


def routes_for_orders(route_points: DataFrame, orders: DataFrame) -> DataFrame:
    """Recorded points of the orders' delivery routes, ordered by route and time."""
    wanted = orders.select(F.col("delivery_route_oid").alias("route_id")).distinct()
    return route_points.join(wanted, "route_id", "left_semi").orderBy("route_id", "time")
