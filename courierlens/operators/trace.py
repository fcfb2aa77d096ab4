"""Joins and filters that prepare traces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.operators.ranks import quartiles
from courierlens.params import MIN_POINTS


def filter_by_ids(df: DataFrame, column: str, ids: Sequence | DataFrame | None) -> DataFrame:
    """Keep rows with a listed id; no list, or an empty one, keeps everything.

    Ids may also come as the first column of a frame, of any size.
    """
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(column)).distinct(), column, "left_semi")
    return df.filter(F.col(column).isin(list(ids))) if ids else df


def join_trace(points: DataFrame, orders: DataFrame) -> DataFrame:
    """Points with the attributes of their order; a repeated order row counts once, a repeated point stays.

    A route far longer than others is left to the skew handling of the
    adaptive join; small order tables are broadcast by it after their size is
    known.
    """
    once = orders.distinct()
    return points.join(once, points["route_id"] == once["_id_oid"], "inner")


def min_points(trace: DataFrame, n: int = MIN_POINTS, by: str = "route_id") -> DataFrame:
    """Keep routes that have at least ``n`` points with a time."""
    long_enough = trace.groupBy(by).agg(F.count("time").alias("_points")).filter(F.col("_points") >= n)
    return trace.join(long_enough.select(by), by, "left_semi")


def pivot_status_log(log: DataFrame) -> DataFrame:
    """Latest recorded place and time of the two status events of each order."""
    order_id = F.col("data_foodorder")

    def at(method: str, column: str, name: str) -> Column:
        return F.max(F.when(F.col("data_method") == method, F.col(column))).alias(name)

    columns = []
    # The two status events that carry a place.
    for method, prefix in (
        ("courierReachedToRestaurant", "reached_to_restaurant"),
        ("courierReachedToClient", "reached_to_client"),
    ):
        columns += [
            at(method, "location__coordinates_lat", f"{prefix}_lat"),
            at(method, "location__coordinates_lon", f"{prefix}_lon"),
            at(method, "createdatl", f"{prefix}_createdatl"),
        ]
    return log.filter(order_id.isNotNull() & (order_id != "null")).groupBy(order_id.alias("status_order_id")).agg(*columns)


def only_unpredicted(orders: DataFrame, predictions: DataFrame, column: str, repeat: bool = True) -> DataFrame:
    """Orders without a prediction row, or with one whose ``column`` is missing.

    A row with a missing value counts even if another row of the order is
    filled. With ``repeat`` an order comes back once per such row, as a left
    join gives it; without, once, and the predictions of an order shrink to
    one row before the shuffle.
    """
    if not repeat:
        filled = predictions.groupBy(F.col("order_id").alias("_predicted_id")).agg(
            (F.count(column) == F.count(F.lit(1))).alias("_all_filled")
        )
        done = filled.filter("_all_filled").select("_predicted_id")
        return orders.join(done, orders["_id_oid"] == done["_predicted_id"], "left_anti")
    made = predictions.select(F.col("order_id").alias("_predicted_id"), F.col(column).alias("_predicted"))
    return (
        orders.join(made, orders["_id_oid"] == F.col("_predicted_id"), "left")
        .filter(F.col("_predicted_id").isNull() | F.col("_predicted").isNull())
        .drop("_predicted_id", "_predicted")
    )


def with_courier_domain(orders: DataFrame, domains: DataFrame, allowed: Sequence[int] = (1, 3)) -> DataFrame:
    """Orders whose courier works in one of the allowed business lines; never repeats an order."""
    couriers = domains.filter(F.col("domaintypes").isin(list(allowed))).select(
        F.col("_p_id_oid").alias("courier_courier_oid")
    ).distinct()
    return orders.join(couriers, "courier_courier_oid", "left_semi")


def iqr_outliers(df: DataFrame, column: str, whisker: float = 1.5, approx: bool = False) -> DataFrame:
    """Keep values within ``whisker`` interquartile ranges of the quartiles, bounds included."""
    first, third = quartiles(df, column, approx)
    if first is None:
        return df.limit(0)
    reach = whisker * (third - first)
    return df.filter(F.col(column).between(first - reach, third + reach))
