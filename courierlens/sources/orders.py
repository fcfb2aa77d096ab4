"""Orders of each business line, ready for event detection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.operators.reducer import keep_possible
from courierlens.operators.trace import filter_by_ids, only_unpredicted, pivot_status_log
from courierlens.params import DEFAULT_ZONE, FINISHED_STATUSES, MARKET_DOMAINS, WATER

MARGIN_HOURS = 1
# Columns of a market or water order.
MARKET_COLUMNS = [
    "delivery_route_oid",
    "_id_oid",
    "courier_courier_oid",
    "checkoutdatel",
    "deliver_date",
    "reach_date",
    "onway_date",
    "deliver_location__coordinates_lon",
    "deliver_location__coordinates_lat",
    "reach_location__coordinates_lon",
    "reach_location__coordinates_lat",
    "delivery_address_location__coordinates_lon",
    "delivery_address_location__coordinates_lat",
    "warehouse_location__coordinates_lon",
    "warehouse_location__coordinates_lat",
    "handover_date",
]


def _between(column: str, start: str | datetime, end: str | datetime):
    return F.col(column).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))


def _with_zone(orders: DataFrame, zones: DataFrame) -> DataFrame:
    named = zones.select(F.col("country_id").alias("country_oid"), "time_zone")
    return orders.join(named, "country_oid", "left")


def job_dates(orders: DataFrame) -> DataFrame:
    """Per job: latest start, latest delivery and the handover of the highest batch.

    Orders without a job count as one job together. As a grouping this is
    combined before the shuffle, so that large group costs one row per task.
    """
    batch = F.col("delivery_batch_index")
    top = F.struct(batch.isNull(), batch, F.col("_id_oid"))
    return orders.groupBy(F.col("delivery_job_oid").alias("_job")).agg(
        F.max("onway_date").alias("job_onway"),
        F.max("deliver_date").alias("max_deliver_date"),
        F.max_by("handover_date", top).alias("job_handover"),
    )


def with_job(rows: DataFrame, jobs: DataFrame, column: str = "delivery_job_oid", order_id: str = "_id_oid") -> DataFrame:
    """Rows with what ``jobs`` (``_job`` and more) says of their job, if it says anything.

    ``jobs`` is a grouping by job, so at most one of its rows has no job. Orders
    without a job take it from a broadcast of one row; in the shuffled join
    they are keys of their own, spread by their id, and find no partner.
    """
    told = [c for c in jobs.columns if c != "_job"]
    said = F.struct(*told)
    named = jobs.select(F.struct("_job", F.lit(None).cast("long").alias("_salt")).alias("_key"), said.alias("_said"))
    alone = jobs.agg(F.max_by(said, F.when(F.col("_job").isNull(), 1)).alias("_alone")).select("_alone", F.lit(True).alias("_jobless"))
    jobless = F.col(column).isNull()
    salt = F.when(jobless, F.xxhash64(order_id))
    keyed = rows.withColumns({"_key": F.struct(F.col(column).alias("_job"), salt.alias("_salt")), "_jobless": jobless})
    met = keyed.join(named, "_key", "left").join(F.broadcast(alone), "_jobless", "left").withColumn("_told", F.coalesce("_said", "_alone"))
    return met.filter("_told is not null").select(*rows.columns, *[F.col(f"_told.{c}").alias(c) for c in told])


def market_orders(
    orders: DataFrame,
    zones: DataFrame,
    start: str,
    end: str,
    courier_ids: Sequence[str] | DataFrame | None = None,
    jobless_together: bool = True,
) -> DataFrame:
    """Finished market orders whose whole job was delivered within the window.

    Orders are read with a margin around the window, so the dates of a job
    that straddles its edge are complete before the job is tested against it.
    Orders without a job are one job, or with ``jobless_together=False`` each
    a job of its own.
    """
    margin = timedelta(hours=MARGIN_HOURS)
    first, last = datetime.fromisoformat(start) - margin, datetime.fromisoformat(end) + margin
    finished = orders.filter(
        F.col("status").isin(*FINISHED_STATUSES)
        & _between("deliver_date", first, last)
        & F.col("domaintype").isin(*MARKET_DOMAINS)
    )
    finished = filter_by_ids(finished, "courier_courier_oid", courier_ids)
    jobs = job_dates(finished if jobless_together else finished.filter(F.col("delivery_job_oid").isNotNull()))
    in_window = with_job(finished, jobs).filter(_between("max_deliver_date", start, end))
    if not jobless_together:
        own = finished.filter(F.col("delivery_job_oid").isNull() & _between("deliver_date", start, end)).withColumns(
            {"job_onway": F.col("onway_date"), "job_handover": F.col("handover_date"), "max_deliver_date": F.col("deliver_date")}
        )
        in_window = in_window.unionByName(own, allowMissingColumns=True)
    return (
        _with_zone(in_window, zones)
        .withColumn("onway_date", F.col("job_onway"))
        .withColumn("handover_date", F.col("job_handover"))
        .select(*MARKET_COLUMNS, "delivery_job_oid", "delivery_batch_index", "time_zone", "max_deliver_date")
    )


def water_orders(
    orders: DataFrame,
    zones: DataFrame,
    predictions: DataFrame,
    predicted: str,
    start: str,
    end: str,
    courier_ids: Sequence[str] | DataFrame | None = None,
    repeat: bool = True,
) -> DataFrame:
    """Finished water orders of the window that have no prediction in ``predicted`` yet.

    ``repeat`` is that of ``only_unpredicted``.
    """
    finished = orders.filter(
        F.col("status").isin(*FINISHED_STATUSES)
        & _between("deliver_date", start, end)
        & (F.col("domaintype") == WATER)
    )
    finished = filter_by_ids(finished, "courier_courier_oid", courier_ids)
    waiting = only_unpredicted(finished, predictions, predicted, repeat)
    return _with_zone(waiting, zones).select(*MARKET_COLUMNS, "time_zone")


def merchant_orders(
    orders: DataFrame,
    status_log: DataFrame,
    predictions: DataFrame,
    couriers: DataFrame,
    warehouses: DataFrame,
    start: str,
    end: str,
    domain_type: int,
    courier_domains: DataFrame | None = None,
    courier_ids: Sequence[str] | DataFrame | None = None,
    repeat: bool = True,
) -> DataFrame:
    """Finished food (2) or artisan (6) orders of the window not yet predicted to reach the merchant.

    With ``courier_domains`` an order is repeated for each business line of
    its courier; pipelines leave it out and use ``with_courier_domain``. Of
    the status log only what may belong to the window's orders is shuffled.
    ``repeat`` is that of ``only_unpredicted``.
    """
    finished = orders.filter(
        F.col("status").isin(*FINISHED_STATUSES)
        & (F.col("deliverytype") == 1)
        & _between("deliverdate", start, end)
    )
    finished = filter_by_ids(finished, "courier_oid", courier_ids)
    waiting = only_unpredicted(finished, predictions, "predicted_reach_date", repeat)
    places = couriers.select(F.col("_id_oid").alias("courier_oid"), F.col("warehouse_oid").alias("warehouse")).join(
        warehouses.select(
            "warehouse",
            F.col("lat").alias("warehouse_location__coordinates_lat"),
            F.col("lon").alias("warehouse_location__coordinates_lon"),
        ),
        "warehouse",
    )
    logged = pivot_status_log(keep_possible(status_log, {"data_foodorder": finished.select("_id_oid")}))
    joined = waiting.join(logged, waiting["_id_oid"] == logged["status_order_id"], "left").join(
        places, "courier_oid", "left"
    )
    columns = [
        F.col("route_oid").alias("delivery_route_oid"),
        F.col("_id_oid"),
        F.col("courier_oid").alias("courier_courier_oid"),
        F.col("checkoutdatel"),
        F.col("deliverdate").alias("deliver_date"),
        F.col("reachdate").alias("reach_date"),
        F.col("handoverdate"),
        F.col("deliveryaddress_location__coordinates_lon"),
        F.col("deliveryaddress_location__coordinates_lat"),
        F.col("restaurantloc_lon"),
        F.col("restaurantloc_lat"),
        *[F.col(c) for c in logged.columns if c != "status_order_id"],
        F.lit(domain_type).alias("domaintype"),
        F.lit(DEFAULT_ZONE).alias("time_zone"),
        F.col("warehouse_location__coordinates_lat"),
        F.col("warehouse_location__coordinates_lon"),
    ]
    if courier_domains is not None:
        lines = courier_domains.select(F.col("_p_id_oid").alias("courier_oid"), "domaintypes")
        joined = joined.join(lines, "courier_oid", "left")
        columns.append(F.col("domaintypes"))
    return joined.select(*columns)
