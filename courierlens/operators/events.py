"""Decisions: which point of a trace is the event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlens.functions.rules import decide, halfway, seconds_between, to_local
from courierlens.operators.slices import SLICE, in_slice, position, running, with_slice
from courierlens.params import EventParams
from courierlens.sources.points import TRACE_ORDER

PREDICTION_COLUMNS = ["_id_oid", "time", "time_l", "lat", "lon"]


def place_of(point: Column) -> Column:
    return F.struct(point["time"].alias("time"), point["lat"].alias("lat"), point["lon"].alias("lon"))


def reach_rule(p: EventParams = EventParams()) -> Column:
    return decide(
        [F.col("distance_bin"), F.ln(F.col("time_passed_in_bin") + 1)], p.reach_weights, p.reach_intercept
    )


def depart_rule(p: EventParams = EventParams()) -> Column:
    inputs = [F.col(c) for c in ("smooth_speed_to_warehouse", "smooth_speed_to_prev_event", "dbw_warehouse_log")]
    return decide(inputs, p.depart_weights, p.depart_intercept)


def client_departure_rule(p: EventParams = EventParams()) -> Column:
    inputs = [F.col(c) for c in ("smooth_speed_to_client", "smooth_speed_to_prev_event", "dbw_client_log")]
    return decide(inputs, p.client_weights, p.client_intercept)


def first_reach(features: DataFrame, p: EventParams = EventParams()) -> DataFrame:
    """First point of each order where the courier counts as arrived; equal times stay side by side.

    The rank limit is applied before the shuffle too, so an order with very
    many hits sends few of them.
    """
    by_time = Window.partitionBy("_id_oid").orderBy("time")
    return (
        features.filter(reach_rule(p))
        .withColumn("_rank", F.rank().over(by_time))
        .filter(F.col("_rank") == 1)
        .select("_id_oid", "time", to_local(F.col("time"), F.col("time_zone")).alias("time_l"), "lat", "lon")
    )


def first_depart(features: DataFrame, p: EventParams = EventParams(), use_onway: bool = True) -> DataFrame:
    """The point just before the courier was seen leaving, the earliest one per order.

    A point shows a departure if the rule holds while the point before it was
    near; with ``use_onway`` both must lie after the order went on its way.
    "Before" means before among the given rows, also across time slices: each
    slice reports its best answer, its first row and its last row, and a last
    look compares the first row of a slice with the last row before it.
    """
    rows = in_slice(["route_id"], TRACE_ORDER)
    at = position(TRACE_ORDER)
    # without the rule every row lies "after" the start
    after_onway = F.col("time") > F.col("onway_date") if use_onway else F.lit(True)
    sliced = features if SLICE in features.columns else with_slice(features, "time", p.slice_seconds)
    marked = (
        sliced.withColumn("_leaves", depart_rule(p) & F.coalesce(after_onway, F.lit(False)))
        .withColumn("_fits", F.coalesce(after_onway, F.lit(False)))
        .withColumn(
            "_point", F.struct("time", "lat", "lon", F.col("distance_to_warehouse").alias("metres"), F.col("_fits").alias("fits"))
        )
        .withColumn("_back", F.lag("_point").over(rows))
    )

    def answer(leaves: Column, back: Column) -> Column:
        near = back["metres"] < p.max_depart_metres
        return F.when(leaves & near & back["fits"], place_of(back))

    slices = marked.groupBy("route_id", SLICE).agg(
        F.min(answer(F.col("_leaves"), F.col("_back"))).alias("_best"),
        F.min_by("_leaves", at).alias("_first_leaves"),
        F.max_by("_point", at).alias("_last"),
        F.first("_id_oid").alias("_id_oid"),
        F.first("time_zone").alias("time_zone"),
    )
    by_slice = Window.partitionBy("route_id").orderBy(SLICE)
    edges = slices.withColumn("_before", F.lag("_last").over(by_slice))
    edge = answer(F.col("_first_leaves"), F.col("_before"))
    return (
        edges.withColumn("_edge", edge)
        .groupBy("route_id")
        .agg(
            F.min(F.least("_best", "_edge")).alias("at"),
            F.first("_id_oid").alias("_id_oid"),
            F.first("time_zone").alias("time_zone"),
        )
        .filter(F.col("at").isNotNull())
        .select(
            "_id_oid",
            F.col("at.time").alias("time"),
            to_local(F.col("at.time"), F.col("time_zone")).alias("time_l"),
            F.col("at.lat").alias("lat"),
            F.col("at.lon").alias("lon"),
        )
    )


def propagate_first_batch(predictions: DataFrame, orders: DataFrame) -> DataFrame:
    """All orders of a job take over the prediction of the job's first batch.

    Orders without a job, and jobs without a first batch, have no row; if the
    first batch has no prediction only its own, empty row remains.
    """
    jobs = (
        orders.filter(F.col("delivery_job_oid").isNotNull())
        .groupBy("_id_oid")
        .agg(F.max("delivery_job_oid").alias("job"), F.max("delivery_batch_index").alias("batch"))
    )
    first_orders = jobs.filter(F.col("batch") == 1).groupBy("job").agg(F.min("_id_oid").alias("first_id"))
    firsts = first_orders.join(
        predictions.withColumnRenamed("_id_oid", "first_id"), "first_id", "left"
    )
    return (
        jobs.join(firsts, "job")
        .filter((F.col("_id_oid") == F.col("first_id")) | ((F.col("batch") > 1) & F.col("time").isNotNull()))
        .select(*PREDICTION_COLUMNS)
    )


def first_client_departure(features: DataFrame, p: EventParams = EventParams()) -> DataFrame:
    """When the courier left the client: the point before the first sign of leaving, if it fits.

    A sign must come at or after the order's reach time, right after a point
    near the client, and either more than the holding time after reaching or
    after delivery. The answer is the one point at the time before the first
    sign if it is not earlier than reaching, otherwise the sign itself. Several
    points at one time have no "one point", as ranks with ties skip it.
    """
    rows = in_slice(["route_id"], TRACE_ORDER)
    tied = Window.partitionBy("route_id", SLICE, "time").orderBy(*[F.col(c).asc_nulls_last() for c in TRACE_ORDER])
    stayed = seconds_between(F.col("reach_date"), F.col("time"))
    sign = (
        client_departure_rule(p)
        & (F.col("time") >= F.col("reach_date"))
        & (F.col("prev_point.metres") < p.max_client_metres)
        & ((stayed > p.client_hold_seconds) | (F.col("time") >= F.col("deliver_date")))
    )
    # points of equal time share a slice; what counts is the one that comes first among them
    marked = (
        features.withColumn("_before", F.first("prev_point").over(running(tied)))
        .withColumn("_before_that", F.first("prev_point_2").over(running(tied)))
        .withColumn("_here", F.first(F.struct("time", "lat", "lon")).over(running(tied)))
    )
    before = F.col("_before")
    alone = F.col("_before_that").isNull() | (F.col("_before_that.time") < before["time"])
    fits = before.isNotNull() & alone & (before["time"] >= F.col("reach_date"))
    answer = F.when(fits, place_of(before)).otherwise(F.col("_here"))
    return (
        marked.filter(sign)
        .groupBy("_id_oid")
        .agg(F.min_by(answer, position(TRACE_ORDER)).alias("at"), F.first("time_zone").alias("time_zone"))
        .select(
            "_id_oid",
            F.col("at.time").alias("time"),
            to_local(F.col("at.time"), F.col("time_zone")).alias("time_l"),
            F.col("at.lat").alias("lat"),
            F.col("at.lon").alias("lon"),
        )
    )


def one_per_order(predictions: DataFrame) -> DataFrame:
    """One row per order: the earliest prediction, places settling equal times."""
    return (
        predictions.filter(F.col("time").isNotNull())
        .groupBy("_id_oid")
        .agg(F.min(F.struct("time", "lat", "lon", "time_l")).alias("at"))
        .select("_id_oid", "at.time", "at.time_l", "at.lat", "at.lon")
    )


def delivery_midpoint(reach: DataFrame, departure: DataFrame) -> DataFrame:
    """Delivery lies halfway between reaching and leaving the client, at the place of leaving."""
    arrived = reach.filter(F.col("time").isNotNull()).select(
        "_id_oid", F.col("time").alias("_reach"), F.col("time_l").alias("_reach_l")
    )
    left = departure.filter(F.col("time").isNotNull())
    return arrived.join(left, "_id_oid").select(
        "_id_oid",
        halfway(F.col("_reach"), F.col("time")).alias("time"),
        halfway(F.col("_reach_l"), F.col("time_l")).alias("time_l"),
        "lat",
        "lon",
    )


def complete_over_orders(orders: DataFrame, predictions: DataFrame) -> DataFrame:
    """All orders, those without a decision with an empty prediction."""
    return orders.select("_id_oid").join(predictions, "_id_oid", "left").select(*PREDICTION_COLUMNS)
