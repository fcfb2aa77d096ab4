"""Sequence features of traces.

All functions take the trace of many orders (points with the attributes of
their order) and need one shuffle of it by route and time slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from courierlens.functions.geo import distance_bin, metres_between, whole_metres
from courierlens.functions.rules import dwell_seconds, seconds_between
from courierlens.operators.slices import SLICE, before, in_slice, link, next_in_key, position, running, with_slice
from courierlens.params import EventParams
from courierlens.sources.points import TRACE_ORDER, spread_trace

# Coordinate columns of the places a distance is taken to.
PLACES = {
    "client": ("delivery_address_location__coordinates_lon", "delivery_address_location__coordinates_lat"),
    "merchant_client": ("deliveryaddress_location__coordinates_lon", "deliveryaddress_location__coordinates_lat"),
    "merchant": ("restaurantloc_lon", "restaurantloc_lat"),
    "warehouse": ("warehouse_location__coordinates_lon", "warehouse_location__coordinates_lat"),
}
# Columns of the reach features.
REACH_COLUMNS = [
    "_id_oid",
    "delivery_route_oid",
    "courier_courier_oid",
    "reach_date",
    "time",
    "distance_bin",
    "time_passed_in_bin",
    "tbe",
    "lat",
    "lon",
    "time_zone",
]
KEY = ["route_id"]
#: Column of a trace that is null at points with no row of their own; a route of only such points has no rows.
COMPLETE = "complete"


def metres_to(place: str) -> Column:
    lon, lat = PLACES[place]
    return metres_between(F.col("lon"), F.col("lat"), F.col(lon), F.col(lat))


def with_distance(trace: DataFrame, place: str, rounded: bool, out: str = "distance") -> DataFrame:
    metres = metres_to(place)
    return trace.withColumn(out, whole_metres(metres) if rounded else metres)


def _dwell_across_slices(slices: DataFrame, window: WindowSpec) -> DataFrame:
    """What the slices of a route hand on to each other for ``reach_features``.

    A stay that is still going on at the end of a slice continues in the next
    one if that starts in the same bin.
    """
    whole = Window.partitionBy(*KEY)
    last_before = F.lag("_last").over(window)
    linked = (
        slices.withColumn("_before", last_before)
        .withColumn("_after", F.lead("_first").over(window))
        .withColumn("_goes_on", F.col("_before").isNotNull() & F.col("_before.bin").eqNullSafe(F.col("_first.bin")))
        .withColumn("_gap", dwell_seconds(F.col("_last.time"), F.col("_after.time")))
        .withColumn("_new_runs", F.col("_runs") + F.when(F.col("_goes_on"), 0).otherwise(1))
        .withColumn("_stay", F.sum(F.when(F.col("_new_runs") > 0, 1).otherwise(0)).over(running(window)))
    )
    stay = Window.partitionBy(*KEY, "_stay").orderBy(SLICE)
    return (
        linked.withColumn("_stayed", F.sum(F.col("_last.in_run") + F.col("_gap")).over(running(stay)))
        .withColumn("head_seconds", F.when(F.col("_goes_on"), F.lag("_stayed").over(window)).otherwise(F.lit(0)))
        .withColumn("head_runs", F.coalesce(F.sum("_new_runs").over(before(window)), F.lit(0)))
        .select(
            *slices.columns,
            "head_seconds",
            "head_runs",
            F.col("_goes_on").alias("head_goes_on"),
            F.col("_before.bin").alias("head_bin"),
            F.col("_after.time").alias("tail_time"),
            F.col("_gap").alias("tail_seconds"),
            F.sum("_points").over(whole).alias("route_points"),
            F.min("_start").over(whole).alias("first_location_time"),
            F.max("_end").over(whole).alias("last_location_time"),
        )
    )


def _own(trace: DataFrame) -> list[str]:
    """The columns of a trace without the slice it may have been spread by."""
    return [c for c in trace.columns if c != SLICE]


def reach_features(
    trace: DataFrame, place: str, p: EventParams = EventParams(), include_all: bool = False
) -> DataFrame:
    """Distance bin of every point and the seconds spent in it so far, per unbroken stay.

    Routes with fewer than ``p.min_points`` timed points are left out.
    """
    rows = in_slice(KEY, TRACE_ORDER)
    placed = with_distance(spread_trace(trace, p), place, rounded=True)
    local = (
        placed.withColumn("distance_bin", distance_bin(F.col("distance"), p.bin_base, p.bin_steps))
        .withColumns(
            {
                "_place": F.row_number().over(rows),
                "_prev_bin": F.lag("distance_bin").over(rows),
                "_next_time": F.lead("time").over(rows),
            }
        )
        .withColumn(
            "_moved",
            ((F.col("_place") > 1) & ~F.col("distance_bin").eqNullSafe(F.col("_prev_bin"))).cast("int"),
        )
        .withColumn("_run", F.sum("_moved").over(running(rows)))
    )
    in_run = Window.partitionBy(*KEY, SLICE, "_run").orderBy(*[F.col(c).asc_nulls_last() for c in TRACE_ORDER])
    local = local.withColumn("_step", dwell_seconds(F.col("time"), F.col("_next_time"))).withColumn(
        "_in_run", F.sum("_step").over(running(in_run))
    )
    at = position(TRACE_ORDER)
    linked = link(
        local,
        KEY,
        [
            F.count("time").alias("_points"),
            F.min("time").alias("_start"),
            F.max("time").alias("_end"),
            F.max("_run").alias("_runs"),
            F.min_by(F.struct("time", F.col("distance_bin").alias("bin")), at).alias("_first"),
            F.max_by(F.struct("time", F.col("distance_bin").alias("bin"), F.col("_in_run").alias("in_run")), at).alias(
                "_last"
            ),
        ],
        _dwell_across_slices,
    )
    opens, closes = F.col("_place") == 1, F.col("_next_time").isNull()
    tail = F.when(closes, F.col("tail_seconds")).otherwise(F.lit(0))
    head = F.when(F.col("_run") == 0, F.col("head_seconds")).otherwise(F.lit(0))
    features = (
        linked.filter(F.col("route_points") >= p.min_points)
        .withColumns(
            {
                "next_location_time": F.when(closes, F.col("tail_time")).otherwise(F.col("_next_time")),
                "tbe": F.col("_step") + tail,
                "previous_distance_bin": F.when(opens, F.col("head_bin")).otherwise(F.col("_prev_bin")),
                "is_distance_bin_changed": F.when(opens, ~F.col("head_goes_on")).otherwise(F.col("_moved") == 1),
                "distance_bin_group": F.col("head_runs")
                + F.when(F.col("head_goes_on"), 0).otherwise(1)
                + F.col("_run"),
                "time_passed_in_bin": F.col("_in_run") + head + tail,
            }
        )
    )
    if not include_all:
        return features.select(*REACH_COLUMNS)
    added = [
        "distance",
        "distance_bin",
        "first_location_time",
        "last_location_time",
        "next_location_time",
        "tbe",
        "previous_distance_bin",
        "is_distance_bin_changed",
        "distance_bin_group",
        "time_passed_in_bin",
    ]
    return features.select(*_own(trace), *added)


def _step(earlier: Column, later: Column) -> Column:
    """Change from one point to the next: seconds, change of distance, metres moved."""
    return F.struct(
        seconds_between(earlier["time"], later["time"]).alias("seconds"),
        (later["metres"] - earlier["metres"]).alias("change"),
        metres_between(later["lon"], later["lat"], earlier["lon"], earlier["lat"]).alias("moved"),
    )


def _steps_across_slices(slices: DataFrame, window: WindowSpec) -> DataFrame:
    """The two points before a slice and the steps that cross its borders."""
    head_1 = F.lag("_last").over(window)
    linked = slices.select(
        *slices.columns,
        head_1.alias("head_1"),
        F.coalesce(F.lag("_second_last").over(window), F.lag("_last", 2).over(window)).alias("head_2"),
        F.lead("_first").over(window).alias("_after"),
        F.sum("_points").over(Window.partitionBy(*KEY)).alias("route_points"),
        F.sum("_complete").over(Window.partitionBy(*KEY)).alias("route_complete"),
    )
    return linked.withColumns(
        {
            "step_before": _step(F.col("head_2"), F.col("head_1")),
            "step_into": _step(F.col("head_1"), F.col("_first")),
            "step_out": _step(F.col("_last"), F.col("_after")),
        }
    ).drop("_after")


def movement(trace: DataFrame, place: str, name: str, p: EventParams = EventParams()) -> DataFrame:
    """Speeds towards a place and along the trace, with centred means over three points.

    The step to a point is computed once per point and its neighbours take it
    over through the window; the steps across slice borders come from the
    slice summaries. Columns are named after ``name``, the place the speed is
    measured to. The structs ``prev_point`` and ``prev_point_2`` (time, lat,
    lon, metres) stay for the decision rules.
    """
    rows = in_slice(KEY, TRACE_ORDER)
    at = position(TRACE_ORDER)
    distance = f"distance_to_{name}"
    local = (
        with_distance(spread_trace(trace, p), place, rounded=False, out=distance)
        .withColumn("_point", F.struct("time", "lat", "lon", F.col(distance).alias("metres")))
        .withColumns(
            {
                "_place": F.row_number().over(rows),
                "_back_1": F.lag("_point").over(rows),
                "_back_2": F.lag("_point", 2).over(rows),
            }
        )
        .withColumn("_step", _step(F.col("_back_1"), F.col("_point")))
        .withColumns({"_step_back": F.lag("_step").over(rows), "_step_ahead": F.lead("_step").over(rows)})
    )
    linked = link(
        local,
        KEY,
        [
            F.count("time").alias("_points"),
            F.min_by("_point", at).alias("_first"),
            F.max_by("_point", at).alias("_last"),
            F.max_by("_back_1", at).alias("_second_last"),
            F.count(COMPLETE if COMPLETE in trace.columns else F.lit(1)).alias("_complete"),
        ],
        _steps_across_slices,
    ).filter((F.col("route_points") >= p.min_points) & (F.col("route_complete") > 0))
    first, second = F.col("_place") == 1, F.col("_place") == 2

    def in_place(at_first: str, at_second: str, otherwise: str) -> Column:
        return F.when(first, F.col(at_first)).when(second, F.col(at_second)).otherwise(F.col(otherwise))

    around = linked.withColumns(
        {
            "prev_point": in_place("head_1", "_back_1", "_back_1"),
            "prev_point_2": in_place("head_2", "head_1", "_back_2"),
            "_step": in_place("step_into", "_step", "_step"),
            "_step_back": in_place("step_before", "step_into", "_step_back"),
            "_step_ahead": F.coalesce("_step_ahead", "step_out"),
        }
    )
    here, back, ahead = F.col("_step"), F.col("_step_back"), F.col("_step_ahead")

    def speed(step: Column, way: str) -> Column:
        # a step without duration has no speed
        return F.try_divide(step[way], step["seconds"])

    def smooth(way: str) -> Column:
        # null unless all three speeds are there
        return (speed(back, way) + speed(here, way) + speed(ahead, way)) / 3

    return around.select(
        *_own(trace),
        SLICE,
        here["seconds"].alias("tbe"),
        distance,
        here["change"].alias(f"dist_to_{name}_diff"),
        speed(here, "change").alias(f"speed_to_{name}"),
        F.col("prev_point.lat").alias("prev_lat"),
        F.col("prev_point.lon").alias("prev_lon"),
        here["moved"].alias("distance_to_prev_event"),
        speed(here, "moved").alias("speed_to_prev_event"),
        smooth("change").alias(f"smooth_speed_to_{name}"),
        smooth("moved").alias("smooth_speed_to_prev_event"),
        F.ln(distance).alias(f"dbw_{name}_log"),
        "prev_point",
        "prev_point_2",
    )


def depart_features(
    trace: DataFrame,
    source: str = "warehouse",
    p: EventParams = EventParams(),
    required: Sequence[str] | None = None,
) -> DataFrame:
    """Movement away from the warehouse or merchant; rows with any missing value are dropped.

    ``required`` limits that to some of the trace's columns (the features are
    always required). By default all of them count, so points of the return
    leg, whose own order id is missing, and orders with a missing attribute
    have no row here.
    """
    moved = movement(trace, source, "warehouse", p)
    needed = [c for c in moved.columns if c not in trace.columns and c not in ("prev_point", "prev_point_2")]
    needed += list(trace.columns if required is None else required)
    return moved.na.drop(subset=list(dict.fromkeys(needed))).drop("prev_point", "prev_point_2")


def client_departure_features(trace: DataFrame, p: EventParams = EventParams()) -> DataFrame:
    """Movement away from the client; no row is dropped."""
    return movement(trace, "client", "client", p)


def next_routes(trace: DataFrame, p: EventParams = EventParams()) -> DataFrame:
    """Pairs (route_id, next_route_id) of the routes that follow each other in a job.

    ``trace`` has the job, the route and the times of its points. Routes go by
    the time of their last point; routes without a job have none to follow.
    """
    ends = (
        trace.filter(F.col("delivery_job_oid").isNotNull())
        .groupBy("delivery_job_oid", "route_id")
        .agg(F.max("time").alias("time"))
    )
    sliced = with_slice(ends, "time", p.slice_seconds)
    followed = next_in_key(sliced, ["delivery_job_oid"], ["time", "route_id"], "route_id", "next_route_id")
    return followed.filter(F.col("next_route_id").isNotNull()).select("route_id", "next_route_id")


def _points_of_next(points: DataFrame, pairs: DataFrame) -> DataFrame:
    return points.withColumnRenamed("route_id", "next_route_id").join(pairs, "next_route_id").drop("next_route_id")


def with_next_route(points: DataFrame, orders: DataFrame, p: EventParams = EventParams()) -> DataFrame:
    """Points, and for each route of a job the points of the route that follows it there.

    Times are brought down to one per route before they meet the orders.
    """
    last = points.groupBy("route_id").agg(F.max("time").alias("time"))
    jobs = orders.select("_id_oid", "delivery_job_oid").distinct()
    pairs = next_routes(last.join(jobs, last["route_id"] == jobs["_id_oid"]), p)
    return points.unionByName(_points_of_next(points, pairs))


def append_next_route(trace: DataFrame, points: DataFrame, orders: DataFrame, p: EventParams = EventParams()) -> DataFrame:
    """Lengthen each route of a job by the points of the route that follows it in the job.

    The added points carry the attributes of the order they are added to.
    """
    moved = _points_of_next(points, next_routes(trace, p))
    once = orders.distinct()
    tail = moved.join(once, moved["route_id"] == once["_id_oid"], "inner")
    return trace.unionByName(tail, allowMissingColumns=True)
