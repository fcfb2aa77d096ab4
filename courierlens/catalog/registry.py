"""Every operator as a query over the driver tables, with its SQL counterpart."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.catalog import oracles as sql
from courierlens.catalog.fixtures import END, START, Fixtures, fixtures
from courierlens.contracts import DEDUPLICATED_TABLES, EVENT_SHAPES, PREDICTION_TABLES, table_of
from courierlens.functions.geo import distance_bin
from courierlens.functions.rules import decide, to_local
from courierlens.operators import events as ev
from courierlens.operators import features as ft
from courierlens.operators import rfm, tables, trace, windows
from courierlens.params import DEPART_INTERCEPT, DEPART_WEIGHTS, REACH_INTERCEPT, REACH_WEIGHTS, RfmParams
from courierlens.plans import pipelines as pl
from courierlens.plans import run
from courierlens.session import shared_dir
from courierlens.sources import orders as so
from courierlens.sources import points as sp
from courierlens.sources import samples
from courierlens.sources.store import PredictionStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PART_START, PART_END = "2024-01-01 00:10:00", "2024-01-01 01:05:00"
CHECK_DATE = "2001-08-01"
RP = RfmParams(check_date=CHECK_DATE)


def query(name: str, oracle: str | None) -> Callable[[Callable[[Fixtures], DataFrame]], Query]:
    def register(build: Callable[[Fixtures], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(fixtures(spark, sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def us(column: str, name: str | None = None) -> Column:
    return F.unix_micros(F.col(column)).alias(name or column.replace("time_l", "local").replace("time", "time") + "_us")


def e4(column: str) -> Column:
    return F.floor(F.col(column) * 10000 + 0.5).cast("long").alias(f"{column}_e4")


def predictions(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        *extra, F.col("_id_oid").alias("order_id"), us("time", "time_us"), us("time_l", "local_us"), "lat", "lon"
    )


def every_point(fx: Fixtures) -> DataFrame:
    """Market points with their order; all orders are wanted, so no semi join."""
    return sp.route_points(fx.points, None, 1, START, END, indexed=False)


def whole_trace(fx: Fixtures, attributes: list[str] | None = None) -> DataFrame:
    orders = fx.orders.select("_id_oid", *attributes) if attributes else fx.orders
    points = every_point(fx)
    return points.join(orders, points["route_id"] == orders["_id_oid"])


# --- sources -----------------------------------------------------------------------------------

ORDER_OUT = """id as order_id, route, courier, checkout_us, deliver_us, reach_us, onway_us, handover_us, tz as zone"""


@query(
    "orders_market",
    sql.build(
        sql.RAW_ORDERS + sql.MARKET_ORDERS.format(**sql.PART),
        f"select {ORDER_OUT}, job, cast(batch as int) as batch, max_deliver_us from mords",
    ),
)
def orders_market(fx: Fixtures) -> DataFrame:
    found = so.market_orders(fx.raw_orders, fx.zones, PART_START, PART_END)
    return found.select(
        *_order_columns(),
        us("onway_date", "onway_us"),
        us("handover_date", "handover_us"),
        F.col("time_zone").alias("zone"),
        F.col("delivery_job_oid").alias("job"),
        F.col("delivery_batch_index").alias("batch"),
        us("max_deliver_date", "max_deliver_us"),
    )


def _order_columns() -> list[Column]:
    return [
        F.col("_id_oid").alias("order_id"),
        F.col("delivery_route_oid").alias("route"),
        F.col("courier_courier_oid").alias("courier"),
        us("checkoutdatel", "checkout_us"),
        us("deliver_date", "deliver_us"),
        us("reach_date", "reach_us"),
    ]


MERCHANT_OUT = """f.id as order_id, route, f.courier, checkout_us, deliver_us, reach_us, handover_us, m_lat, m_lon, m_us,
 c_lat, c_lon, c_us, {domain} as domain_type, tz as zone, wh_lat, wh_lon, line as courier_domain"""


def _merchant_oracle(domain: int) -> str:
    return sql.build(
        sql.POINTS + sql.RAW_ORDERS + sql.PREDICTIONS + sql.MERCHANT + sql.FOOD_ORDERS.format(**sql.PART),
        f"select {MERCHANT_OUT.format(domain=domain)} from fords f left join cdom on cdom.courier = f.courier",
    )


def _merchant_query(fx: Fixtures, domain: int) -> DataFrame:
    found = so.merchant_orders(
        fx.food_orders,
        fx.status_log,
        fx.predictions,
        fx.couriers,
        fx.warehouses,
        PART_START,
        PART_END,
        domain,
        courier_domains=fx.courier_domains,
    )
    logged = [("reached_to_restaurant", "m"), ("reached_to_client", "c")]
    return found.select(
        *_order_columns(),
        us("handoverdate", "handover_us"),
        *[F.col(f"{long}_{c}").alias(f"{short}_{c}") for long, short in logged for c in ("lat", "lon")],
        *[us(f"{long}_createdatl", f"{short}_us") for long, short in logged],
        F.col("domaintype").alias("domain_type"),
        F.col("time_zone").alias("zone"),
        F.col("warehouse_location__coordinates_lat").alias("wh_lat"),
        F.col("warehouse_location__coordinates_lon").alias("wh_lon"),
        F.col("domaintypes").alias("courier_domain"),
    )


@query("orders_food", _merchant_oracle(2))
def orders_food(fx: Fixtures) -> DataFrame:
    return _merchant_query(fx, 2)


@query("orders_artisan", _merchant_oracle(6))
def orders_artisan(fx: Fixtures) -> DataFrame:
    return _merchant_query(fx, 6)


@query(
    "orders_water",
    sql.build(
        sql.RAW_ORDERS + sql.PREDICTIONS + sql.WATER_ORDERS.format(**sql.PART), f"select {ORDER_OUT} from words"
    ),
)
def orders_water(fx: Fixtures) -> DataFrame:
    found = so.water_orders(
        fx.raw_orders, fx.zones, fx.predictions, "predicted_reach_date", PART_START, PART_END
    )
    return found.select(
        *_order_columns(),
        us("onway_date", "onway_us"),
        us("handover_date", "handover_us"),
        F.col("time_zone").alias("zone"),
    )


@query(
    "route_points",
    sql.build(
        sql.BASE,
        """select route_id, row_number() over (partition by route_id order by t, lat, lon) as index, t as time_us, lat, lon,
           acc, status, raw_id, courier from trc where route_id in (select id from ords)""",
    ),
)
def route_points(fx: Fixtures) -> DataFrame:
    return sp.route_points(fx.points, fx.orders, 1, START, END).select(
        "route_id",
        "index",
        us("time", "time_us"),
        "lat",
        "lon",
        "acc",
        "status",
        F.col("raw_order_id").alias("raw_id"),
        F.col("courier_oid").alias("courier"),
    )


@query(
    "courier_trajectory",
    sql.build(
        sql.POINTS
        + """usr as (select distinct user_id from events),
             listed as (select cast(user_id as varchar) as courier from usr where 1 + user_id % 3 in (1, 3)),""",
        """select acc, t as time_us, lat, lon, route_id as order_id from trc
           where status = 900 and route_id is not null and courier in (select courier from listed)""",
    ),
)
def courier_trajectory(fx: Fixtures) -> DataFrame:
    listed = fx.courier_domains.filter("domaintypes in (1, 3)").select("_p_id_oid")
    found = sp.courier_trajectory(fx.points, listed, START, END)
    return found.select("acc", us("time", "time_us"), "lat", "lon", F.col("_id_oid").alias("order_id"))


@query(
    "sample_orders",
    sql.build(
        sql.RAW_ORDERS,
        f"""select id as order_id, route, courier, checkout_us, deliver_us, reach_us from raws
            where status in (900, 1000) and domaintype = 1
            and checkout_us between {sql.PART['start']} and {sql.PART['end']}
            order by md5(id || ':7'), id limit 200""",
    ),
)
def sample_orders(fx: Fixtures) -> DataFrame:
    return samples.sample_orders(fx.raw_orders, PART_START, PART_END, 200, seed=7).select(*_order_columns())


@query(
    "routes_for_orders",
    sql.build(
        sql.POINTS + sql.RAW_ORDERS,
        """select r.route as route_id, p.t as time_us, p.lat, p.lon from pts p join raws r on p.seg = r.eid
           where r.route in (select route from raws where status in (900, 1000))""",
    ),
)
def routes_for_orders(fx: Fixtures) -> DataFrame:
    finished = fx.raw_orders.filter("status in (900, 1000)")
    return samples.routes_for_orders(fx.recorded_routes, finished).select(
        "route_id", us("time", "time_us"), "lat", "lon"
    )


@query(
    "flatten_route_docs",
    sql.build(
        sql.POINTS,
        """select raw_id as route_id, cast(row_number() over (partition by raw_id order by t, lat, lon) - 1 as int) as index,
           lon, lat, t as time_us, acc from pts where raw_id is not null""",
    ),
)
def flatten_route_docs(fx: Fixtures) -> DataFrame:
    return sp.flatten_route_docs(fx.route_docs).select("route_id", "index", "lon", "lat", us("time", "time_us"), "acc")


# --- trace preparation -------------------------------------------------------------------------


@query(
    "filter_by_ids",
    sql.build(
        sql.RAW_ORDERS + sql.PREDICTIONS,
        "select id as order_id, courier from raws where id in (select order_id from made)",
    ),
)
def filter_by_ids(fx: Fixtures) -> DataFrame:
    everything = trace.filter_by_ids(fx.raw_orders, "courier_courier_oid", [])
    listed = trace.filter_by_ids(everything, "_id_oid", fx.predictions.select("order_id"))
    return listed.select(F.col("_id_oid").alias("order_id"), F.col("courier_courier_oid").alias("courier"))


@query(
    "orders_with_points",
    sql.build(
        sql.BASE,
        """select o.id as order_id, o.route, o.job, tr.t as time_us, tr.lat, tr.lon, tr.raw_id, tr.status
           from trc tr join (select distinct * from ords) o on tr.route_id = o.id""",
    ),
)
def orders_with_points(fx: Fixtures) -> DataFrame:
    return trace.join_trace(every_point(fx), fx.orders).select(
        F.col("_id_oid").alias("order_id"),
        F.col("delivery_route_oid").alias("route"),
        F.col("delivery_job_oid").alias("job"),
        us("time", "time_us"),
        "lat",
        "lon",
        F.col("raw_order_id").alias("raw_id"),
        "status",
    )


@query(
    "min_points_filter",
    sql.build(
        sql.BASE,
        """select id as order_id, t as time_us, lat, lon from
           (select o.id, tr.t, tr.lat, tr.lon, count(tr.t) over (partition by o.id) as n
            from trc tr join ords o on tr.route_id = o.id) where n >= 3""",
    ),
)
def min_points_filter(fx: Fixtures) -> DataFrame:
    return trace.min_points(whole_trace(fx)).select(
        F.col("_id_oid").alias("order_id"), us("time", "time_us"), "lat", "lon"
    )


@query(
    "status_log_pivot",
    sql.build(sql.POINTS + sql.MERCHANT, "select order_id, m_lat, m_lon, m_us, c_lat, c_lon, c_us from piv"),
)
def status_log_pivot(fx: Fixtures) -> DataFrame:
    logged = [("reached_to_restaurant", "m"), ("reached_to_client", "c")]
    return trace.pivot_status_log(fx.status_log).select(
        F.col("status_order_id").alias("order_id"),
        *[F.col(f"{long}_{c}").alias(f"{short}_{c}") for long, short in logged for c in ("lat", "lon")],
        *[us(f"{long}_createdatl", f"{short}_us") for long, short in logged],
    )


@query(
    "only_unpredicted",
    sql.build(
        sql.RAW_ORDERS + sql.PREDICTIONS,
        """select r.id as order_id, r.courier from raws r left join made on made.order_id = r.id
           where made.order_id is null or made.date_us is null""",
    ),
)
def only_unpredicted(fx: Fixtures) -> DataFrame:
    found = trace.only_unpredicted(fx.raw_orders, fx.predictions, "predicted_reach_date")
    return found.select(F.col("_id_oid").alias("order_id"), F.col("courier_courier_oid").alias("courier"))


@query(
    "courier_domain_filter",
    sql.build(
        sql.POINTS + sql.RAW_ORDERS + sql.MERCHANT,
        "select id as order_id, courier from raws where courier in (select courier from cdom where line in (1, 3))",
    ),
)
def courier_domain_filter(fx: Fixtures) -> DataFrame:
    found = trace.with_courier_domain(fx.raw_orders, fx.courier_domains)
    return found.select(F.col("_id_oid").alias("order_id"), F.col("courier_courier_oid").alias("courier"))


@query(
    "iqr_outliers",
    """with q as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events)
       select event_id, value from events, q where value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)""",
)
def iqr_outliers(fx: Fixtures) -> DataFrame:
    return trace.iqr_outliers(fx.read("events").select("event_id", "value"), "value")


# --- column computations -----------------------------------------------------------------------

JOINED = sql.BASE + "j as (select tr.t, tr.lat, tr.lon, o.* from trc tr join ords o on tr.route_id = o.id),\n"


@query(
    "trace_distance",
    sql.build(
        JOINED,
        f"""select id as order_id, t as time_us,
            cast(round_even({sql.metres('lon', 'lat', 'cl_lon', 'cl_lat')}, 0) as bigint) as client_metres,
            {sql.e4(sql.metres('lon', 'lat', 'wh_lon', 'wh_lat'))} as warehouse_e4 from j""",
    ),
)
def trace_distance(fx: Fixtures) -> DataFrame:
    placed = ft.with_distance(whole_trace(fx), "client", rounded=True, out="client_metres")
    return ft.with_distance(placed, "warehouse", rounded=False, out="warehouse").select(
        F.col("_id_oid").alias("order_id"), us("time", "time_us"), "client_metres", e4("warehouse")
    )


@query(
    "trace_distance_bin",
    sql.build(
        JOINED
        + f"""d as (select *, round_even({sql.metres('lon', 'lat', 'cl_lon', 'cl_lat')}, 0) as c,
              round_even({sql.metres('lon', 'lat', 'wh_lon', 'wh_lat')}, 0) as w from j),""",
        f"""select id as order_id, t as time_us, cast({sql.bin_of('c')} as int) as client_bin,
            cast({sql.bin_of('w')} as int) as warehouse_bin from d""",
    ),
)
def trace_distance_bin(fx: Fixtures) -> DataFrame:
    placed = ft.with_distance(whole_trace(fx), "client", rounded=True, out="c")
    placed = ft.with_distance(placed, "warehouse", rounded=True, out="w")
    return placed.select(
        F.col("_id_oid").alias("order_id"),
        us("time", "time_us"),
        distance_bin(F.col("c")).alias("client_bin"),
        distance_bin(F.col("w")).alias("warehouse_bin"),
    )


@query(
    "logistic_decision",
    """select l_orderkey, l_linenumber,
       coalesce(-0.414 + (l_linenumber - 1) * -0.815 + ln(l_quantity + 1) * 0.407 >= 0, false) as reached,
       coalesce(-5.234 + l_discount * 10 * 0.557 + l_tax * 10 * 0.047 + ln(nullif(l_quantity - 1, 0)) * 1.165 >= 0, false)
       as left_place from lineitem""",
)
def logistic_decision(fx: Fixtures) -> DataFrame:
    amount = F.col("l_quantity")
    reached = [F.col("l_linenumber") - 1, F.ln(amount + 1)]
    left = [F.col("l_discount") * 10, F.col("l_tax") * 10, F.ln(amount - 1)]
    return fx.read("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        decide(reached, REACH_WEIGHTS, REACH_INTERCEPT).alias("reached"),
        decide(left, DEPART_WEIGHTS, DEPART_INTERCEPT).alias("left_place"),
    )


@query(
    "utc_to_local",
    sql.build(JOINED, f"select id as order_id, t as time_us, {sql.local('t')} as local_us from j"),
)
def utc_to_local(fx: Fixtures) -> DataFrame:
    local = whole_trace(fx).withColumn("time_l", to_local(F.col("time"), F.col("time_zone")))
    return local.select(F.col("_id_oid").alias("order_id"), us("time", "time_us"), us("time_l", "local_us"))


# --- sequence features -------------------------------------------------------------------------


@query(
    "reach_features",
    sql.build(
        sql.BASE + sql.reach_features("r", "ords", "cl"),
        """select id as order_id, route, courier, reach_us, t as time_us, cast(distance as bigint) as distance,
           cast(bin as int) as distance_bin, cast(in_bin as bigint) as time_passed_in_bin, tbe, lat, lon, tz as zone,
           first_t as first_us, last_t as last_us, next_t as next_us, cast(prev_bin as int) as previous_bin,
           changed = 1 as is_changed, cast(run as bigint) as bin_group from rf""",
    ),
)
def reach_features(fx: Fixtures) -> DataFrame:
    return ft.reach_features(whole_trace(fx), "client", include_all=True).select(
        F.col("_id_oid").alias("order_id"),
        F.col("delivery_route_oid").alias("route"),
        F.col("courier_courier_oid").alias("courier"),
        us("reach_date", "reach_us"),
        us("time", "time_us"),
        "distance",
        "distance_bin",
        "time_passed_in_bin",
        "tbe",
        "lat",
        "lon",
        F.col("time_zone").alias("zone"),
        us("first_location_time", "first_us"),
        us("last_location_time", "last_us"),
        us("next_location_time", "next_us"),
        F.col("previous_distance_bin").alias("previous_bin"),
        F.col("is_distance_bin_changed").alias("is_changed"),
        F.col("distance_bin_group").cast("long").alias("bin_group"),
    )


def _movement_out(name: str) -> list[str]:
    return [
        "tbe",
        f"distance_to_{name}",
        f"dist_to_{name}_diff",
        f"speed_to_{name}",
        "distance_to_prev_event",
        "speed_to_prev_event",
        f"smooth_speed_to_{name}",
        "smooth_speed_to_prev_event",
        f"dbw_{name}_log",
    ]


def _movement_sql(name: str) -> str:
    names = ["sec", "dist", "change", "v_to", "moved", "v_along", "s_to", "s_along", "log_dist"]
    return ", ".join(f"{sql.e4(s)} as {n}_e4" for s, n in zip(names, _movement_out(name), strict=True))


@query(
    "depart_features",
    sql.build(
        sql.BASE + sql.depart_features("d", "ords", "wh", sql.COMPLETE),
        f"select id as order_id, t as time_us, prev_lat, prev_lon, {_movement_sql('warehouse')} from dp",
    ),
)
def depart_features(fx: Fixtures) -> DataFrame:
    return ft.depart_features(whole_trace(fx), "warehouse").select(
        F.col("_id_oid").alias("order_id"),
        us("time", "time_us"),
        "prev_lat",
        "prev_lon",
        *[e4(c) for c in _movement_out("warehouse")],
    )


@query(
    "depart_from_client_features",
    sql.build(
        sql.BASE
        + "ca as (select tr.t, tr.lat, tr.lon, o.* from trc tr join ords o on tr.route_id = o.id),"
        + sql.movement("c", "ca", "cl"),
        f"select id as order_id, t as time_us, prev_lat, prev_lon, {_movement_sql('client')} from cm",
    ),
)
def depart_from_client_features(fx: Fixtures) -> DataFrame:
    return ft.client_departure_features(whole_trace(fx)).select(
        F.col("_id_oid").alias("order_id"),
        us("time", "time_us"),
        "prev_lat",
        "prev_lon",
        *[e4(c) for c in _movement_out("client")],
    )


@query(
    "next_route_tail",
    sql.build(
        sql.BASE + sql.tail("n", "ords"),
        "select id as order_id, job, t as time_us, lat, lon, raw_id from na",
    ),
)
def next_route_tail(fx: Fixtures) -> DataFrame:
    return ft.append_next_route(whole_trace(fx), every_point(fx), fx.orders).select(
        F.col("_id_oid").alias("order_id"),
        F.col("delivery_job_oid").alias("job"),
        us("time", "time_us"),
        "lat",
        "lon",
        F.col("raw_order_id").alias("raw_id"),
    )


# --- decisions ---------------------------------------------------------------------------------

FOUND = "select id as order_id, t as time_us, t_l as local_us, lat, lon from "
CLIENT_PLACE = list(ft.PLACES["client"])


@query("predict_reach", sql.build(sql.BASE + sql.reach("r", "ords", "cl"), FOUND + "rr"))
def predict_reach(fx: Fixtures) -> DataFrame:
    features = ft.reach_features(whole_trace(fx, ["time_zone", *CLIENT_PLACE]), "client", include_all=True)
    return predictions(ev.first_reach(features))


@query("predict_depart", sql.build(sql.BASE + sql.depart("d", "ords", "wh", sql.COMPLETE, True), FOUND + "dq"))
def predict_depart(fx: Fixtures) -> DataFrame:
    return predictions(ev.first_depart(ft.depart_features(whole_trace(fx), "warehouse")))


JOB_FOUND = "jq as (select order_id as id, date_us as t, date_us + 10800000000 as t_l, latitude as lat, longitude as lon from jp where date_us is not null),\n"


def _job_predictions(fx: Fixtures) -> DataFrame:
    return fx.job_predictions.filter("predicted_depart_date is not null").select(
        F.col("order_id").alias("_id_oid"),
        F.col("predicted_depart_date").alias("time"),
        F.col("predicted_depart_dateL").alias("time_l"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
    )


@query(
    "propagate_first_batch",
    sql.build(sql.ORDERS + sql.JOB_PREDICTIONS + JOB_FOUND + sql.first_batch("b", "ords", "jq"), FOUND + "bu"),
)
def propagate_first_batch(fx: Fixtures) -> DataFrame:
    return predictions(ev.propagate_first_batch(_job_predictions(fx), fx.orders))


@query(
    "predict_depart_from_client",
    sql.build(sql.BASE + sql.client_departure("c", "ords", False), FOUND + "cl"),
)
def predict_depart_from_client(fx: Fixtures) -> DataFrame:
    attributes = ["time_zone", "reach_date", "deliver_date", *CLIENT_PLACE]
    return predictions(ev.first_client_departure(ft.client_departure_features(whole_trace(fx, attributes))))


@query(
    "predict_delivery",
    sql.build(
        sql.BASE
        + sql.reach("r", "ords", "cl")
        + sql.client_departure("c", "ords", False)
        + sql.delivery("v", "rr", "cl"),
        FOUND + "vv",
    ),
)
def predict_delivery(fx: Fixtures) -> DataFrame:
    attributes = ["time_zone", "reach_date", "deliver_date", *CLIENT_PLACE]
    rows = whole_trace(fx, attributes)
    reached = ev.one_per_order(ev.first_reach(ft.reach_features(rows, "client", include_all=True)))
    left = ev.first_client_departure(ft.client_departure_features(rows))
    return predictions(ev.delivery_midpoint(reached, left))


@query(
    "complete_over_orders",
    sql.build(sql.ORDERS + sql.JOB_PREDICTIONS + JOB_FOUND, sql.completed("ords", "jq")),
)
def complete_over_orders(fx: Fixtures) -> DataFrame:
    return predictions(ev.complete_over_orders(fx.orders, _job_predictions(fx)))


# --- pipelines ---------------------------------------------------------------------------------


def stored_points(fx: Fixtures, domain: int = 1) -> DataFrame:
    """Points with their order, written once, as pipelines read them several times."""
    return pl.stage(sp.route_points(fx.points, None, domain, START, END, indexed=False), f"points-{domain}")


@query("pipeline_reach", sql.build(sql.BASE + sql.reach("r", "ords", "cl"), sql.completed("ords", "rr")))
def pipeline_reach(fx: Fixtures) -> DataFrame:
    return predictions(pl.reach(fx.orders, stored_points(fx), 1))


FOOD_BASE = sql.POINTS + sql.RAW_ORDERS + sql.PREDICTIONS + sql.MERCHANT + sql.FOOD_ORDERS.format(**sql.WHOLE).replace("(select r.eid", "(select distinct r.eid")
OWN = "fown as (select * from fords where courier in (select courier from cdom where line in (1, 3))),\n"


def _food(fx: Fixtures, domain: int = 2) -> DataFrame:
    return pl.orders_of(fx.inputs(), domain, START, END)




@query(
    "pipeline_reach_to_merchant",
    sql.build(FOOD_BASE + sql.reach("r", "fords", "me"), sql.completed("fords", "rr")),
)
def pipeline_reach_to_merchant(fx: Fixtures) -> DataFrame:
    return predictions(pl.reach_to_merchant(_food(fx), stored_points(fx, 2), 2))


@query(
    "pipeline_depart",
    sql.build(
        sql.BASE + sql.depart("d", "ords", "wh", sql.COMPLETE, True) + sql.first_batch("b", "ords", "dq"),
        sql.completed("ords", "bu"),
    ),
)
def pipeline_depart(fx: Fixtures) -> DataFrame:
    return predictions(pl.depart(fx.orders, stored_points(fx), 1))


@query(
    "pipeline_depart_from_courier_warehouse",
    sql.build(
        FOOD_BASE + OWN + sql.depart("d", "fown", "wh", sql.COMPLETE_FOOD, False), sql.completed("fown", "dq")
    ),
)
def pipeline_depart_from_courier_warehouse(fx: Fixtures) -> DataFrame:
    made = pl.event_predictions("depart_from_courier_warehouse", _food(fx), stored_points(fx, 2), 2, fx.courier_domains)
    return predictions(made)


@query(
    "pipeline_depart_from_merchant",
    sql.build(
        FOOD_BASE + OWN + sql.depart("d", "fown", "me", sql.COMPLETE_FOOD, False), sql.completed("fown", "dq")
    ),
)
def pipeline_depart_from_merchant(fx: Fixtures) -> DataFrame:
    return predictions(pl.event_predictions("depart_from_merchant", _food(fx), stored_points(fx, 2), 2, fx.courier_domains))


@query(
    "pipeline_depart_from_client",
    sql.build(sql.BASE + sql.client_departure("c", "ords", True), sql.completed("ords", "cl")),
)
def pipeline_depart_from_client(fx: Fixtures) -> DataFrame:
    return predictions(pl.depart_from_client(fx.orders, stored_points(fx), 1))


@query(
    "pipeline_deliver",
    sql.build(
        sql.BASE
        + sql.reach("r", "ords", "cl")
        + sql.client_departure("c", "ords", True)
        + sql.delivery("v", "rr", "cl"),
        FOUND + "vv",
    ),
)
def pipeline_deliver(fx: Fixtures) -> DataFrame:
    return predictions(pl.deliver(fx.orders, stored_points(fx), 1))


ALL_BASE = (
    FOOD_BASE + OWN + sql.MARKET_ORDERS.format(**sql.WHOLE) + sql.WATER_ORDERS.format(**sql.WHOLE).replace("(select r.*", "(select distinct r.*")
)
ALL_CTES = (
    ALL_BASE
    + sql.reach("m", "mords", "cl")
    + sql.depart("md", "mords", "wh", sql.COMPLETE, True)
    + sql.first_batch("mb", "mords", "mdq")
    + sql.client_departure("mc", "mords", True)
    + sql.delivery("mv", "mr", "mcl")
    + sql.reach("w", "words", "cl")
    + sql.depart("wd", "words", "wh", "tz is not null", True)
    + sql.client_departure("wc", "words", False)
    + sql.delivery("wv", "wr", "wcl")
    + sql.reach("f", "fords", "me")
    + sql.depart("fm", "fown", "me", sql.COMPLETE_FOOD, False)
    + sql.depart("fw", "fown", "wh", sql.COMPLETE_FOOD, False)
)
ALL_PARTS = [
    (1, "reach", sql.completed("mords", "mr")),
    (1, "depart", sql.completed("mords", "mbu")),
    (1, "depart_from_client", sql.completed("mords", "mcl")),
    (1, "deliver", FOUND + "mvv"),
    (4, "reach", sql.completed("words", "wr")),
    (4, "depart", sql.completed("words", "wdq")),
    (4, "depart_from_client", sql.completed("words", "wcl")),
    (4, "deliver", FOUND + "wvv"),
    *[(d, "reach_to_merchant", sql.completed("fords", "fr")) for d in (2, 6)],
    *[(d, "depart_from_merchant", sql.completed("fown", "fmq")) for d in (2, 6)],
    *[(d, "depart_from_courier_warehouse", sql.completed("fown", "fwq")) for d in (2, 6)],
]
ALL_UNION = " union all ".join(
    f"select cast({d} as int) as domain_type, '{event}' as event, * from ({part})" for d, event, part in ALL_PARTS
)


@query("pipeline_all", sql.build(ALL_CTES, ALL_UNION))
def pipeline_all(fx: Fixtures) -> DataFrame:
    return predictions(pl.all_events(fx.inputs(), START, END), "domain_type", "event")


@query(
    "pipeline_reach_client_merchant_domains",
    sql.build(FOOD_BASE + sql.reach("r", "fords", "cl"), sql.completed("fords", "rr")),
)
def pipeline_reach_client_merchant_domains(fx: Fixtures) -> DataFrame:
    return predictions(pl.reach(_food(fx, 6), stored_points(fx, 2), 6))


# --- tables ------------------------------------------------------------------------------------

STAGED_OUT = """select o.id as order_id, f.t as predicted_depart_us, f.t_l as predicted_depart_local_us,
 f.lat as latitude, f.lon as longitude from ords o left join jq f on f.id = o.id"""


def _staged_out(df: DataFrame) -> DataFrame:
    return df.select(
        "order_id",
        us("predicted_depart_date", "predicted_depart_us"),
        us("predicted_depart_dateL", "predicted_depart_local_us"),
        "latitude",
        "longitude",
    )


def _written(fx: Fixtures) -> str:
    path = f"{shared_dir(fx.spark)}/written-{uuid.uuid4().hex}"
    tables.write_predictions(ev.complete_over_orders(fx.orders, _job_predictions(fx)), "depart", path)
    return path


@query("write_predictions", sql.build(sql.ORDERS + sql.JOB_PREDICTIONS + JOB_FOUND, STAGED_OUT))
def write_predictions(fx: Fixtures) -> DataFrame:
    return _staged_out(tables.load_staged(fx.spark, _written(fx), "depart"))


@query(
    "load_staged",
    sql.build(
        sql.ORDERS + sql.JOB_PREDICTIONS + JOB_FOUND,
        f"""select 'new' as part, * from ({STAGED_OUT}) union all
            select 'old' as part, order_id, date_us, date_us + 10800000000, latitude, longitude from jp""",
    ),
)
def load_staged(fx: Fixtures) -> DataFrame:
    existing = tables.conform_to_contract(fx.job_predictions, "depart")
    highest = existing.agg(F.max("prediction_id")).first()[0]
    table = tables.load_staged(fx.spark, _written(fx), "depart", existing)
    part = F.when(F.col("prediction_id") <= highest, "old").otherwise("new").alias("part")
    rows = table.select(part, *table.columns)
    return rows.select(
        "part",
        "order_id",
        us("predicted_depart_date", "predicted_depart_us"),
        us("predicted_depart_dateL", "predicted_depart_local_us"),
        "latitude",
        "longitude",
    )


@query(
    "conform_to_contract",
    sql.build(
        sql.PREDICTIONS,
        """select prediction_id, order_id, date_us as reach_us, date_us + 10800000000 as reach_local_us,
           latitude, cast(null as double) as longitude, at_us from made""",
    ),
)
def conform_to_contract(fx: Fixtures) -> DataFrame:
    loose = fx.predictions.withColumn("prediction_id", F.col("prediction_id").cast("string")).drop("longitude")
    return tables.conform_to_contract(loose, "reach").select(
        "prediction_id",
        "order_id",
        us("predicted_reach_date", "reach_us"),
        us("predicted_reach_dateL", "reach_local_us"),
        "latitude",
        "longitude",
        us("predictedat", "at_us"),
    )


MADE_OUT = "prediction_id, order_id, date_us as reach_us, latitude, longitude"


def _made_out(df: DataFrame) -> DataFrame:
    return df.select("prediction_id", "order_id", us("predicted_reach_date", "reach_us"), "latitude", "longitude")


@query(
    "remove_duplicates",
    sql.build(
        sql.PREDICTIONS
        + "r as (select *, row_number() over (partition by order_id order by prediction_id desc) as rn from made),",
        f"select {MADE_OUT} from r where rn = 1",
    ),
)
def remove_duplicates(fx: Fixtures) -> DataFrame:
    return _made_out(tables.keep_latest(fx.predictions, "prediction_id", ["order_id"]))


@query(
    "upsert",
    sql.build(
        sql.ANCHORS + sql.PREDICTIONS + sql.JOB_PREDICTIONS,
        f"""select {MADE_OUT} from made where order_id not in (select order_id from jp) union all
            select {MADE_OUT} from jp""",
    ),
)
def upsert(fx: Fixtures) -> DataFrame:
    fresh = fx.job_predictions.select(
        "prediction_id",
        "order_id",
        F.col("predicted_depart_date").alias("predicted_reach_date"),
        F.col("predicted_depart_dateL").alias("predicted_reach_dateL"),
        "latitude",
        "longitude",
        "predictedat",
    )
    return _made_out(tables.upsert(fx.predictions, fresh, "order_id"))


@query(
    "point_update",
    sql.build(
        sql.ANCHORS + sql.PREDICTIONS + sql.JOB_PREDICTIONS,
        """select m.prediction_id, m.order_id,
           case when u.order_id is not null then u.date_us else m.date_us end as reach_us,
           case when u.order_id is not null then u.latitude else m.latitude end as latitude,
           case when u.order_id is not null then u.longitude else m.longitude end as longitude
           from made m left join jp u on u.order_id = m.order_id""",
    ),
)
def point_update(fx: Fixtures) -> DataFrame:
    changes = fx.job_predictions.select(
        "order_id",
        F.col("predicted_depart_date").alias("predicted_reach_date"),
        F.col("predicted_depart_dateL").alias("predicted_reach_dateL"),
        "latitude",
        "longitude",
    )
    columns = ["predicted_reach_date", "predicted_reach_dateL", "latitude", "longitude"]
    return _made_out(tables.apply_updates(fx.predictions, changes, "order_id", columns))


@query(
    "depart_batches",
    sql.build(
        sql.RAW_ORDERS
        + sql.JOB_PREDICTIONS
        + f"""g as (select distinct r.id, r.job, p.date_us, p.latitude, p.longitude,
               max(p.date_us) over (partition by r.job) as job_us, max(r.batch) over (partition by r.job) as max_index
               from raws r left join jp p on p.order_id = r.id
               where r.deliver_us between {sql.PART['start']} and {sql.PART['end']} and r.status in (900, 1000)
               and r.domaintype in (1, 3)),
            f as (select * from g where max_index > 1 and job_us is not null and date_us <> job_us),""",
        """select p.prediction_id, p.order_id, coalesce(f.job_us, p.date_us) as depart_us,
           coalesce(f.job_us, p.date_us + 10800000000) as depart_local_us, coalesce(f.latitude, p.latitude) as latitude,
           coalesce(f.longitude, p.longitude) as longitude from jp p left join f on f.id = p.order_id""",
    ),
)
def depart_batches(fx: Fixtures) -> DataFrame:
    return tables.align_batches(fx.raw_orders, fx.job_predictions, PART_START, PART_END).select(
        "prediction_id",
        "order_id",
        us("predicted_depart_date", "depart_us"),
        us("predicted_depart_dateL", "depart_local_us"),
        "latitude",
        "longitude",
    )


# --- a run, from windows to corrected tables ---------------------------------------------------

MINUTE = 60_000_000
RUN_WINDOWS = [("2024-01-01 00:00:00", "2024-01-01 00:40:00"), ("2024-01-01 00:30:00", "2024-01-01 02:00:00")]
RUN_BOUNDS = [{"start": sql.EPOCH, "end": sql.EPOCH + 40 * MINUTE}, {"start": sql.EPOCH + 30 * MINUTE, "end": sql.EPOCH + 120 * MINUTE}]
TABLE_ROWS = ", ".join(f"({d}, '{e}', '{name}')" for (e, d), (name, _) in PREDICTION_TABLES.items())
DEDUPLICATED = ", ".join(f"'{name}'" for name in DEDUPLICATED_TABLES)
NO_PREDICTIONS = "(select cast(null as varchar) as order_id, cast(null as bigint) as date_us where false)"


def _window_ctes(number: int, bounds: dict[str, int], ctes: str) -> str:
    """The CTEs of ``pipeline_all`` for one window, their names numbered, with ``food_made`` and ``water_made`` before them."""
    water = sql.WATER_ORDERS.format(**bounds).replace("(select r.*", "(select distinct r.*").replace("made", "water_made")
    food = sql.FOOD_ORDERS.format(**bounds).replace("(select r.eid", "(select distinct r.eid").replace("made", "food_made")
    text = food + OWN + sql.MARKET_ORDERS.format(**bounds) + water + ctes + f"\nall_made as ({ALL_UNION}),\n"
    names = {*re.findall(r"^(\w+) as \(", text, re.MULTILINE), "food_made", "water_made"}
    return re.sub(rf"\b({'|'.join(sorted(names))})\b", rf"\1_{number}", text)


def _kept(rows: str) -> str:
    said = f"case when tbl not in ({DEDUPLICATED}) then struct_pack(a := date_us, b := local_us, c := lat, d := lon) end"
    return f"(select * from {rows} qualify row_number() over (partition by tbl, order_id, {said} order by id desc) = 1)"


def _run_sql() -> str:
    events = ALL_CTES.removeprefix(ALL_BASE)
    ctes = sql.POINTS + sql.RAW_ORDERS + sql.MERCHANT + f"names(domain_type, event, tbl) as (values {TABLE_ROWS}),\n"
    stored = ""
    for number, bounds in enumerate(RUN_BOUNDS, 1):
        for made, table in (("food_made", "reach_to_restaurant_date_prediction"), ("water_made", "water_depart_date_prediction")):
            rows = f"(select order_id, date_us from {stored} where tbl = '{table}')" if stored else NO_PREDICTIONS
            ctes += f"{made}_{number} as {rows},\n"
        ctes += _window_ctes(number, bounds, events)
        order = "tbl, order_id, time_us nulls first, lat nulls first, lon nulls first, local_us nulls first"
        start = f"(select max(id) + 1 from {stored})" if stored else "0"
        ctes += f"""new_{number} as (select tbl, order_id, time_us as date_us, local_us, lat, lon,
          cast(row_number() over (order by {order}) - 1 + {start} as bigint) as id
          from all_made_{number} join names using (domain_type, event)),\n"""
        both = f"(select * from {stored} union all select * from new_{number})" if stored else f"new_{number}"
        stored = f"stored_{number}"
        ctes += f"{stored} as {_kept(both)},\n"
    return sql.build(ctes, f"select tbl as table_name, id as prediction_id, order_id, date_us, local_us, lat, lon from {stored}")


def _new_store(fx: Fixtures) -> PredictionStore:
    return PredictionStore(fx.spark, f"{shared_dir(fx.spark)}/store-{uuid.uuid4().hex}")


@query("publish_run", _run_sql())
def publish_run(fx: Fixtures) -> DataFrame:
    """Two overlapping windows, the second one knowing what the first has published, read back table by table."""
    store = _new_store(fx)
    run.publish_run(store, fx.inputs(), RUN_WINDOWS)
    parts = []
    for (event, domain_type), (name, shape) in PREDICTION_TABLES.items():
        rows = store.table(event, domain_type)
        date, date_l = EVENT_SHAPES[shape]
        parts.append(
            rows.select(
                F.lit(name).alias("table_name"),
                "prediction_id",
                "order_id",
                us(date, "date_us"),
                us(date_l, "local_us"),
                F.col("latitude").alias("lat"),
                F.col("longitude").alias("lon"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query("nightly_correction", ORACLES["depart_batches"])
def nightly_correction(fx: Fixtures) -> DataFrame:
    """The departure table after the day's jobs were aligned; parts without a correction stay as they are."""
    store = _new_store(fx)
    name, _ = table_of("depart", 1)
    made = fx.job_predictions.withColumnsRenamed({"predicted_depart_date": "date", "predicted_depart_dateL": "date_l"})
    store.commit(made.withColumns({"table": F.lit(name), "bucket": store.bucket()}))
    run.nightly_correction(store, fx.raw_orders, PART_START, PART_END)
    return store.table("depart", 1).select(
        "prediction_id",
        "order_id",
        us("predicted_depart_date", "depart_us"),
        us("predicted_depart_dateL", "depart_local_us"),
        "latitude",
        "longitude",
    )


# --- customer segments -------------------------------------------------------------------------

VALUES_SQL = sql.rfm_values(
    CHECK_DATE, RP.max_churn_recency, RP.max_f_recency, RP.first_n, RP.last_n, RP.store_last_n
)
VALUES_OUT = """client, cast(r_value as int) as r_value, t_value, cast(m_value as double) as m_value,
 cast(g_value as double) as g_value, f_value, anm5_value, h_value, device_type, device_brand, device_model, best_store,
 is_recent"""
RENAMED = {
    "client": "client",
    "rValue": "r_value",
    "tValue": "t_value",
    "mValue": "m_value",
    "gValue": "g_value",
    "fValue": "f_value",
    "anm5Value": "anm5_value",
    "hValue": "h_value",
    "deviceType": "device_type",
    "deviceBrand": "device_brand",
    "deviceModel": "device_model",
    "bestStore": "best_store",
    "isRecent": "is_recent",
}


def _ranked(fx: Fixtures) -> DataFrame:
    return rfm.order_ranks(fx.rfm_orders, fx.rfm_financials, RP)


@query(
    "rfm_order_ranks",
    sql.build(
        sql.rfm_ranks(CHECK_DATE),
        """select id, client, epoch_us(checkout_date) as checkout_us, net, margin, anm, device_type, maker, model, store,
           h, y, t from ro""",
    ),
)
def rfm_order_ranks(fx: Fixtures) -> DataFrame:
    return _ranked(fx).select(
        "id",
        "client",
        us("checkout_date", "checkout_us"),
        F.col("net_revenue_tax_excluded").alias("net"),
        F.col("gross_margin_tax_excluded").alias("margin"),
        F.col("a_andm_tax_excluded").alias("anm"),
        F.col("deviceinfo_device_type").alias("device_type"),
        F.col("deviceinfo_manufacturer").alias("maker"),
        F.col("deviceinfo_model").alias("model"),
        "store",
        "h",
        "y",
        "t",
    )


@query(
    "rfm_best_device_store",
    sql.build(VALUES_SQL, "select client, device_type, device_brand, device_model, best_store from rg"),
)
def rfm_best_device_store(fx: Fixtures) -> DataFrame:
    best = rfm.best_device_store(_ranked(fx), RP)
    return best.select(*[F.col(c).alias(RENAMED[c]) for c in best.columns])


@query("rfm_values", sql.build(VALUES_SQL, f"select {VALUES_OUT} from rg"))
def rfm_values(fx: Fixtures) -> DataFrame:
    return rfm.rfm_values(_ranked(fx), RP).select(*[F.col(c).alias(n) for c, n in RENAMED.items()])


@query(
    "rfm_segments",
    sql.build(
        VALUES_SQL + sql.rfm_segments(),
        f"""select {VALUES_OUT}, cast(r_class as int) as r_class, cast(f_class as int) as f_class,
            cast(t_class as int) as t_class, cast(m_class as int) as m_class, cast(g_class as int) as g_class,
            cast(anm5_class as int) as anm5_class, cast(h_class as int) as h_class,
            case when is_recent = 1 then cast(r_class as varchar) || cast(f_class as varchar) ||
                 cast(t_class as varchar) || cast(m_class as varchar) else '0000' end as rftm,
            case when is_recent = 1 then cast(r_class as varchar) || ',' || cast(f_class as varchar) || ',' ||
                 cast(t_class as varchar) || ',' || cast(m_class as varchar) || ',' || cast(g_class as varchar) || ',' ||
                 cast(anm5_class as varchar) || ',' || device_model else '0000' end as unified_class,
            '{CHECK_DATE}' as last_included from rs""",
    ),
)
def rfm_segments(fx: Fixtures) -> DataFrame:
    return _segments_out(rfm.rfm_segments(fx.rfm_orders, fx.rfm_financials, RP))


@query("rfm_segment_table", ORACLES["rfm_segments"])
def rfm_segment_table(fx: Fixtures) -> DataFrame:
    """The segments as a table that is written twice, the second time in place of the first."""
    name = f"segments_{uuid.uuid4().hex}"
    path = f"{shared_dir(fx.spark)}/{name}"
    segments = rfm.rfm_segments(fx.rfm_orders, fx.rfm_financials, RP)
    rfm.save_segments(segments.limit(0), name, path)
    return _segments_out(rfm.save_segments(segments, name, path))


def _segments_out(segments: DataFrame) -> DataFrame:
    return segments.select(
        *[F.col(c).alias(n) for c, n in RENAMED.items()],
        *[F.col(c).alias(c.replace("Class", "_class")) for c in rfm.CLASSES],
        F.col("RFTM").alias("rftm"),
        F.col("unifiedclass").alias("unified_class"),
        F.col("LastIncludedOrderDate").cast("string").alias("last_included"),
    )


# --- run windows and summaries -----------------------------------------------------------------


@query(
    "hour_windows",
    sql.build(
        sql.ORDERS
        + f"h as (select {sql.EPOCH} + i * {sql.HOUR} as s, {sql.EPOCH} + (i + 1) * {sql.HOUR} as e from range(2) r(i)),",
        """select h.s as start_us, h.e as end_us, count(o.id) as n_orders, cast(sum(o.deliver_us // 1000000) as bigint) as deliver_s
           from h left join ords o on o.deliver_us between h.s and h.e group by h.s, h.e""",
    ),
)
def hour_windows(fx: Fixtures) -> DataFrame:
    placed = windows.in_windows(fx.orders, "deliver_date", START, "2024-01-01 01:30:00")
    counted = placed.groupBy("window_start", "window_end").agg(
        F.count("_id_oid").alias("n_orders"), F.sum(F.unix_seconds("deliver_date")).alias("deliver_s")
    )
    listed = windows.hour_windows(fx.spark, START, "2024-01-01 01:30:00")
    return listed.join(counted, ["window_start", "window_end"], "left").select(
        us("window_start", "start_us"),
        us("window_end", "end_us"),
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        "deliver_s",
    )


@query(
    "run_summary",
    sql.build(
        sql.BASE
        + sql.reach("r", "ords", "cl")
        + sql.client_departure("c", "ords", False)
        + sql.delivery("v", "rr", "cl"),
        """select cast(4 as int) as domain_type, event, n as processed from (
           select 'reach' as event, count(distinct route) as n from ords union all
           select 'depart_from_client', count(distinct route) from ords union all
           select 'deliver', count(distinct id) from cl)""",
    ),
)
def run_summary(fx: Fixtures) -> DataFrame:
    orders = fx.orders.withColumn("domain_type", F.lit(4))
    made = pl.line_events(["reach", "depart_from_client", "deliver"], fx.orders, every_point(fx), 4)
    return windows.run_summary(reduce(DataFrame.unionByName, pl.tagged(made, 4)), orders)


@query(
    "null_counts",
    sql.build(
        sql.ORDERS,
        """select column_name, cast(n as bigint) as null_count, cast(total as bigint) as row_count from (
           select 'delivery_job_oid' as column_name, count(*) filter (job is null) as n, count(*) as total from ords union all
           select 'time_zone', count(*) filter (tz is null), count(*) from ords) where n > 0""",
    ),
)
def null_counts(fx: Fixtures) -> DataFrame:
    return windows.null_counts(fx.orders)
