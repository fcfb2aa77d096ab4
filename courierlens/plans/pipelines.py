"""From orders and traced points to predictions, per event and business line."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.operators.events import (
    PREDICTION_COLUMNS,
    complete_over_orders,
    delivery_midpoint,
    first_client_departure,
    first_depart,
    first_reach,
    one_per_order,
    propagate_first_batch,
)
from courierlens.operators.features import (
    COMPLETE,
    PLACES,
    client_departure_features,
    depart_features,
    reach_features,
    with_next_route,
)
from courierlens.operators.reducer import keep_possible
from courierlens.operators.slices import SLICE
from courierlens.operators.trace import with_courier_domain
from courierlens.params import ARTISAN, FOOD, MARKET, MARKET_DOMAINS, MERCHANT_DOMAINS, WATER, EventParams
from courierlens.session import stage
from courierlens.sources.orders import market_orders, merchant_orders, water_orders
from courierlens.sources.points import id_column_of, points_of, sliced_points, traces_of, window_points

REACH, REACH_TO_MERCHANT = "reach", "reach_to_merchant"
DEPART, DEPART_FROM_MERCHANT, DEPART_FROM_COURIER_WAREHOUSE = (
    "depart",
    "depart_from_merchant",
    "depart_from_courier_warehouse",
)
DEPART_FROM_CLIENT, DELIVER = "depart_from_client", "deliver"
EVENTS = (
    REACH,
    REACH_TO_MERCHANT,
    DEPART,
    DEPART_FROM_MERCHANT,
    DEPART_FROM_COURIER_WAREHOUSE,
    DEPART_FROM_CLIENT,
    DELIVER,
)


def _trace(points: DataFrame, orders: DataFrame, attributes: Sequence[str], p: EventParams) -> DataFrame:
    """Points with just the order attributes an event needs."""
    return traces_of(points, orders.select("_id_oid", *attributes), p)


def reach(
    orders: DataFrame, points: DataFrame, domain_type: int, p: EventParams = EventParams()
) -> DataFrame:
    """When each order's courier reached the client, for every business line."""
    place = "merchant_client" if domain_type in MERCHANT_DOMAINS else "client"
    trace = _trace(points, orders, ["time_zone", *PLACES[place]], p)
    return complete_over_orders(orders, first_reach(reach_features(trace, place, p, include_all=True), p))


def reach_to_merchant(
    orders: DataFrame, points: DataFrame, domain_type: int, p: EventParams = EventParams()
) -> DataFrame:
    """When each food or artisan order's courier reached the merchant; nothing at all without any trace."""
    trace = _trace(points, orders, ["time_zone", *PLACES["merchant"]], p)
    features = reach_features(trace, "merchant", p, include_all=True)
    # counted on the shuffle the features read as well, without their windows
    counts = trace.groupBy("route_id").agg(F.count("time").alias("_points"))
    long_enough = counts.filter(F.col("_points") >= p.min_points)
    return only_if_any(complete_over_orders(orders, first_reach(features, p)), long_enough)


def only_if_any(df: DataFrame, witness: DataFrame) -> DataFrame:
    """``df``, or no rows if ``witness`` has none; decided inside the plan."""
    one = witness.limit(1).select(F.lit(1).alias("_any"))
    # exactly one row at most, so it may be broadcast
    return df.withColumn("_any", F.lit(1)).join(F.broadcast(one), "_any", "left_semi").drop("_any")


def depart(
    orders: DataFrame,
    points: DataFrame,
    domain_type: int,
    source: str = "warehouse",
    p: EventParams = EventParams(),
    required: Sequence[str] | None = None,
    emit_empty: bool = True,
) -> DataFrame:
    """When the courier left the warehouse, or with ``source='merchant'`` the merchant.

    An order with a missing attribute (any, or one of ``required``) has no
    decision; such orders are left out before the join rather than after the
    windows. With ``emit_empty=False`` there are no rows unless some order has
    a decision.
    """
    use_onway = domain_type not in MERCHANT_DOMAINS
    whole = orders.na.drop(subset=list(required) if required is not None else None)
    # a point counts if nothing of it is missing; only that is shuffled of its further columns
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in points.columns])
    known &= reduce(Column.__and__, [~F.isnan(c) for c, kind in points.dtypes if kind in ("double", "float")])
    kept = ["route_id", "time", "lat", "lon", *([SLICE] if SLICE in points.columns else [])]
    slim = points.select(*kept, F.when(known, True).alias(COMPLETE))
    trace = _trace(slim, whole, ["time_zone", *PLACES[source], *(["onway_date"] if use_onway else [])], p)
    found = first_depart(depart_features(trace, source, p), p, use_onway)
    if domain_type in MARKET_DOMAINS:
        found = propagate_first_batch(found, orders)
    done = complete_over_orders(orders, found)
    return done if emit_empty else only_if_any(done, found)


def depart_from_client(
    orders: DataFrame, points: DataFrame, domain_type: int, p: EventParams = EventParams()
) -> DataFrame:
    """When the courier left the client; market routes first get the next route of the job as a tail."""
    return complete_over_orders(orders, _client_departure(orders, points, domain_type, p))


def _client_departure(orders: DataFrame, points: DataFrame, domain_type: int, p: EventParams) -> DataFrame:
    attributes = ["time_zone", "reach_date", "deliver_date", *PLACES["client"]]
    if domain_type in MARKET_DOMAINS:
        attributes.append("delivery_job_oid")
    if domain_type in MARKET_DOMAINS:
        # written, as a trace reads its points several times; with the tails its slices are others
        slim = points.select("route_id", "time", "lat", "lon")
        points = stage(with_next_route(slim, orders.select("_id_oid", "delivery_job_oid"), p), "lengthened")
    trace = _trace(points, orders, attributes, p)
    return first_client_departure(client_departure_features(trace, p), p)


def deliver(
    orders: DataFrame, points: DataFrame, domain_type: int, p: EventParams = EventParams()
) -> DataFrame:
    """Delivery times of the orders that have both a reach and a departure decision."""
    arrived = one_per_order(reach(orders, points, domain_type, p))
    return delivery_midpoint(arrived, _client_departure(orders, points, domain_type, p))


@dataclass(frozen=True)
class Inputs:
    """The tables an event run reads."""

    market_orders: DataFrame
    food_orders: DataFrame
    artisan_orders: DataFrame
    points: DataFrame
    zones: DataFrame
    status_log: DataFrame
    courier_domains: DataFrame
    couriers: DataFrame
    warehouses: DataFrame
    restaurant_predictions: DataFrame
    shop_predictions: DataFrame
    water_predictions: DataFrame
    water_predicted: str = "predicted_depart_date"


def orders_of(inputs: Inputs, domain_type: int, start: str, end: str, courier_ids: Sequence[str] | None = None) -> DataFrame:
    """Orders of one business line, each once even if it has several empty predictions."""
    if domain_type == MARKET:
        return market_orders(inputs.market_orders, inputs.zones, start, end, courier_ids)
    if domain_type == WATER:
        return water_orders(
            inputs.market_orders,
            inputs.zones,
            inputs.water_predictions,
            inputs.water_predicted,
            start,
            end,
            courier_ids,
            repeat=False,
        )
    orders, made = {
        FOOD: (inputs.food_orders, inputs.restaurant_predictions),
        ARTISAN: (inputs.artisan_orders, inputs.shop_predictions),
    }[domain_type]
    return merchant_orders(
        orders,
        inputs.status_log,
        made,
        inputs.couriers,
        inputs.warehouses,
        start,
        end,
        domain_type,
        courier_ids=courier_ids,
        repeat=False,
    )


def events_for(events: Iterable[str], domain_type: int) -> list[str]:
    """Which of the asked events a business line has. Unknown names are an error."""
    asked = list(dict.fromkeys(events))
    unknown = set(asked) - set(EVENTS)
    if unknown:
        raise ValueError(f"unknown events: {sorted(unknown)}; known: {list(EVENTS)}")
    if domain_type in MERCHANT_DOMAINS:
        wanted = []
        for event in asked:
            if event == DEPART:
                wanted += [DEPART_FROM_MERCHANT, DEPART_FROM_COURIER_WAREHOUSE]
            elif event in (REACH_TO_MERCHANT, DEPART_FROM_MERCHANT, DEPART_FROM_COURIER_WAREHOUSE):
                wanted.append(event)
        return list(dict.fromkeys(wanted))
    return [e for e in asked if e in (REACH, DEPART, DEPART_FROM_CLIENT, DELIVER)]


def event_predictions(
    event: str,
    orders: DataFrame,
    points: DataFrame,
    domain_type: int,
    courier_domains: DataFrame | None = None,
    p: EventParams = EventParams(),
) -> DataFrame:
    """Predictions of one event for the orders of one business line."""
    if event in (DEPART_FROM_MERCHANT, DEPART_FROM_COURIER_WAREHOUSE):
        source = "merchant" if event == DEPART_FROM_MERCHANT else "warehouse"
        own = with_courier_domain(orders, courier_domains)
        return depart(own, points, domain_type, source, p)
    plan: dict[str, Callable[..., DataFrame]] = {
        REACH: reach,
        REACH_TO_MERCHANT: reach_to_merchant,
        DEPART_FROM_CLIENT: depart_from_client,
        DELIVER: deliver,
    }
    if event == DEPART:
        return depart(orders, points, domain_type, "warehouse", p)
    return plan[event](orders, points, domain_type, p)


def at_once(tasks: Sequence[Callable[[], DataFrame]], p: EventParams) -> list[DataFrame]:
    """Results of independent small jobs; Spark runs up to ``parallel_jobs`` of them side by side."""
    with ThreadPoolExecutor(p.parallel_jobs) as pool:
        return list(pool.map(lambda task: task(), tasks))


def lines_events(
    events: Iterable[str],
    lines: dict[int, tuple[DataFrame, DataFrame]],
    courier_domains: DataFrame | None = None,
    p: EventParams = EventParams(),
) -> dict[int, dict[str, DataFrame]]:
    """Staged predictions of the asked events by business line, from the (orders, points) of each.

    Each event is a job of its own whose small result is written, so plans
    stay small, and a delivery is put together from the two written events it
    needs, which are made if nobody asked for them. The points of a line are
    cut into slices once for all its events.
    """
    asked = list(events)
    wanted = {domain: events_for(asked, domain) for domain in lines}
    first = []
    for domain, names in wanted.items():
        needed = [*names, *([REACH, DEPART_FROM_CLIENT] if DELIVER in names else [])]
        first += [(domain, event) for event in dict.fromkeys(needed) if event != DELIVER]

    used = list(dict.fromkeys(domain for domain, _ in first))
    cut = dict(zip(used, at_once([partial(sliced_points, lines[d][1], p) for d in used], p), strict=True))

    def predict(domain: int, event: str) -> DataFrame:
        return stage(event_predictions(event, lines[domain][0], cut[domain], domain, courier_domains, p), f"{event}-{domain}")

    def halfway(domain: int) -> DataFrame:
        return stage(delivery_midpoint(one_per_order(made[domain, REACH]), made[domain, DEPART_FROM_CLIENT]), f"{DELIVER}-{domain}")

    made = dict(zip(first, at_once([partial(predict, *key) for key in first], p), strict=True))
    last = [domain for domain, names in wanted.items() if DELIVER in names]
    made |= dict(zip([(domain, DELIVER) for domain in last], at_once([partial(halfway, d) for d in last], p), strict=True))
    return {domain: {event: made[domain, event] for event in names} for domain, names in wanted.items()}


def line_events(
    events: Iterable[str],
    orders: DataFrame,
    points: DataFrame,
    domain_type: int,
    courier_domains: DataFrame | None = None,
    p: EventParams = EventParams(),
) -> dict[str, DataFrame]:
    """``lines_events`` of one business line."""
    return lines_events(events, {domain_type: (orders, points)}, courier_domains, p)[domain_type]


def tagged(made: dict[str, DataFrame], domain_type: int) -> list[DataFrame]:
    return [
        df.select(F.lit(domain_type).alias("domain_type"), F.lit(event).alias("event"), *PREDICTION_COLUMNS)
        for event, df in made.items()
    ]


def all_events(
    inputs: Inputs,
    start: str,
    end: str,
    events: Iterable[str] = EVENTS,
    domain_types: Iterable[int] = (MARKET, FOOD, WATER, ARTISAN),
    p: EventParams = EventParams(),
    courier_ids: Sequence[str] | None = None,
) -> DataFrame:
    """Predictions of all asked events and business lines of a window in one frame.

    The orders come first. The points are attributed to the orders of all
    business lines in one pass, and of them only what may belong to one of
    these orders is written, as every event reads it.
    """
    asked = list(events)
    lines = [d for d in domain_types if events_for(asked, d)]
    if not lines:
        raise ValueError("none of the asked events exists for the asked business lines")

    def line_orders(domain_type: int) -> DataFrame:
        return stage(orders_of(inputs, domain_type, start, end, courier_ids), f"orders-{domain_type}")

    orders = dict(zip(lines, at_once([partial(line_orders, d) for d in lines], p), strict=True))
    wanted: dict[str, DataFrame] = {}
    for domain_type in lines:
        column = f"{id_column_of(domain_type)}_filled"
        ids = orders[domain_type].select("_id_oid")
        wanted[column] = wanted[column].unionAll(ids) if column in wanted else ids
    attributed = stage(keep_possible(window_points(inputs.points, lines, start, end, p), wanted), "points")
    made = lines_events(asked, {d: (orders[d], points_of(attributed, d)) for d in lines}, inputs.courier_domains, p)
    return reduce(DataFrame.unionByName, [part for d in lines for part in tagged(made[d], d)])
