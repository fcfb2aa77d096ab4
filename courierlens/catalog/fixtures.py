"""Courier tables shaped out of the generic driver tables.

A user of ``events`` is a courier. Every purchase with an id divisible by
three starts an order, and the courier's following events are its trace. Times
are squeezed by 600, so a month of events becomes 72 minutes of driving. After
the twelfth point of a trace the order id turns into the text 'null': the
courier is on the way back.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.operators.slices import forward_fill, number_rows, with_slice
from courierlens.params import EventParams
from courierlens.plans.pipelines import Inputs
from courierlens.session import shared_dir, use_utc
from courierlens.sources.points import DT_FORMAT_SQL

EPOCH = 1_704_067_200_000_000  # 2024-01-01
SQUEEZE = 600
START, END = "2024-01-01 00:00:00", "2024-01-01 02:00:00"
WAREHOUSE = (29.0, 41.0)
CLIENT = (29.0, 41.0040)

_made: dict[tuple[str, str], Fixtures] = {}


def fixtures(spark: SparkSession, sf_dir: str) -> Fixtures:
    """Fixture tables over one data folder, staged once per application."""
    use_utc(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _made:
        _made[key] = Fixtures(spark, sf_dir)
    return _made[key]


def _at(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def _text(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.home = f"{shared_dir(spark)}/fixtures-{uuid.uuid4().hex}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def _staged(self, df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
        path = f"{self.home}/{name}"
        writer = df.write.partitionBy(partition) if partition else df.write
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @property
    def events(self) -> DataFrame:
        micros = F.unix_micros(F.col("ts").cast("timestamp"))
        starts = (F.col("event_type") == "purchase") & (F.col("event_id") % 3 == 0)
        return self.read("events").select(
            "event_id",
            "user_id",
            "event_type",
            "value",
            micros.alias("us"),
            F.expr(f"{EPOCH} + (unix_micros(cast(ts as timestamp)) - {EPOCH}) div {SQUEEZE}").alias("time_us"),
            F.when(starts, F.col("event_id")).alias("anchor"),
        )

    @cached_property
    def trace_events(self) -> DataFrame:
        """Events with the order they follow (``seg``) and their place behind it."""
        sliced = with_slice(self.events.withColumn("time", _at(F.col("time_us"))), "time", EventParams().slice_seconds)
        followed = forward_fill(sliced, ["user_id"], ["us", "event_id"], {"anchor": "seg"}).filter("seg is not null")
        placed = number_rows(followed.repartition("seg", "slice"), ["seg"], ["us", "event_id"], "pos")
        value = F.col("value")
        rows = placed.select(
            "event_id",
            "user_id",
            "event_type",
            "seg",
            "pos",
            "time",
            (F.lit(41.0) + (value - 100 * F.floor(value / 100)) * F.lit(0.00012)).alias("lat"),
            (F.lit(29.0) + (F.col("event_id") % 7) * F.lit(0.00001)).alias("lon"),
            F.when(F.col("pos") <= 12, _text("o", "seg")).otherwise(F.lit("null")).alias("orderid"),
            F.date_format("time", DT_FORMAT_SQL).alias("dt"),
        )
        return self._staged(rows, "trace_events", "dt")

    @property
    def points(self) -> DataFrame:
        return self.trace_events.select(
            F.col("user_id").cast("string").alias("courierid"),
            F.lit(5.0).alias("acc"),
            F.when(F.col("pos") <= 6, 700).otherwise(900).alias("status"),
            F.col("time").alias("createdat"),
            "lat",
            "lon",
            "orderid",
            F.col("orderid").alias("foodorder"),
            F.col("orderid").alias("artisanorder"),
            "dt",
        )

    @cached_property
    def anchors(self) -> DataFrame:
        """Order starts: one row per order with its number ``n`` among the courier's orders."""
        starts = self.events.filter("anchor is not null").withColumn("time", _at(F.col("time_us")))
        numbered = number_rows(
            with_slice(starts, "time", EventParams().slice_seconds), ["user_id"], ["us", "event_id"], "n"
        )
        return self._staged(numbered.select("event_id", "user_id", "time_us", "n"), "anchors")

    def _order_columns(self) -> list[Column]:
        t = F.col("time_us")
        job = F.concat(
            _text("j", "user_id"), F.lit("-"), F.floor((F.col("n") - 1) / 2).cast("long").cast("string")
        )
        job_id = F.when(F.col("event_id") % 11 != 0, job)
        places = {
            "deliver_location": CLIENT,
            "reach_location": CLIENT,
            "delivery_address_location": CLIENT,
            "warehouse_location": WAREHOUSE,
        }
        return [
            F.col("event_id"),
            F.col("user_id"),
            _text("o", "event_id").alias("_id_oid"),
            F.coalesce(job_id, _text("r", "event_id")).alias("delivery_route_oid"),
            F.col("user_id").cast("string").alias("courier_courier_oid"),
            (F.col("user_id") % 25).cast("string").alias("country_oid"),
            _at(t - 120_000_000).alias("checkoutdatel"),
            _at(t - 60_000_000).alias("handover_date"),
            _at(t + 30_000_000).alias("onway_date"),
            _at(t + 120_000_000).alias("reach_date"),
            _at(t + 300_000_000).alias("deliver_date"),
            *[F.lit(lon).alias(f"{p}__coordinates_lon") for p, (lon, _) in places.items()],
            *[F.lit(lat).alias(f"{p}__coordinates_lat") for p, (_, lat) in places.items()],
            job_id.alias("delivery_job_oid"),
            (((F.col("n") - 1) % 2) + 1).cast("int").alias("delivery_batch_index"),
        ]

    @property
    def orders(self) -> DataFrame:
        """Market orders as event detection takes them, all finished."""
        zone = F.when(F.col("user_id") % 3 == 0, "Europe/Istanbul").when(F.col("user_id") % 3 == 1, "Europe/London")
        return self.anchors.select(*self._order_columns(), zone.alias("time_zone")).drop(
            "event_id", "user_id", "country_oid"
        )

    @property
    def raw_orders(self) -> DataFrame:
        """Market and water orders as the shop system holds them."""
        eid = F.col("event_id")
        return self.anchors.select(
            *self._order_columns(),
            F.when(eid % 13 == 0, 800).when(eid % 5 == 0, 1000).otherwise(900).alias("status"),
            F.when(eid % 7 == 0, 3).when(eid % 5 == 1, 4).otherwise(1).alias("domaintype"),
            F.when(eid % 5 == 0, _at(F.col("time_us") + 400_000_000)).alias("cancel_date"),
        )

    @property
    def food_orders(self) -> DataFrame:
        eid = F.col("event_id")
        return self.raw_orders.select(
            F.col("delivery_route_oid").alias("route_oid"),
            "_id_oid",
            F.col("courier_courier_oid").alias("courier_oid"),
            "status",
            (1 + eid % 2).cast("int").alias("deliverytype"),
            "checkoutdatel",
            F.col("deliver_date").alias("deliverdate"),
            F.col("reach_date").alias("reachdate"),
            F.col("handover_date").alias("handoverdate"),
            F.lit(CLIENT[0]).alias("deliveryaddress_location__coordinates_lon"),
            F.lit(CLIENT[1]).alias("deliveryaddress_location__coordinates_lat"),
            F.lit(WAREHOUSE[0]).alias("restaurantloc_lon"),
            F.lit(WAREHOUSE[1]).alias("restaurantloc_lat"),
        )

    @property
    def zones(self) -> DataFrame:
        key = F.col("n_nationkey")
        return (
            self.read("nation")
            .filter(key % 5 != 4)
            .select(
                key.cast("string").alias("country_id"),
                F.when(key % 2 == 0, "Europe/Istanbul").otherwise("Europe/London").alias("time_zone"),
            )
        )

    @property
    def status_log(self) -> DataFrame:
        method = F.when(F.col("event_type") == "click", "courierReachedToRestaurant").when(
            F.col("event_type") == "view", "courierReachedToClient"
        )
        return self.trace_events.select(
            F.col("orderid").alias("data_foodorder"),
            method.alias("data_method"),
            F.col("lat").alias("location__coordinates_lat"),
            F.col("lon").alias("location__coordinates_lon"),
            F.col("time").alias("createdatl"),
        ).filter("data_method is not null")

    @property
    def courier_domains(self) -> DataFrame:
        user = F.col("user_id")
        first = (1 + user % 3).cast("int")
        lines = F.when(user % 2 == 0, F.array(first, F.lit(2))).otherwise(F.array(first))
        return (
            self.read("events")
            .select(user)
            .distinct()
            .select(user.cast("string").alias("_p_id_oid"), F.explode(lines).alias("domaintypes"))
        )

    @property
    def couriers(self) -> DataFrame:
        user = F.col("user_id")
        return (
            self.read("events")
            .select(user)
            .distinct()
            .select(user.cast("string").alias("_id_oid"), (user % 40).cast("string").alias("warehouse_oid"))
        )

    @property
    def warehouses(self) -> DataFrame:
        key = F.col("s_suppkey")
        return (
            self.read("supplier")
            .filter(key % 9 != 8)
            .select(
                key.cast("string").alias("warehouse"),
                (F.lit(41.0) + (key % 10) * F.lit(0.0001)).alias("lat"),
                F.lit(29.0).alias("lon"),
            )
        )

    @property
    def predictions(self) -> DataFrame:
        """A reach prediction table with several rows per order id."""
        date = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("timestamp"))
        return self.read("orders").select(
            F.col("o_orderkey").alias("prediction_id"),
            _text("o", "o_custkey").alias("order_id"),
            date.alias("predicted_reach_date"),
            _at(F.unix_micros(date) + 10_800_000_000).alias("predicted_reach_dateL"),
            (F.lit(41.0) + F.col("o_orderkey") % 100 * F.lit(0.0001)).alias("latitude"),
            (F.lit(29.0) + F.col("o_orderkey") % 50 * F.lit(0.0001)).alias("longitude"),
            F.col("o_orderdate").cast("timestamp").alias("predictedat"),
        )

    @property
    def job_predictions(self) -> DataFrame:
        """Depart predictions of the market orders, a quarter of them empty."""
        eid = F.col("event_id")
        date = F.when(eid % 4 != 0, F.col("time_us") + 30_000_000 + eid % 5 * 10_000_000)
        return self.anchors.select(
            eid.alias("prediction_id"),
            _text("o", "event_id").alias("order_id"),
            _at(date).alias("predicted_depart_date"),
            _at(date + 10_800_000_000).alias("predicted_depart_dateL"),
            (F.lit(41.0) + eid % 10 * F.lit(0.0001)).alias("latitude"),
            (F.lit(29.0) + eid % 20 * F.lit(0.0001)).alias("longitude"),
            _at(F.col("time_us") + 3_600_000_000).alias("predictedat"),
        )

    @property
    def route_docs(self) -> DataFrame:
        """Nested routes of the points that carry their order's id: twelve at most per order."""
        at = F.struct("time", "lat", "lon")
        listed = (
            self.trace_events.filter(F.col("orderid") != "null")
            .groupBy("orderid")
            .agg(F.sort_array(F.collect_list(at)).alias("points"))
        )
        docs = listed.select(
            F.col("orderid").alias("_id"),
            F.transform(
                "points",
                lambda p: F.struct(
                    F.array(p["lon"], p["lat"]).alias("coordinates"), p["time"].alias("time"), F.lit(5.0).alias("acc")
                ),
            ).alias("route"),
        )
        empty = docs.groupBy().agg(F.lit("empty").alias("_id"), F.slice(F.first("route"), 1, 0).alias("route"))
        return docs.unionByName(empty)

    @property
    def recorded_routes(self) -> DataFrame:
        """Points under the id of the recorded delivery route."""
        routes = self.raw_orders.select(F.col("event_id").alias("seg"), "delivery_route_oid")
        return self.trace_events.join(routes, "seg").select(
            F.col("delivery_route_oid").alias("route_id"), "time", "lat", "lon"
        )

    @property
    def rfm_orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        placed = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
        verified = placed + key % 600 * 1_000_000
        return self.read("orders").withColumns({"d2": key % 2, "d3": key % 3, "d5": key % 5}).select(
            key.alias("id"),
            # text ids, as the shop has them; some orders have no client
            F.when(F.col("o_custkey") % 50 != 7, _text("c", "o_custkey")).alias("client"),
            F.col("o_orderdate").cast("timestamp").alias("checkout_date"),
            _at(verified).alias("courier_verify_date"),
            _at(verified + (300 + key % 900) * 1_000_000).alias("reach_date"),
            F.when(F.col("o_orderstatus") == "F", 900)
            .when(F.col("o_orderstatus") == "O", 1000)
            .otherwise(800)
            .alias("status"),
            F.col("o_orderpriority").alias("store"),
            _text("type", "d2").alias("deviceinfo_device_type"),
            _text("maker", "d3").alias("deviceinfo_manufacturer"),
            _text("model", "d5").alias("deviceinfo_model"),
        )

    @property
    def rfm_financials(self) -> DataFrame:
        """Money per order in whole cents, so sums do not depend on their order."""

        def cents(amount: str) -> Column:
            return F.sum(F.floor(F.expr(amount) * 100)).cast("double")

        return (
            self.read("lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(
                cents("l_extendedprice * (1 - l_discount)").alias("net_revenue_tax_excluded"),
                cents("l_extendedprice * l_tax").alias("gross_margin_tax_excluded"),
                cents("l_quantity").alias("a_andm_tax_excluded"),
            )
        )

    def inputs(self) -> Inputs:
        made = self.predictions
        departs = made.select(
            "order_id", F.col("predicted_reach_date").alias("predicted_depart_date")
        )
        return Inputs(
            market_orders=self.raw_orders,
            food_orders=self.food_orders,
            artisan_orders=self.food_orders,
            points=self.points,
            zones=self.zones,
            status_log=self.status_log,
            courier_domains=self.courier_domains,
            couriers=self.couriers,
            warehouses=self.warehouses,
            restaurant_predictions=made,
            shop_predictions=made,
            water_predictions=departs,
        )
