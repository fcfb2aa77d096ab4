"""Customer segments by recency, frequency, order count and value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.operators.ranks import ntile_columns, numbered
from courierlens.params import RfmParams
from courierlens.session import stage

# The columns that name a device.
DEVICE = ["deviceinfo_device_type", "deviceinfo_manufacturer", "deviceinfo_model"]
# Class column, the value it ranks, and whether small values come first.
CLASSES = {
    "rClass": ("rValue", True),
    "fClass": ("fValue", False),
    "tClass": ("tValue", False),
    "mClass": ("mValue", False),
    "gClass": ("gValue", False),
    "anm5Class": ("anm5Value", True),
    "hClass": ("hValue", True),
}
CODE = ["rClass", "fClass", "tClass", "mClass"]
UNIFIED = [*CODE, "gClass", "anm5Class"]


def _age_days(rp: RfmParams) -> Column:
    """Calendar days between an order and the check date."""
    return F.datediff(F.lit(rp.check_date).cast("date"), F.col("checkout_date").cast("date"))


def order_ranks(orders: DataFrame, financials: DataFrame, rp: RfmParams) -> DataFrame:
    """Orders with their money, numbered per client: ``y`` newest first, ``t`` oldest first.

    ``h`` is the seconds from the courier's confirmation to reaching. Order ids
    settle equal times. Orders without a client are one client's; no client is too large.
    """
    counted = orders.filter(
        F.col("status").isin(list(rp.statuses))
        & (F.col("checkout_date").cast("date") <= F.lit(rp.check_date).cast("date"))
    )
    money = financials.select(
        F.col("order_id").alias("id"),
        "net_revenue_tax_excluded",
        "gross_margin_tax_excluded",
        "a_andm_tax_excluded",
    )
    joined = counted.join(money, "id").withColumn(
        "h", F.unix_timestamp("reach_date") - F.unix_timestamp("courier_verify_date")
    )
    ranked = numbered(joined, ["client"], ["checkout_date", "id"], "t", total="_orders")
    return ranked.withColumn("y", F.col("_orders") - F.col("t") + 1).select(
        "id",
        "client",
        "checkout_date",
        "net_revenue_tax_excluded",
        *DEVICE,
        "a_andm_tax_excluded",
        "store",
        "gross_margin_tax_excluded",
        "h",
        "y",
        "t",
    )


def same_client(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on the client, orders without one being one client's."""
    other = right.withColumnRenamed("client", "_other")
    return left.join(other, F.col("client").eqNullSafe(F.col("_other"))).drop("_other")


def best_device_store(ranked: DataFrame, rp: RfmParams) -> DataFrame:
    """Per client the device and the store with the highest revenue in the latest orders.

    Sums are taken per device and store first, with map-side combine; the
    lowest order id settles equal sums.
    """

    def top(groups: list[str], last: int, kept: list[str]) -> DataFrame:
        revenue = F.sum(F.when(F.col("y") <= last, F.col("net_revenue_tax_excluded")).otherwise(F.lit(0.0)))
        sums = ranked.groupBy("client", *groups).agg(revenue.alias("sum"), F.min("id").alias("first_id"))
        # the highest comes first, a missing sum before all; ids may be text
        rank = F.struct(F.col("sum").isNotNull(), ~F.isnan(F.coalesce("sum", F.lit(0.0))), -F.col("sum"), "first_id")
        return sums.groupBy("client").agg(F.min_by(F.struct(*kept), rank).alias("best"))

    device = top(DEVICE, rp.last_n, DEVICE).select(
        "client", *[F.col("best")[c].alias(n) for c, n in zip(DEVICE, ["deviceType", "deviceBrand", "deviceModel"], strict=True)]
    )
    store = top(["store"], rp.store_last_n, ["store"]).select("client", F.col("best.store").alias("bestStore"))
    return same_client(device, store)


def rfm_values(ranked: DataFrame, rp: RfmParams) -> DataFrame:
    """One row per client: the values the segments are built from."""
    recent_order = _age_days(rp) <= rp.max_churn_recency

    def within(condition: Column, value: Column) -> Column:
        return F.sum(F.when(condition, value).otherwise(F.lit(0)))

    totals = ranked.groupBy("client").agg(
        F.count("id").alias("tValue"),
        F.min(_age_days(rp)).alias("rValue"),
        within(recent_order, F.col("net_revenue_tax_excluded")).alias("_money"),
        within(recent_order, F.col("gross_margin_tax_excluded")).alias("_margin"),
        within(recent_order, F.lit(1)).alias("_recent_orders"),
        within(_age_days(rp) <= rp.max_f_recency, F.lit(1)).alias("_f"),
        within(F.col("t") <= rp.first_n, F.col("a_andm_tax_excluded")).alias("anm5Value"),
        F.avg(F.when(recent_order, F.col("h"))).alias("hValue"),
    )
    recent = F.col("rValue") <= rp.max_churn_recency

    def gated(value: Column, otherwise: Column) -> Column:
        return F.when(recent, value).otherwise(otherwise)

    per_order = {
        "mValue": F.try_divide("_money", "_recent_orders"),
        "gValue": F.try_divide("_margin", "_recent_orders"),
    }
    return same_client(totals, best_device_store(ranked, rp)).select(
        "client",
        "rValue",
        "tValue",
        *[gated(v, F.lit(0.0)).alias(n) for n, v in per_order.items()],
        gated(F.col("_f"), F.lit(0)).cast("long").alias("fValue"),
        "anm5Value",
        "hValue",
        "deviceType",
        "deviceBrand",
        "deviceModel",
        "bestStore",
        gated(F.lit(1), F.lit(0)).alias("isRecent"),
    )


def rfm_segments(orders: DataFrame, financials: DataFrame, rp: RfmParams) -> DataFrame:
    """Clients with quartile classes within recent and lost clients, and their segment codes.

    The orders' ranks and the client values are staged, as both are read
    several times.
    """
    ranked = stage(order_ranks(orders, financials, rp), "rfm-ranks")
    values = stage(rfm_values(ranked, rp), "rfm-values")
    classed = ntile_columns(values, "isRecent", "client", CLASSES)
    recent = F.col("isRecent") == 1
    # like ||, a missing part makes the whole code missing
    unified = F.concat(*[part for c in UNIFIED for part in (F.col(c).cast("string"), F.lit(","))], F.col("deviceModel"))
    return classed.select(
        *values.columns,
        *CLASSES,
        F.when(recent, F.concat(*[F.col(c).cast("string") for c in CODE])).otherwise(F.lit("0000")).alias("RFTM"),
        F.when(recent, unified).otherwise(F.lit("0000")).alias("unifiedclass"),
        F.lit(rp.check_date).cast("date").alias("LastIncludedOrderDate"),
    )


def save_segments(segments: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Put segments into a table of the session's catalog in place of what it held, and return the table."""
    writer = segments.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return segments.sparkSession.table(table)
