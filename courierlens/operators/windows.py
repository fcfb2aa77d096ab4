"""Run windows and summaries of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hour_windows(spark: SparkSession, start: str, end: str, step: str = "1 hour") -> DataFrame:
    """Consecutive windows from ``start`` while they begin before ``end``; the last may pass it."""
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    width = F.expr(f"interval {step}")
    begins = F.sequence(first, F.greatest(first, last - F.expr("interval 1 microsecond")), width)
    return (
        spark.range(1)
        .filter(first < last)
        .select(F.explode(begins).alias("window_start"))
        .withColumn("window_end", F.col("window_start") + width)
    )


def in_windows(df: DataFrame, time: str, start: str, end: str, seconds: int = 3600) -> DataFrame:
    """Rows with the windows that hold their time, both ends included.

    A time on the border of two windows is in both. The windows follow from
    the time by arithmetic, so there is no join with them.
    """
    width = seconds * 1_000_000
    origin = F.unix_micros(F.lit(start).cast("timestamp"))
    stop = F.unix_micros(F.lit(end).cast("timestamp"))
    offset = F.unix_micros(time) - origin
    number = F.floor(offset / F.lit(width))
    on_border = (offset % width == 0) & (offset > 0)
    numbers = F.when(on_border, F.array(number - 1, number)).otherwise(F.array(number))
    placed = df.withColumn("_number", F.explode(numbers))
    begins = origin + F.col("_number") * width
    return (
        placed.withColumn("window_start", F.timestamp_micros(begins))
        .withColumn("window_end", F.timestamp_micros(begins + width))
        .filter((F.col("_number") >= 0) & (begins < stop))
        .drop("_number")
    )


def run_summary(predictions: DataFrame, orders: DataFrame) -> DataFrame:
    """Per business line and event: how many delivery routes were processed.

    For deliveries it is the number of orders with a departure from the
    client. ``predictions`` are the rows of ``all_events``, ``orders`` has
    ``domain_type``, ``_id_oid`` and ``delivery_route_oid``.
    """
    routes = orders.select("domain_type", "_id_oid", "delivery_route_oid").distinct()
    processed = predictions.filter(F.col("event") != "deliver").join(routes, ["domain_type", "_id_oid"])
    counted = processed.groupBy("domain_type", "event").agg(
        F.countDistinct("delivery_route_oid").alias("processed")
    )
    left = predictions.filter((F.col("event") == "depart_from_client") & F.col("time").isNotNull())
    delivering = predictions.filter(F.col("event") == "deliver").select("domain_type").distinct()
    delivered = (
        left.join(delivering, "domain_type", "left_semi")
        .groupBy("domain_type")
        .agg(F.countDistinct("_id_oid").alias("processed"))
        .select("domain_type", F.lit("deliver").alias("event"), "processed")
    )
    return counted.unionByName(delivered)


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values of each column that has any, with the number of rows, from one pass."""
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("row_count"), F.struct(*counts).alias("n"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col("n")[c].alias("nulls")) for c in df.columns])
    return (
        one.select("row_count", F.explode(pairs).alias("p"))
        .select(F.col("p.column").alias("column_name"), F.col("p.nulls").alias("null_count"), "row_count")
        .filter(F.col("null_count") > 0)
    )
