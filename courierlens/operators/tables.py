"""Writing, loading and maintaining prediction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courierlens.contracts import prediction_schema, staged_columns, staged_schema
from courierlens.operators.events import PREDICTION_COLUMNS
from courierlens.operators.ranks import in_tasks
from courierlens.params import FINISHED_STATUSES, MARKET_DOMAINS
from courierlens.sources.orders import with_job

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def as_staged(predictions: DataFrame, shape: str) -> DataFrame:
    """Predictions under the column names of their table, in file order."""
    renamed = zip(PREDICTION_COLUMNS, staged_columns(shape), strict=True)
    return predictions.select(*[F.col(old).alias(new) for old, new in renamed])


def write_predictions(predictions: DataFrame, shape: str, path: str, mode: str = "append") -> None:
    """Pipe-separated files with a header, one per task, below ``path``."""
    as_staged(predictions, shape).write.mode(mode).options(sep="|", header=True, timestampFormat=TIME_FORMAT).csv(path)


def dense_ids(df: DataFrame, order: Sequence[str], out: str, start: int = 0) -> DataFrame:
    """Number the rows by some columns from ``start`` on without gaps.

    The rows are range-partitioned by that order and written with their task
    and their place in it, so later reads give the same numbers whatever
    becomes of executors. What is summed up over all tasks is one count each.
    """
    placed = in_tasks(df, order)
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_task")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    # one row per task of the load
    numbers = placed.join(F.broadcast(offsets), "_task")
    return numbers.withColumn(out, F.col("_before") + F.col("_place") + F.lit(start).cast("long")).drop("_task", "_place", "_before")


def load_staged(
    spark: SparkSession, path: str, shape: str, existing: DataFrame | None = None
) -> DataFrame:
    """Files below ``path`` as table rows after the ``existing`` ones, with new ids and the load time.

    New ids go on from the highest existing one without gaps, in order of the
    rows' values.
    """
    files = (
        spark.read.schema(staged_schema(shape))
        .options(sep="|", header=True, timestampFormat=TIME_FORMAT)
        .csv(path)
    )
    start = 0
    if existing is not None:
        highest = existing.agg(F.max("prediction_id")).first()[0]
        start = 0 if highest is None else highest + 1
    loaded = dense_ids(files, staged_columns(shape), "prediction_id", start).select(
        "prediction_id",
        *staged_columns(shape),
        F.current_timestamp().alias("predictedat"),
    )
    return loaded if existing is None else existing.unionByName(loaded)


def conform_to_contract(df: DataFrame, shape: str) -> DataFrame:
    """Project and cast a frame to its prediction table; columns it lacks are null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in prediction_schema(shape).fields
        ]
    )


def keep_latest(df: DataFrame, id_column: str, keys: Sequence[str]) -> DataFrame:
    """The row with the highest id of each key, even if it holds fewer values than an older one.

    The rank limit works on each task's own rows first, so a key with very
    many rows sends one per task.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.col(id_column).desc())
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter(F.col("_rank") == 1).drop("_rank")


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target without the keys of the source, plus all source rows."""
    return target.join(source.select(key).distinct(), key, "left_anti").select(*target.columns).unionByName(source)


def apply_updates(target: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Overwrite ``columns`` in the rows whose key has an update; one update per key."""
    new = updates.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = target.join(new, key, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def batch_corrections(
    orders: DataFrame, predictions: DataFrame, start: str, end: str, jobless_together: bool = True
) -> DataFrame:
    """Orders of a multi-order job whose departure differs from the latest one of the job.

    Both date columns get the job's latest UTC departure; the place stays the
    order's own. All finished market orders of the window count, and those
    without a job count as one job, or with ``jobless_together=False`` as none.
    """
    shown = predictions.select(
        F.col("order_id").alias("_predicted_id"), "predicted_depart_date", "latitude", "longitude"
    )
    finished = orders.filter(
        F.col("deliver_date").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
        & F.col("status").isin(*FINISHED_STATUSES)
        & F.col("domaintype").isin(*MARKET_DOMAINS)
    ).select("_id_oid", "delivery_job_oid", "delivery_batch_index")
    shown = finished.join(shown, finished["_id_oid"] == shown["_predicted_id"], "left").drop("_predicted_id")
    jobs = shown.groupBy(F.col("delivery_job_oid").alias("_job")).agg(
        F.max("predicted_depart_date").alias("job_depart"), F.max("delivery_batch_index").alias("max_index")
    )
    if not jobless_together:
        jobs = jobs.filter("_job is not null")
    return (
        with_job(shown, jobs)
        .filter((F.col("max_index") > 1) & (F.col("predicted_depart_date") != F.col("job_depart")))
        .select(
            F.col("_id_oid").alias("order_id"),
            F.col("job_depart").alias("predicted_depart_date"),
            F.col("job_depart").alias("predicted_depart_dateL"),
            "latitude",
            "longitude",
        )
        .distinct()
    )


def job_corrections(orders: DataFrame, predictions: DataFrame, start: str, end: str) -> DataFrame:
    """One correction per order: ``order_id``, ``fixed_date``, ``fixed_latitude`` and ``fixed_longitude``.

    An order with several prediction rows can have several corrections that
    differ in place only; the smallest place is taken.
    """
    place = F.struct("predicted_depart_date", "latitude", "longitude")
    return (
        batch_corrections(orders, predictions, start, end)
        .groupBy("order_id")
        .agg(F.min(place).alias("_fix"))
        .select(
            "order_id",
            F.col("_fix.predicted_depart_date").alias("fixed_date"),
            F.col("_fix.latitude").alias("fixed_latitude"),
            F.col("_fix.longitude").alias("fixed_longitude"),
        )
    )


def align_batches(orders: DataFrame, predictions: DataFrame, start: str, end: str) -> DataFrame:
    """Prediction table with the corrections of ``batch_corrections`` applied where the date differs."""
    fixed = {
        "predicted_depart_date": "fixed_date",
        "predicted_depart_dateL": "fixed_date",
        "latitude": "fixed_latitude",
        "longitude": "fixed_longitude",
    }
    joined = predictions.join(job_corrections(orders, predictions, start, end), "order_id", "left")
    differs = F.col("predicted_depart_date") != F.col("fixed_date")
    return joined.select(
        *[F.when(differs, F.col(fixed[c])).otherwise(F.col(c)).alias(c) if c in fixed else F.col(c) for c in predictions.columns]
    )
