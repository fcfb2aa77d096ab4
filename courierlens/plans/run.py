"""A run from windows to corrected tables: predict, publish, de-duplicate, align the jobs of a day."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlens.contracts import DEDUPLICATED_TABLES, PREDICTION_TABLES, table_of
from courierlens.operators.tables import dense_ids, job_corrections
from courierlens.params import ARTISAN, FOOD, MARKET, WATER, EventParams
from courierlens.plans.pipelines import DEPART, DEPART_FROM_CLIENT, EVENTS, REACH_TO_MERCHANT, Inputs, all_events
from courierlens.session import stage
from courierlens.sources.store import COLUMNS, Part, PredictionStore


def table_name() -> Column:
    """Table of a row's event and business line; null where there is none."""
    names = {f"{event} {domain}": name for (event, domain), (name, _) in PREDICTION_TABLES.items()}
    line = F.when(F.col("domain_type") == 3, MARKET).otherwise(F.col("domain_type"))
    return F.create_map(*map(F.lit, chain(*names.items())))[F.concat_ws(" ", "event", line.cast("string"))]


def routed(predictions: DataFrame, store: PredictionStore) -> DataFrame:
    """Rows of ``all_events`` as rows of the store, each with its table and bucket; unknown pairs are an error."""
    name = table_name()
    unknown = F.concat(F.lit("no table for "), F.col("event"), F.lit(" "), F.col("domain_type").cast("string"))
    return predictions.select(
        F.coalesce(name, F.raise_error(unknown).cast("string")).alias("table"),
        F.col("_id_oid").alias("order_id"),
        F.col("time").alias("date"),
        F.col("time_l").alias("date_l"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
    ).withColumn("bucket", store.bucket())


def _touched(rows: DataFrame) -> list[Part]:
    """Parts that rows belong to: at most tables times buckets."""
    return [tuple(r) for r in rows.select("table", "bucket").distinct().collect()]


def newest(rows: DataFrame) -> DataFrame:
    """Per order the newest row in the tables that are de-duplicated; elsewhere what is said twice is kept once."""
    said = F.struct("date", "date_l", "latitude", "longitude")
    marked = rows.withColumn("_said", F.when(~F.col("table").isin(list(DEDUPLICATED_TABLES)), said))
    latest = Window.partitionBy("table", "order_id", "_said").orderBy(F.col("prediction_id").desc())
    return marked.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank", "_said")


def publish(store: PredictionStore, predictions: DataFrame) -> int | None:
    """Add predictions (rows of ``all_events``) to all tables in one commit and keep the newest of each order.

    New ids follow the highest there is without gaps, in order of table, order,
    time and place. Only parts that get a row are read and written.
    """
    highest = store.read().agg(F.max("prediction_id")).first()[0]
    rows = routed(predictions, store)
    order = ["table", "order_id", "date", "latitude", "longitude", "date_l"]
    new = stage(
        dense_ids(rows, order, "prediction_id", 0 if highest is None else highest + 1).withColumn(
            "predictedat", F.current_timestamp()
        ),
        "predictions",
    )
    touched = _touched(new)
    if not touched:
        return None
    columns = [*COLUMNS, "table", "bucket"]
    return store.commit(newest(store.read(parts=touched).select(*columns).unionByName(new.select(*columns))))


def water_table(events: Iterable[str]) -> tuple[str, str]:
    """Event whose table tells which water orders wait, and its date column, by what is asked for."""
    if list(dict.fromkeys(events)) == [DEPART_FROM_CLIENT]:
        return DEPART_FROM_CLIENT, "predicted_depart_from_client_date"
    return DEPART, "predicted_depart_date"


def fed_back(inputs: Inputs, store: PredictionStore, events: Iterable[str]) -> Inputs:
    """Inputs whose orders count as predicted if the store says so."""
    event, column = water_table(events)
    return replace(
        inputs,
        restaurant_predictions=store.table(REACH_TO_MERCHANT, FOOD),
        shop_predictions=store.table(REACH_TO_MERCHANT, ARTISAN),
        water_predictions=store.table(event, WATER),
        water_predicted=column,
    )


def publish_run(
    store: PredictionStore,
    inputs: Inputs,
    windows: Sequence[tuple[str, str]],
    events: Iterable[str] = EVENTS,
    domain_types: Iterable[int] = (MARKET, FOOD, WATER, ARTISAN),
    p: EventParams = EventParams(),
    courier_ids: Sequence[str] | None = None,
) -> list[int]:
    """Predict and publish window after window; each window sees what the ones before have published.

    A window run again adds nothing: its orders are predicted already or their
    newest row says the same.
    """
    asked = list(events)
    lines = list(domain_types)
    versions = []
    for start, end in windows:
        made = all_events(fed_back(inputs, store, asked), start, end, asked, lines, p, courier_ids)
        versions.append(publish(store, made))
    return [v for v in versions if v is not None]


def nightly_correction(store: PredictionStore, orders: DataFrame, start: str, end: str) -> int | None:
    """Give the orders of a multi-order job the job's latest departure, in one commit.

    Only the parts of the departure table with an order to correct are read
    for it and written; without any there is no commit.
    """
    name, _ = table_of(DEPART, MARKET)
    fixes = stage(
        job_corrections(orders, store.table(DEPART, MARKET), start, end)
        .select("order_id", "fixed_date", "fixed_latitude", "fixed_longitude")
        .withColumns({"table": F.lit(name), "bucket": store.bucket()}),
        "corrections",
    )
    touched = _touched(fixes)
    if not touched:
        return None
    rows = store.read(parts=touched).join(fixes.drop("table", "bucket"), "order_id", "left")
    differs = F.col("date") != F.col("fixed_date")
    fixed = {"date": "fixed_date", "date_l": "fixed_date", "latitude": "fixed_latitude", "longitude": "fixed_longitude"}
    return store.commit(
        rows.select(
            *[F.when(differs, F.col(fixed[c])).otherwise(F.col(c)).alias(c) if c in fixed else F.col(c) for c in COLUMNS],
            "table",
            "bucket",
        )
    )
