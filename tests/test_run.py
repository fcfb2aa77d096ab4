"""Publishing predictions in versions, the nightly correction, and what makes them cheap."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from traces import at

from courierlens import contracts
from courierlens.catalog.fixtures import END, START, fixtures
from courierlens.operators import tables
from courierlens.operators.reducer import keep_possible, mark_possible
from courierlens.plans import pipelines as pl
from courierlens.plans import run
from courierlens.sources import orders as so
from courierlens.sources.store import PredictionStore

MADE = "domain_type int, event string, _id_oid string, time timestamp, time_l timestamp, lat double, lon double"


def made(spark, rows):
    return spark.createDataFrame([(d, e, o, None if t is None else at(t), None, 1.0, 2.0) for d, e, o, t in rows], MADE)


def said(store, event, domain_type):
    rows = store.table(event, domain_type)
    return sorted((r[1], None if r[2] is None else r[2].timestamp()) for r in rows.collect())


@pytest.fixture
def store(spark, tmp_path):
    return PredictionStore(spark, str(tmp_path / "store"), buckets=4)


def test_every_table_is_reached_by_one_write(spark, store):
    pairs = list(contracts.PREDICTION_TABLES)
    version = run.publish(store, made(spark, [(d, e, f"o{i}", i * 1_000_000) for i, (e, d) in enumerate(pairs)]))
    assert version == 1 and store.versions() == [1]
    for i, (event, domain_type) in enumerate(pairs):
        assert said(store, event, domain_type) == [(f"o{i}", float(i) + at(0).timestamp())]
        assert store.table(event, domain_type).columns == contracts.prediction_schema(contracts.table_of(event, domain_type)[1]).names
    with pytest.raises(Exception, match="no table for deliver 2"):
        run.publish(store, made(spark, [(2, "deliver", "x", 0)]))
    assert store.versions() == [1]


def test_newest_row_stays_where_tables_are_deduplicated(spark, store):
    rows = [(3, "reach", "a", 1), (1, "reach", "b", 1), (6, "depart_from_merchant", "a", 1), (6, "depart_from_merchant", "b", None)]
    run.publish(store, made(spark, rows))
    first = {(e, d): said(store, e, d) for e, d in contracts.PREDICTION_TABLES}
    run.publish(store, made(spark, rows))
    # saying it again changes nothing
    assert {(e, d): said(store, e, d) for e, d in contracts.PREDICTION_TABLES} == first
    run.publish(store, made(spark, [(1, "reach", "a", None), (6, "depart_from_merchant", "a", 2_000_000)]))
    assert said(store, "reach", 1)[0] == ("a", None)
    assert [o for o, _ in said(store, "depart_from_merchant", 6)] == ["a", "a", "b"]
    # older versions can still be read
    assert store.table("reach", 1, version=1).filter("predicted_reach_date is null").count() == 0
    assert run.publish(store, made(spark, [])) is None


def test_unfinished_commits_are_not_seen(spark, store):
    run.publish(store, made(spark, [(1, "reach", "a", 1)]))
    reader = store.read()
    run.publish(store, made(spark, [(1, "reach", "a", 5)]))
    os.remove(f"{store.path}/version=2/_SUCCESS")
    assert store.versions() == [1] and len(said(store, "reach", 1)) == 1
    assert run.publish(store, made(spark, [(1, "reach", "a", 9_000_000)])) == 3
    assert said(store, "reach", 1) == [("a", at(9_000_000).timestamp())]
    # a frame read before goes on as it was
    assert [r["date"].timestamp() for r in reader.collect()] == [at(1).timestamp()]


def test_only_touched_parts_are_read_and_written(spark, store):
    run.publish(store, made(spark, [(1, "reach", f"o{i}", i) for i in range(200)] + [(1, "depart", "o1", 1)]))
    before = store.parts()
    assert len(before) == 5
    run.publish(store, made(spark, [(1, "reach", "o7", 99)]))
    changed = {key for key, path in store.parts().items() if path != before[key]}
    assert len(changed) == 1
    files = store.read(parts=changed).inputFiles()
    assert all(any(f"/table={t}/bucket={b}/" in f for t, b in changed) for f in files)
    assert store.read().filter("table = 'reach_date_prediction'").count() == 200


def test_ids_have_no_gaps(spark, store):
    for start in range(0, 300, 100):
        run.publish(store, made(spark, [(1, "reach", f"o{i:03}", i) for i in range(start, start + 100)]).repartition(7))
    rows = store.table("reach", 1).orderBy("prediction_id").collect()
    assert [r["prediction_id"] for r in rows] == list(range(300))
    assert [r["order_id"] for r in rows] == [f"o{i:03}" for i in range(300)]
    numbered = tables.dense_ids(spark.range(1000).repartition(9), ["id"], "n", 5)
    assert numbered.filter("n <> id + 5").count() == 0 and numbered.count() == 1000
    assert tables.dense_ids(spark.range(0), ["id"], "n").count() == 0


def test_a_window_again_changes_nothing(spark, store):
    fx = fixtures(spark, "/root/testdata/sf0.001")
    events = ["reach", "reach_to_merchant"]
    run.publish_run(store, fx.inputs(), [(START, END)], events, [1, 2])
    keys = [("reach", 1), ("reach_to_merchant", 2)]
    first = {key: said(store, *key) for key in keys}
    assert first["reach", 1] and first["reach_to_merchant", 2]
    run.publish_run(store, fx.inputs(), [(START, END)], events, [1, 2])
    assert {key: said(store, *key) for key in keys} == first
    assert run.water_table(["depart_from_client", "depart_from_client"])[0] == "depart_from_client"
    assert run.water_table(["reach", "depart_from_client"]) == ("depart", "predicted_depart_date")


def test_correction_writes_only_the_parts_of_corrected_orders(spark, store):
    orders = spark.createDataFrame(
        [("a", "j", 1), ("b", "j", 2), ("c", None, 3), ("d", None, 1), ("e", "k", 1)],
        "_id_oid string, delivery_job_oid string, delivery_batch_index int",
    ).withColumns({"status": F.lit(900), "domaintype": F.lit(1), "deliver_date": F.lit(at(0)).cast("timestamp")})
    window = (str(at(0).replace(tzinfo=None)), str(at(10).replace(tzinfo=None)))
    assert run.nightly_correction(store, orders, *window) is None
    times = {"a": 1_000_000, "b": 5_000_000, "c": 7_000_000, "d": 2_000_000, "e": 3_000_000}
    run.publish(store, made(spark, [(1, "depart", o, t) for o, t in times.items()] + [(1, "depart", f"x{i}", i) for i in range(40)]))
    before = store.parts()
    assert run.nightly_correction(store, orders, *window) == 2
    wanted = times | {"a": 5_000_000, "d": 7_000_000}
    assert {o: t for o, t in said(store, "depart", 1) if o in times} == {o: at(t).timestamp() for o, t in wanted.items()}
    changed = {key for key, path in store.parts().items() if path != before[key]}
    assert 1 <= len(changed) <= 2 and store.read().count() == 45
    assert run.nightly_correction(store, orders, *window) is None
    # each order without a job on its own: only the named job is aligned
    loose = tables.batch_corrections(orders, tables.conform_to_contract(store.table("depart", 1, version=1), "depart"), *window, jobless_together=False)
    assert [r["order_id"] for r in loose.collect()] == ["a"]


def test_orders_without_a_job_are_no_join_key(spark):
    base = spark.createDataFrame(
        [("a", "j", 1, 100, 1), ("b", "j", 2, 200, 9), ("c", None, 1, 100, 3), ("d", None, 2, 8_000_000_000, 7)],
        "_id_oid string, delivery_job_oid string, delivery_batch_index int, d long, o long",
    ).withColumns(
        {"deliver_date": F.timestamp_micros("d"), "onway_date": F.timestamp_micros("o"), "status": F.lit(900), "domaintype": F.lit(1), "country_oid": F.lit("1")}
    )
    orders = base.withColumns({c: F.lit(None).cast("timestamp") for c in so.MARKET_COLUMNS if c not in base.columns})
    zones = spark.createDataFrame([("1", "UTC")], contracts.TIME_ZONES)

    def found(**flags):
        rows = so.market_orders(orders, zones, "1970-01-01 00:00:00", "1970-01-01 02:00:00", **flags)
        return sorted((r["_id_oid"], r["o"]) for r in rows.select("_id_oid", F.unix_micros("onway_date").alias("o")).collect())

    # together they were delivered too late, on its own one was not
    assert found() == [("a", 9), ("b", 9)]
    assert found(jobless_together=False) == [("a", 9), ("b", 9), ("c", 3)]
    plan = so.market_orders(orders, zones, "1970-01-01 00:00:00", "1970-01-01 02:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "coalesce(delivery_job_oid" not in "\n".join(line for line in plan.splitlines() if "SortMergeJoin" in line)


def test_reducer_never_misses(spark):
    rows = spark.range(4000).select(F.concat(F.lit("o"), "id").alias("key"), "id")
    ids = rows.filter("id % 9 = 0").select("key")
    marked = mark_possible(rows.unionByName(spark.sql("select cast(null as string) as key, -1L as id")), "key", ids, "m", slots=1 << 16)
    assert marked.filter("id % 9 = 0 and not m").count() == 0
    assert marked.filter("id % 9 <> 0 and m").count() < 200
    assert marked.count() == 4001 and marked.filter("m is null").count() == 0
    assert keep_possible(rows, {"key": ids.limit(0)}).count() == 0
    two = keep_possible(rows.withColumn("other", F.concat(F.lit("o"), (F.col("id") + 1).cast("string"))), {"key": ids, "other": ids})
    assert 800 <= two.count() < 1200


def test_log_and_points_see_wanted_orders_only(spark):
    fx = fixtures(spark, "/root/testdata/sf0.001")
    plan = pl.orders_of(fx.inputs(), 2, START, END)._jdf.queryExecution().executedPlan().toString()
    log = [line for line in plan.splitlines() if "_possible_0" in line or "bit_or" in line]
    assert log, "the status log is filtered before its grouping"
    pivot = plan.index("max(CASE WHEN (data_method")
    assert "_own_word" in plan[pivot:] or "_bits" in plan[pivot:]
