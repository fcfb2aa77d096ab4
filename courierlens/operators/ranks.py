"""Exact ranks over a whole table, or over groups of any size, without putting either in one task.

A window over a table or a large group sorts it in one task. Here the rows are
range-partitioned by group and order, sorted inside their tasks and written
with their task and their place in it. How many rows of a group lie in earlier
tasks follows from one count per group and task, so a group that holds a third
of all rows is numbered by as many tasks as it fills, whatever the type of its
values. Nothing passes through the driver but the few values asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlens.operators.slices import whole
from courierlens.session import stage


def in_tasks(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows in order over all tasks, written with ``_task`` and ``_place``, both from zero.

    Once written the numbers stay, whatever becomes of executors. ``parts``
    sets the number of tasks; by default the session does.
    """
    spread = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = spread.sortWithinPartitions(*order)
    return stage(ordered.withColumns({"_task": F.spark_partition_id(), "_place": place}), "ordered")


def numbered(
    df: DataFrame, group: Sequence[str], order: Sequence[str], out: str, total: str | None = None, parts: int | None = None
) -> DataFrame:
    """1-based position of each row in its group, and on request the group's size; rows without a group are one."""
    placed = in_tasks(df, [*group, *order], parts).withColumn("_group", whole(*group))
    segments = placed.groupBy("_task", "_group").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    tasks = Window.partitionBy("_group").orderBy("_task")
    earlier = F.coalesce(F.sum("_rows").over(tasks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = segments.select(
        "_task", "_group", (earlier - F.col("_first") + 1).alias("_shift"), F.sum("_rows").over(Window.partitionBy("_group")).alias("_size")
    )
    joined = placed.join(offsets, ["_task", "_group"]).withColumn(out, F.col("_place") + F.col("_shift"))
    if total:
        joined = joined.withColumn(total, F.col("_size"))
    return joined.drop("_task", "_place", "_group", "_shift", "_size")


def values_at_ranks(rows: DataFrame, column: str, ranks: Sequence[int], parts: int | None = None) -> dict[int, float]:
    """Values at 1-based ranks of an ascending order; equal values are one row with a count before any sort."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    placed = in_tasks(counts, [column], parts)
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_task")
        .agg(F.sum("_rows").alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    so_far = Window.partitionBy("_task").orderBy("_place")
    upto = F.col("_before") + F.sum("_rows").over(so_far)
    # one row per task
    held = placed.join(F.broadcast(offsets), "_task").withColumn("_upto", upto)
    wanted = F.explode(F.filter(F.array(*map(F.lit, ranks)), lambda r: (r <= F.col("_upto")) & (r > F.col("_upto") - F.col("_rows"))))
    return {r["rank"]: r[column] for r in held.select(column, wanted.alias("rank")).collect()}


def quartiles(df: DataFrame, column: str, approx: bool = False) -> tuple[float | None, float | None]:
    """First and third quartile, linear between neighbours; missing values and NaN do not count."""
    shares = (0.25, 0.75)
    values = df.select(F.col(column).cast("double").alias("value")).filter(~F.isnan("value"))  # null fails it too
    if approx:
        found = values.agg(F.percentile_approx("value", list(shares), 10000).alias("q")).first()["q"]
        return (found[0], found[1]) if found else (None, None)
    total = values.count()
    if total == 0:
        return None, None
    positions = [(total - 1) * share for share in shares]
    ranks = sorted({int(at) + step for at in positions for step in (1, 2) if int(at) + step <= total})
    at_rank = values_at_ranks(values, "value", ranks)

    def between_neighbours(position: float) -> float:
        low = at_rank[int(position) + 1]
        high = at_rank.get(int(position) + 2, low)
        return low + (high - low) * (position - int(position))

    return between_neighbours(positions[0]), between_neighbours(positions[1])


def ntile_columns(
    df: DataFrame, group: str, tie: str, sorts: dict[str, tuple[str, bool]], tiles: int = 4, parts: int | None = None
) -> DataFrame:
    """Add ``ntile(tiles)`` columns, each ranking the rows of a group by one value and the tie column.

    ``sorts`` maps an output name to (value column, ascending). Missing values
    rank last when ascending and first when descending; equal ones go by the
    tie column, a missing tie first. The first ``n mod tiles`` tiles get one
    row more, as ``ntile`` does. Group and tie may have any type.
    """
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "tiled")

    def key(value: str, ascending: bool) -> list:
        number = F.col(value).cast("double")
        return [number.isNull() == F.lit(ascending), number if ascending else -number]

    sorted_by = [F.struct(F.lit(n).alias("_metric"), *[c.alias(a) for c, a in zip(key(*sorts[n]), ("_last", "_key"), strict=True)]) for n in sorts]
    long = rows.select("_row", group, tie, F.explode(F.array(*sorted_by)).alias("_m")).select("_row", group, tie, "_m.*")
    ranked = numbered(long, [group, "_metric"], ["_last", "_key", tie], "_n", "_total", parts)
    base, extra = F.floor(F.col("_total") / tiles), F.col("_total") % tiles
    inside = F.col("_n") <= extra * (base + 1)
    tile = F.when(inside, F.ceil(F.col("_n") / (base + 1))).otherwise(
        extra + F.ceil(F.try_divide(F.col("_n") - extra * (base + 1), base))
    )
    wide = ranked.groupBy("_row").agg(*[F.max(F.when(F.col("_metric") == n, tile)).cast("int").alias(n) for n in sorts])
    return rows.join(wide, "_row").drop("_row")
