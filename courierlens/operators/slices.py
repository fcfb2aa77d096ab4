"""Windows over keys of any size.

A window over one key runs in one task, however many rows the key has. Here a
key is cut into time slices first: windows run inside ``(key, slice)``, each
slice is summed up in one row, the few summary rows of a key are linked in
time order, and what a slice needs from its neighbours comes back through an
equi-join on ``(key, slice)``. A key that holds a third of all rows is spread
over as many tasks as it has slices, and the result is the same as that of the
plain window.

The row side and the summary side read the same shuffle when the input was
shuffled by ``by_slice``: Spark finds the equal exchange and runs it once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SLICE = "slice"
LAST_SLICE = 2**63 - 1


def with_slice(df: DataFrame, time: str, seconds: int) -> DataFrame:
    """Add the slice number; a monotone function of time, so ties share a slice."""
    micros = seconds * 1_000_000
    number = F.floor(F.unix_micros(F.col(time)) / F.lit(micros))
    return df.withColumn(SLICE, F.coalesce(number, F.lit(LAST_SLICE)))


def heavy_keys(df: DataFrame, key: str, rows: int) -> DataFrame:
    """All keys with more than ``rows`` rows; how they are joined is left to the adaptive planner."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > rows).select(key)


def whole(*columns: str) -> Column:
    """A key that is never missing: rows whose columns are null form one group, in windows and joins alike.

    Fields inside a struct compare null as equal to null, and the struct itself
    is not null, so an equi-join on it loses no row.
    """
    return F.struct(*columns)


def slice_heavy_keys(df: DataFrame, key: str, time: str, seconds: int, heavy: DataFrame) -> DataFrame:
    """Add slices to the rows of heavy keys only; any other key is one slice.

    Worth its counting pass where most keys have few rows over a long time.
    """
    marked = df.join(heavy.withColumn("_heavy", F.lit(True)), key, "left")
    sliced = with_slice(marked, time, seconds)
    return sliced.withColumn(SLICE, F.when(F.col("_heavy"), F.col(SLICE)).otherwise(F.lit(0))).drop("_heavy")


def by_slice(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Shuffle by (key, slice); repeated rows stay, as each is a point of its own."""
    return df.repartition(*key, SLICE)


def in_slice(key: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*key, SLICE).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def running(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def position(order: Sequence[str]) -> Column:
    """Orderable position of a row, for min_by and max_by."""
    return F.struct(*[F.col(c) for c in order])


def link(
    df: DataFrame,
    key: Sequence[str],
    summary: Sequence[Column],
    linked: Callable[[DataFrame, WindowSpec], DataFrame],
) -> DataFrame:
    """Join to every row what its slice needs from the other slices of the key.

    ``summary`` are aggregates per slice. ``linked`` gets the summary rows and
    the window over the slices of a key; its new columns reach the rows. Where
    a key may be null, pass ``whole(key)`` in its place.
    """
    window = Window.partitionBy(*key).orderBy(SLICE)
    slices = df.groupBy(*key, SLICE).agg(*summary)
    kept = set(slices.columns) - {*key, SLICE}
    return df.join(linked(slices, window).drop(*kept), [*key, SLICE])


def forward_fill(df: DataFrame, key: Sequence[str], order: Sequence[str], fills: dict[str, str]) -> DataFrame:
    """Last known values of the key up to and including the row; ``fills`` maps a column to its filled name.

    All columns are filled behind one shuffle. The window comes before the
    join, whose sort order it then serves too.
    """
    so_far = running(in_slice(key, order))
    local = df.withColumns({f"_local_{v}": F.last(v, ignorenulls=True).over(so_far) for v in fills})

    def tail(value: str) -> Column:
        known_at = F.when(F.col(value).isNotNull(), position(order))
        return F.max_by(F.col(value), known_at).alias(f"_tail_{value}")

    def heads(s: DataFrame, w: WindowSpec) -> DataFrame:
        earlier = before(w)
        return s.withColumns({f"_head_{v}": F.last(f"_tail_{v}", ignorenulls=True).over(earlier) for v in fills})

    linked = link(local, key, [tail(v) for v in fills], heads)
    filled = linked.withColumns({out: F.coalesce(f"_local_{v}", f"_head_{v}") for v, out in fills.items()})
    return filled.drop(*[f"{part}_{v}" for v in fills for part in ("_local", "_head")])


def number_rows(
    df: DataFrame, key: Sequence[str], order: Sequence[str], out: str, total: str | None = None
) -> DataFrame:
    """1-based position of a row within its key, and on request the size of the key."""

    def offsets(s: DataFrame, w: WindowSpec) -> DataFrame:
        s = s.withColumn("_before", F.coalesce(F.sum("_rows").over(before(w)), F.lit(0)))
        return s.withColumn(total, F.sum("_rows").over(Window.partitionBy(*key))) if total else s

    local = df.withColumn("_place", F.row_number().over(in_slice(key, order)))
    numbered = link(local, key, [F.count(F.lit(1)).alias("_rows")], offsets)
    return numbered.withColumn(out, (F.col("_place") + F.col("_before")).cast("long")).drop("_before", "_place")


def next_in_key(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """``value``, which is never missing, of the following row of the key."""
    local = df.withColumn("_next", F.lead(value).over(in_slice(key, order)))
    linked = link(
        local,
        key,
        [F.min_by(F.col(value), position(order)).alias("_first")],
        lambda s, w: s.withColumn("_following", F.lead("_first").over(w)),
    )
    return linked.withColumn(out, F.coalesce("_next", "_following")).drop("_next", "_following")
