"""Time slices that hold no more rows than a task should sort.

A slice of fixed width is as large as its key is dense: many pings in a second,
or all the points without a time, are one slice. Here slices with too many rows
are cut further, at exact ranks of the order the windows use, so ties are cut
too. Where no slice is crowded, which one count of the keys and times tells,
the rows come back as they are and nothing is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.operators.ranks import numbered
from courierlens.operators.slices import SLICE, whole, with_slice
from courierlens.session import stage

# room for the parts of a slice behind its number; rows without a time come after all others
PARTS = 1 << 20
LAST_NUMBER = 1 << 42


def even_slices(df: DataFrame, key: Sequence[str], order: Sequence[str], seconds: int, most: int | None) -> DataFrame:
    """Add slices of a key by ``order``, whose first column is the time, with at most ``most`` rows each.

    The slice stays a monotone number within the key, as the windows of
    ``operators.slices`` need it. ``most`` None keeps slices of plain width.
    Only the rows of crowded slices are written and sorted, over as many tasks
    as they fill; all others are read on.
    """
    sliced = with_slice(df, order[0], seconds)
    if most is None:
        return sliced
    counts = sliced.groupBy(whole(*key).alias("_key"), SLICE).agg(F.count(F.lit(1)).alias("_rows"))
    crowded = counts.filter(F.col("_rows") > most).select("_key", F.col(SLICE).alias("_slice"))
    if crowded.isEmpty():
        return sliced
    crowded = stage(crowded, "crowded")
    mine = (F.col("_key") == whole(*key)) & (F.col("_slice") == F.col(SLICE))
    # equal rows need a number of their own that stays, so it is written with them
    dense = stage(sliced.join(crowded, mine, "left_semi").withColumn("_row", F.monotonically_increasing_id()), "dense")
    ranked = numbered(dense, [*key, SLICE], [*[F.col(c).asc_nulls_last() for c in order], "_row"], "_rank")
    number = F.least(F.col(SLICE), F.lit(LAST_NUMBER)) * PARTS
    part = F.floor((F.col("_rank") - 1) / most)
    cut = ranked.withColumn(SLICE, number + part).drop("_row", "_rank")
    return sliced.join(crowded, mine, "left_anti").withColumn(SLICE, number).unionByName(cut)
