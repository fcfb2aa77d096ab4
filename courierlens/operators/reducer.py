"""A filter of fixed size in front of a join: which rows can have a partner at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter; with 64 to a word it is at most 262,144 rows of two longs, whatever the number of ids.
SLOTS = 1 << 24


def _slot(key: str, slots: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(slots))


def mark_possible(rows: DataFrame, key: str, ids: DataFrame, out: str, slots: int = SLOTS) -> DataFrame:
    """Add whether ``key`` may be among ``ids`` (one column): true for all that are, seldom for others.

    The ids set one bit each in words of 64 bits. These are what is broadcast,
    so no row of a large table is shuffled to learn that it has no partner.
    The more ids, the more often the answer is true; it is never wrongly false.
    """
    listed = ids.select(F.col(ids.columns[0]).alias("_id")).filter(F.col("_id").isNotNull())
    at = _slot("_id", slots)
    words = listed.groupBy((at / 64).cast("long").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pmod(xxhash64(cast(_id as string)), 64) as int))")).alias("_bits")
    )
    mine = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(64)).cast("int")
    marked = rows.withColumn("_own_word", (_slot(key, slots) / 64).cast("long")).join(
        F.broadcast(words), F.col("_own_word") == F.col("_word"), "left"
    )
    hit = F.col(key).isNotNull() & (F.getbit(F.coalesce("_bits", F.lit(0).cast("long")), mine) == 1)
    return marked.withColumn(out, hit).drop("_own_word", "_word", "_bits")


def keep_possible(rows: DataFrame, keys: dict[str, DataFrame], slots: int = SLOTS) -> DataFrame:
    """Rows of which at least one key may be among its ids; the exact join is still to come."""
    marks = [f"_possible_{i}" for i in range(len(keys))]
    for mark, (key, ids) in zip(marks, keys.items(), strict=True):
        rows = mark_possible(rows, key, ids, mark, slots)
    return rows.filter(" or ".join(marks)).drop(*marks)
