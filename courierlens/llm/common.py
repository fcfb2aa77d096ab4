"""What several operators of this package share: inputs, staging, folds, words and links."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.session import shared_dir

#: Rows of one Arrow batch. Texts may be long, so a batch is kept well below Spark's default of 10,000 rows.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the session's Arrow batches are made small enough for whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; null without an id."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def bucket(columns: list[str], buckets: int) -> Column:
    """Even, repeatable dealing of rows into ``buckets`` groups by their values."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets))


def maybe_among(rows: DataFrame, ids: DataFrame, key: str, out: str, slots: int = 1 << 24) -> DataFrame:
    """Add whether a row's ``key`` may be among ``ids``: never false for one that is, seldom true for others.

    The ids set bits of a bitmap of fixed size, two megabytes by default, which
    is what is broadcast; so rows that need no join with ``ids`` are known
    without a shuffle. The more ids, the more often the answer is true.
    """

    def slot(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(slots)) + 1

    maps = ids.groupBy(F.bitmap_bucket_number(slot(key)).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot(key))).alias("_bits")
    )
    joined = rows.join(F.broadcast(maps), F.bitmap_bucket_number(slot(key)) == F.col("_bucket"), "left")
    at = F.bitmap_bit_position(slot(key))
    byte = F.conv(F.hex(F.col("_bits").substr((at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    set_bit = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0
    return joined.withColumn(out, F.coalesce(set_bit, F.lit(False))).drop("_bucket", "_bits")


class Cache(dict):
    """Values by word, made on first use; emptied when it holds ``most`` words, which bounds a worker's memory."""

    def __init__(self, make: Callable[[str], object], most: int = 400_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word: str) -> object:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.make(word)
        return value


def one_each(items: Iterator, worker: Callable) -> Iterator:
    for item in items:
        yield worker(item)


def connected(links: DataFrame, name: str = "components") -> DataFrame:
    """Components of undirected ``links`` (a, b): rows (id, component), component the smallest id reachable.

    Ids without a link are not returned. Rounds of two joins: every id takes the
    smallest label among its neighbours, then labels are replaced by the label
    of their label (pointer jumping), so a chain of n ids needs about log n
    rounds. Each round is written to the shared folder; only a count of changed
    rows reaches the driver.
    """
    both = written(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{name}-links",
    )
    labels = written(
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")),
        name,
    )
    while True:
        seen = both.join(labels.select(F.col("id").alias("b"), "component"), "b")
        lowest = seen.groupBy("a").agg(F.min("component").alias("near"))
        # an id hooks its label to the lowest label near it, so whole trees move, not only the id
        moved = labels.join(lowest, F.col("id") == F.col("a")).select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("new")
        )
        hooks = moved.filter("new < old").groupBy(F.col("old").alias("root")).agg(F.min("new").alias("to"))
        step = moved.join(hooks, F.col("old") == F.col("root"), "left").select(
            "id", "old", F.least("new", F.coalesce("to", "new")).alias("mid")
        )
        jump = step.select(F.col("id").alias("mid"), F.col("mid").alias("far"))
        changed = written(
            step.join(jump, "mid", "left").select("id", "old", F.least("mid", F.coalesce("far", "mid")).alias("component")),
            name,
        )
        labels = changed.select("id", "component")
        if changed.filter("component < old").limit(1).count() == 0:
            return labels
