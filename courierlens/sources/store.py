"""Prediction tables in versions: a commit is seen as a whole or not at all.

All tables lie in one folder, in parts by table and by hash of the order id:
``version=3/table=reach_date_prediction/bucket=7``. A commit is one Spark job
that writes only the parts it changes, as a new version; a part's newest
committed version holds all its rows. Spark's committer creates the file
``_SUCCESS`` of a version last, and readers look at versions that have it, so
a reader never sees a half-written commit and keeps what it has listed while
the next one is written. There may be many readers and one writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierlens.contracts import EVENT_SHAPES, prediction_schema, table_of

STORED = "prediction_id long, order_id string, date timestamp, date_l timestamp, latitude double, longitude double, predictedat timestamp"
COLUMNS = [column.split()[0] for column in STORED.split(", ")]
Part = tuple[str, int]


class PredictionStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def bucket(self, order_id: str = "order_id") -> Column:
        return F.pmod(F.xxhash64(order_id), F.lit(self.buckets)).cast("int")

    def _listed(self, pattern: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return [str(status.getPath()) for status in found or []]

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return sorted(int(re.search(r"version=(\d+)/", p)[1]) for p in self._listed("version=*/_SUCCESS"))

    def parts(self, version: int | None = None) -> dict[Part, str]:
        """Folder of each part's rows as of a version, by default the newest; at most tables times buckets."""
        committed = {v for v in self.versions() if version is None or v <= version}
        newest: dict[Part, tuple[int, str]] = {}
        for path in self._listed("version=*/table=*/bucket=*"):
            at, table, bucket = re.search(r"version=(\d+)/table=([^/]+)/bucket=(\d+)", path).groups()
            if int(at) in committed:
                key = (table, int(bucket))
                newest[key] = max(newest.get(key, (0, "")), (int(at), path))
        return {key: path for key, (_, path) in newest.items()}

    def read(
        self, tables: Collection[str] | None = None, parts: Iterable[Part] | None = None, version: int | None = None
    ) -> DataFrame:
        """Rows with ``table`` and ``bucket``, of all tables or of some, or of some parts only."""
        wanted = None if parts is None else set(parts)
        paths = [
            path
            for key, path in sorted(self.parts(version).items())
            if (tables is None or key[0] in tables) and (wanted is None or key in wanted)
        ]
        schema = f"{STORED}, version long, table string, bucket int"
        if not paths:
            return self.spark.createDataFrame([], schema).drop("version")
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths).drop("version")

    def table(self, event: str, domain_type: int, version: int | None = None) -> DataFrame:
        """One prediction table under the column names of its contract."""
        name, shape = table_of(event, domain_type)
        date, date_l = EVENT_SHAPES[shape]
        rows = self.read([name], version=version).withColumnsRenamed({"date": date, "date_l": date_l})
        return rows.select(*prediction_schema(shape).names)

    def commit(self, rows: DataFrame) -> int:
        """Write all rows of the parts that ``rows`` has as the next version, in one job; a part never gets empty.

        ``rows`` may be made from this store: what it reads stays as it is.
        """
        taken = [int(re.search(r"version=(\d+)", p)[1]) for p in self._listed("version=*")]
        version = max(taken, default=0) + 1
        whole = rows.select(*[F.col(f.name).cast(f.dataType) for f in T._parse_datatype_string(STORED).fields], "table", "bucket")
        spread = whole.repartition("table", "bucket")
        spread.write.partitionBy("table", "bucket").parquet(f"{self.path}/version={version}")
        return version
