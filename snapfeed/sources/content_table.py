"""Content laid out by path, so that a join with a feed moves the feed only."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..balance import BROADCAST_BYTES, HASH_TABLE_BYTES, MIN_ROWS, balanced_join, bucket_of, measure
from .versions import Versions

# Content that one bucket should hold.
BUCKET_BYTES = 256 << 20
# Times this much content of one path is kept apart from the buckets.
REPEATED = 4

SCHEMA = "path string, content string"


class ContentTable:
    """``(path, content)`` in hash buckets of the path, below a folder.

    A join with a feed reads the buckets where they lie: only the feed is
    shuffled, into as many parts. The number of buckets is settled by the first
    write, from the content's bytes unless it is given. A path that repeats until
    its rows would fill several buckets is kept beside them and joined as any
    other table, so that no bucket grows with one path.

    Writes add to what is there and become visible when their job commits; two
    at a time should not be first writes. Rows without a path are not kept, as no
    file is without one.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self._state = Versions(spark, f"{self.path}/_buckets")

    def buckets(self) -> int:
        _, state = self._state.read()
        if state is None:
            raise ValueError(f"nothing was written to {self.path}")
        return state["buckets"]

    def write(self, content: DataFrame, buckets: int | None = None, bucket_bytes: int = BUCKET_BYTES) -> None:
        """Add rows. ``buckets`` counts with the first write only."""
        if buckets is not None and buckets < 1:
            raise ValueError(f"a table has one bucket at least: {buckets}")
        content = content.where("path is not null").select(F.col("path").cast("string"), F.col("content").cast("string"))
        size = F.coalesce(F.octet_length("content"), F.lit(0)) + F.octet_length("path")
        paths = content.groupBy("path").agg(F.sum(size).alias("bytes"), F.count("*").alias("n"))
        repeated = paths.where((F.col("n") > 1) & (F.col("bytes") > REPEATED * bucket_bytes)).select("path")
        total, many = paths.agg(F.sum("bytes"), F.max((F.col("n") > 1) & (F.col("bytes") > REPEATED * bucket_bytes))).first()
        wanted = buckets or max(1, -(-(total or 0) // bucket_bytes))
        self._state.change(lambda state: {"buckets": wanted} if state is None else None)
        bucketed = content.join(repeated, "path", "left_anti") if many else content
        bucketed.repartition(self.buckets(), "path").write.insertInto(self._table())
        apart = content.join(repeated, "path", "left_semi") if many else content.limit(0)
        apart.write.mode("append").parquet(f"{self.path}/repeated")

    def _table(self) -> str:
        """Name under which the session knows the buckets."""
        name = "snapfeed_content_" + hashlib.sha256(self.path.encode()).hexdigest()[:32]
        place = f"{self.path}/buckets".replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"create table if not exists {name} ({SCHEMA}) using parquet "
            f"clustered by (path) into {self.buckets()} buckets location '{place}'"
        )
        self.spark.catalog.refreshTable(name)
        return name

    def _parts(self) -> tuple[DataFrame, DataFrame]:
        return self.spark.table(self._table()), self.spark.read.schema(SCHEMA).parquet(f"{self.path}/repeated")

    def read(self) -> DataFrame:
        """All rows."""
        buckets, repeated = self._parts()
        return buckets.unionByName(repeated)

    def join(self, feed: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, min_rows: int = MIN_ROWS) -> DataFrame:
        """Rows of the feed with their content; those without any are left out.

        A feed that measures small enough is broadcast. Beyond that it is dealt
        out to the buckets. Paths that each hold more than a task's fair share of
        the feed (there are at most as many as tasks) go apart: their buckets
        alone are read again, and their rows spread over several tasks.
        """
        buckets, repeated = self._parts()
        size = measure(feed, ["path"], min_rows)
        if size.bytes <= broadcast_bytes and not size.heavy:
            return balanced_join(feed, buckets, "path", "inner", min_rows).unionByName(
                balanced_join(feed, repeated, "path", "inner", min_rows)
            )
        fits = size.bytes / self.buckets() <= HASH_TABLE_BYTES
        strategy = "shuffle_hash" if fits else "merge"
        hot = self._hot_paths(feed, size, min_rows) if size.heavy else []
        is_hot = F.col("path").isin(hot)
        cold = feed.where(~is_hot) if hot else feed
        joined = cold.hint(strategy).join(buckets, "path")
        if hot:
            again = balanced_join(feed.where(is_hot), buckets.where(is_hot), "path", "inner", min_rows)
            joined = joined.unionByName(again)
        return joined.unionByName(balanced_join(feed, repeated, "path", "inner", min_rows, broadcast_bytes))

    def _hot_paths(self, feed: DataFrame, size, min_rows: int) -> list[str]:
        share = max(min_rows, size.rows / size.tasks)
        heavy = feed.where(bucket_of(["path"]).isin(list(size.heavy)))
        counts = heavy.groupBy("path").count().where(F.col("count") > share)
        return [row.path for row in counts.where("path is not null").collect()]
