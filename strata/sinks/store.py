"""Layer tables as folders of plain Parquet; each table has one writer at a time.

A table with ``buckets`` is partitioned by a bucket of its key.  A merge reads and overwrites the buckets
its batch hits and no others, by a dynamic partition overwrite: Spark writes the new buckets aside and
puts them in place when the job commits, so a failed job changes nothing.  Rows of one bucket leave the
merge's join in as many tasks as their size asks for (``TableDef.tasks``), none of which has rows of another
bucket.  Frames read before a merge must not be read after it.

Any other table is replaced as a whole: every refresh writes a new folder, and readers take the newest
that Spark has marked as finished.  Logs are appended to.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import discard, file_system, prepare

BUCKET = "bucket"
KEPT_VERSIONS = 1  # superseded ones of a refreshed table
TASK_BYTES = 64 << 20  # of a bucket's rows that one task should join, sort and write


@dataclass(frozen=True)
class TableDef:
    """A layer table: name, columns, declared key, physical layout."""

    schema_name: str
    table_name: str
    columns: T.StructType
    key: tuple[str, ...] = ()
    buckets: int = 0
    sort_by: tuple[str, ...] = ()

    @property
    def full_name(self) -> str:
        return f"{self.schema_name}.{self.table_name}"

    def declared(self, df: DataFrame) -> list[Column]:
        return [df[f.name].cast(f.dataType).alias(f.name) for f in self.columns]

    def bucket(self) -> Column:
        """Equal to the partition that ``repartition(buckets, *key)`` deals a row to."""
        return F.pmod(F.hash(*(F.col(k).cast(self.columns[k].dataType) for k in self.key)), F.lit(self.buckets))

    def sizes(self, *frames: DataFrame, held: dict[int, int] | None = None) -> dict[int, float]:
        """Bytes, about, of the rows that the frames have in each bucket, at most ``buckets`` numbers.

        The texts of the last frame are measured; rows of the others count as its average, as do those of
        ``held``, counted already.
        """
        texts = [f.name for f in self.columns if isinstance(f.dataType, T.StringType) and f.name in frames[-1].columns]
        row = F.lit(16.0 * len(self.columns))
        for name in texts:
            row = row + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
        each = [f.select(self.bucket().alias("_b"), (row if f is frames[-1] else F.lit(None).cast("double")).alias("_row")) for f in frames]
        found = reduce(DataFrame.unionByName, each).groupBy("_b").agg(F.count(F.lit(1)).alias("n"), F.avg("_row").alias("row"))
        rows = found.collect()
        most = max((r.row for r in rows if r.row is not None), default=0.0)
        counted = held or {}
        return {r["_b"]: r.n * (most if r.row is None else r.row) + counted.get(r["_b"], 0) * most for r in rows}

    def tasks(self, *frames: DataFrame) -> int:
        """How many partitions to deal the frames to by key, so that none has much more than ``TASK_BYTES``
        of them.  It is a multiple of ``buckets``, so all rows of a partition are of one bucket."""
        return self.parts(self.sizes(*frames))

    def parts(self, sizes: dict[int, float]) -> int:
        return self.buckets * max(1, math.ceil(max(sizes.values(), default=0.0) / TASK_BYTES))


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")

    def folder(self, table: TableDef) -> str:
        return f"{self.root}/{table.schema_name}/{table.table_name}"

    def archive_folder(self, table: TableDef, batch: str) -> str:
        return f"{self.root}/archive/batch_id={batch}/{table.schema_name}/{table.table_name}"

    def create_if_absent(self, table: TableDef) -> bool:
        """Set up an empty table; its declared columns are given on every read."""
        path, files = file_system(self.spark, self.folder(table))
        return not files.exists(path) and files.mkdirs(path)

    def read(self, table: TableDef) -> DataFrame:
        """The current rows, with the declared columns."""
        path, files = file_system(self.spark, self.folder(table))
        if not files.exists(path):
            raise LookupError(f"table {table.full_name} has not been set up")
        if table.buckets:
            return self._bucketed(table).drop(BUCKET)
        at = "/".join([self.folder(table), *self.versions(table)[-1:]])
        return self.spark.read.schema(table.columns).option("recursiveFileLookup", "true").parquet(at)

    def _bucketed(self, table: TableDef) -> DataFrame:
        columns = T.StructType([*table.columns, T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(columns).parquet(self.folder(table))

    def versions(self, table: TableDef) -> list[str]:
        """Finished versions of a refreshed table, oldest first."""
        marks, files = file_system(self.spark, f"{self.folder(table)}/v=*/_SUCCESS")
        return sorted(s.getPath().getParent().getName() for s in files.globStatus(marks) or [])

    def refresh(self, table: TableDef, df: DataFrame, batch: str) -> None:
        """Replace all rows (truncate and insert in one commit)."""
        if table.buckets:
            sizes = table.sizes(df)
            self._put(table, df.repartition(table.parts(sizes), *table.key))
            hit = {f"{BUCKET}={r[0]}" for r in self._bucketed(table).select(BUCKET).distinct().collect()}
            written = {f"{BUCKET}={b}" for b in sizes}
            gone = [f"{self.folder(table)}/{name}" for name in hit - written]
        else:
            old = self.versions(table)
            number = int(old[-1][2:].split("-")[0]) + 1 if old else 1
            rows = df.select(*table.declared(df))
            rows.write.mode("overwrite").parquet(f"{self.folder(table)}/v={number:06d}-{batch}")
            gone = [f"{self.folder(table)}/{v}" for v in old[: max(0, len(old) - KEPT_VERSIONS)]]
        for path in gone:
            discard(self.spark, path)

    def _put(self, table: TableDef, df: DataFrame) -> None:
        rows = df.select(*table.declared(df)).withColumn(BUCKET, table.bucket())
        rows = rows.sortWithinPartitions(BUCKET, *table.sort_by)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET).parquet(self.folder(table))

    def merge(
        self, table: TableDef, incoming: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], archive_as: str | None = None
    ) -> list[int]:
        """Overwrite the buckets that ``incoming`` hits with ``how(their rows, incoming)``; returns them.

        With ``archive_as``, the superseded rows of these buckets go to the archive of that batch first.
        """
        hit = sorted(r[0] for r in incoming.select(table.bucket()).distinct().collect())  # at most ``buckets`` numbers
        if hit:
            held = self._bucketed(table).where(F.col(BUCKET).isin(hit))
            if archive_as is not None:
                held.write.mode("overwrite").partitionBy(BUCKET).parquet(self.archive_folder(table, archive_as))
            self._put(table, how(held.drop(BUCKET), incoming))
        return hit

    def hit(self, table: TableDef, keys: DataFrame) -> list[int]:
        """The buckets that ``keys`` hits, at most ``buckets`` numbers."""
        return sorted(r[0] for r in keys.select(table.bucket()).distinct().collect())

    def rows_of(self, table: TableDef, buckets: list[int]) -> DataFrame:
        """The current rows of some buckets; no other bucket is read."""
        return self._bucketed(table).where(F.col(BUCKET).isin(buckets)).drop(BUCKET)

    def rows_of_buckets(self, table: TableDef, keys: DataFrame) -> DataFrame:
        """The current rows of the buckets that ``keys`` hits; no other bucket is read."""
        return self.rows_of(table, self.hit(table, keys))

    def prepare_buckets(
        self, table: TableDef, incoming: DataFrame, how: Callable[[DataFrame, DataFrame, int], DataFrame], path: str
    ) -> None:
        """Write ``how(held, incoming, tasks)`` to ``path``, by bucket, for ``replace_buckets``; the table is left as it
        is.  ``held`` are the rows of the buckets that ``incoming`` hits, ``tasks`` the partitions to deal both to by key."""
        counts = self._bucketed(table).groupBy(BUCKET).count().collect()  # at most ``buckets`` numbers
        sizes = table.sizes(incoming, held={r[BUCKET]: r["count"] for r in counts})
        rows = how(self.rows_of(table, list(sizes)), incoming, table.parts(sizes))
        rows.withColumn(BUCKET, table.bucket()).write.mode("overwrite").partitionBy(BUCKET).parquet(path)

    def replace_buckets(self, table: TableDef, path: str, prepared: DataFrame) -> None:
        """Overwrite the buckets written to ``path`` by their rows of ``prepared``, read from there; nothing is
        shuffled.  A bucket none of whose rows stay is emptied."""
        stay = {r[0] for r in prepared.select(BUCKET).distinct().collect()}  # at most ``buckets`` numbers
        rows = prepared.select(*table.declared(prepared), BUCKET)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.folder(table))
        for bucket in set(self.buckets_of(path)) - stay:
            discard(self.spark, f"{self.folder(table)}/{BUCKET}={bucket}")

    def buckets_of(self, path: str) -> list[int]:
        """The buckets that a folder written by bucket has."""
        names, files = file_system(self.spark, f"{path}/{BUCKET}=*")
        return sorted(int(s.getPath().getName().split("=")[1]) for s in files.globStatus(names) or [])

    def append(self, table: TableDef, df: DataFrame, key: str | None = None) -> None:
        """Add rows to a log, in a folder of their own.  Rows given under a ``key`` take the
        place of those given under it before: a load that is repeated adds nothing."""
        name = re.sub(r"\W", "_", key) if key else uuid.uuid4().hex
        df.select(*table.declared(df)).write.mode("overwrite").parquet(f"{self.folder(table)}/rows-{name}")
