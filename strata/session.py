"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated key inside one JSON object keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Hot join keys are split at run time from the measured shuffle sizes, also
    # where the split costs a further shuffle downstream.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Zoned times get Parquet statistics, which the default INT96 form has not.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Partitions that a load deals its scan to before costly work per row; unset: as scanned.
SCAN_PARTITIONS = "strata.scan.partitions"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators rely on."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Folder all executors share, named by the cluster in spark.checkpoint.dir.

    Where that is unset, a folder in the warehouse.  Off a local master that must not be a folder of
    one machine's file system, which is what the warehouse is by default: then it raises.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        _, files = file_system(spark, warehouse)
        if files.getScheme() == "file":
            raise ValueError(f"executors do not share {warehouse}: name a shared folder in spark.checkpoint.dir")
    return warehouse + "/_strata_work"


def spread(scan: DataFrame) -> DataFrame:
    """Deal a scan to the session's ``strata.scan.partitions`` partitions, for costly
    work per row over few splits.  Without that setting the scan is left as it is."""
    n = scan.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return scan.repartition(int(n)) if n else scan


def work_path(spark: SparkSession, label: str) -> str:
    """A new path in the work folder."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back.

    Cuts lineage with a written table: it outlives a lost executor, and every
    later pass sees exactly the same rows and the same generated values.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system) for small driver-side file work."""
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle, handle.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def discard(spark: SparkSession, path: str) -> None:
    """Delete a settled table that nothing reads any more."""
    handle, files = file_system(spark, path)
    files.delete(handle, True)
