"""Table-shaped sources: target schemas, payload tables, incremental reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def target_schema(spark: SparkSession, table: str, registry: dict[str, T.StructType]) -> T.StructType:
    """Columns of a target in declared order, from the registry or the session."""
    if table in registry:
        return registry[table]
    if spark.catalog.tableExists(table):
        return spark.table(table).schema
    raise LookupError(f"no columns known for target {table}")


def parse_payload(df: DataFrame, schema: T.StructType, payload: str = "payload") -> DataFrame:
    """Payload text to typed columns of a fixed schema; the other columns stay.

    Parsed in a generator, so that later filters do not parse the text again.
    """
    others = [c for c in df.columns if c != payload]
    return df.select(*others, F.inline(F.array(F.from_json(payload, schema))))


def of_batches(df: DataFrame, batches: Sequence[str]) -> DataFrame:
    """Rows that one of the batches brought; the list skips Parquet row groups."""
    return df.where(F.col("etl_batch_id").isin(list(batches)))


def changed_since(
    df: DataFrame, mark: Column, updated: str = "updated_at", inclusive: bool = False
) -> DataFrame:
    """Rows updated after the mark, or at it; the bound skips Parquet row groups."""
    return df.where(F.col(updated) >= mark if inclusive else F.col(updated) > mark)
