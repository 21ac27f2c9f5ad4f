"""Captured API responses: (run_id, endpoint, request_key, ord, status_code, body)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import payload as P
from strata.schemas import RESPONSE


def read_responses(spark: SparkSession, path: str, endpoint: str | None = None) -> DataFrame:
    """JSON-Lines capture, schema fixed; one endpoint on request."""
    rows = spark.read.schema(RESPONSE).json(path)
    return rows if endpoint is None else rows.where(F.col("endpoint") == endpoint)


def envelope_items(body: Column, name: str) -> Column:
    """Element texts of the named array of a response body; NULL when missing."""
    items = F.try_variant_get(P.whole_json(body), f"$.{name}", "array<variant>")
    return F.transform(items, lambda x: F.to_json(x))


def unwrap_envelope(responses: DataFrame, name: str, body: str = "body") -> DataFrame:
    """One row per entity in the body; a body without the array gives none."""
    others = [c for c in responses.columns if c != body]
    return responses.select(
        *others, F.posexplode(envelope_items(F.col(body), name)).alias("pos", "element")
    )


def split_strict_envelope(
    responses: DataFrame, name: str, body: str = "body"
) -> tuple[DataFrame, DataFrame]:
    """Strict variant: (entities, responses whose body lacks the array)."""
    missing = responses.where(envelope_items(F.col(body), name).isNull())
    return unwrap_envelope(responses, name, body), missing.withColumn(
        "reject_reason", F.lit(f"no {name} in body")
    )


def concat_all(first: DataFrame, *more: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept; missing columns become NULL."""
    for df in more:
        first = first.unionByName(df, allowMissingColumns=True)
    return first
