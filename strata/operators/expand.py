"""Parent-to-child expansion over captured responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.filters import split_successful
from strata.operators.fold import top_n
from strata.operators.skew import left_join_many
from strata.sources.responses import unwrap_envelope


def expand_children(
    parents: DataFrame, responses: DataFrame, name: str, key: str = "id"
) -> DataFrame:
    """Entities inside the responses requested for each parent (inner, 1:N)."""
    hits = parents.select(F.col(key).alias("parent_id")).join(
        responses, F.col("parent_id") == F.col("request_key"), "inner"
    )
    return unwrap_envelope(hits, name)


def detail_ok(parents: DataFrame, responses: DataFrame, key: str = "id") -> DataFrame:
    """Detail response per parent; only status 200 survives."""
    good, _ = split_successful(responses)
    return parents.join(good, F.col(key) == F.col("request_key"), "inner")


def detail_keep_errors(parents: DataFrame, responses: DataFrame, key: str = "id") -> DataFrame:
    """Detail response per parent, error bodies kept, parents without one too."""
    return left_join_many(parents, responses, key, "request_key")


def best_matches(rows: DataFrame, request: Sequence[str], rank: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` results per request key."""
    return top_n(rows, request, rank, n)
