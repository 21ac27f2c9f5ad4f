"""Reconciliation by content: which keys differ between two tables, and in which columns.

Equal counts say nothing about values.  Both tables are reduced to digests that do not depend on the order of
rows: per bucket of keys the number of rows and the sums of two 64-bit hashes of each row, in 32-bit halves.
Only rows of buckets whose digests differ are cut into finer cells, and only rows of cells that differ are
grouped by key.  Two equal tables therefore shuffle a few numbers per bucket and input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.deltas import signed

BUCKETS = 4096  # at each of both levels; the differing ones of the first are broadcast
MISSING, EXTRA, CHANGED, REPEATED = "missing", "extra", "changed", "repeated"
_HALF = 0xFFFFFFFF


def _hash(seed: int, columns: Sequence[Column]) -> Column:
    """64 bits that tell NULL from any value, whichever column holds it."""
    return F.xxhash64(F.lit(seed), *columns, *(c.isNull() for c in columns))


def _halves(name: str, value: Column) -> list[Column]:
    """Two columns whose sums stay exact up to 2^31 rows a group."""
    return [value.bitwiseAND(F.lit(_HALF)).alias(f"{name}_lo"), F.shiftrightunsigned(value, 32).alias(f"{name}_hi")]


def _key_hash(keys: Sequence[str]) -> Column:
    return _hash(3, [F.col(k) for k in keys])


def _marked(rows: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int) -> DataFrame:
    """Keys and values with their bucket and cell."""
    at = F.pmod(_key_hash(keys), F.lit(buckets * buckets))
    return rows.select(
        *keys, *values, F.floor(at / buckets).cast("int").alias("_bucket"), F.pmod(at, F.lit(buckets)).cast("int").alias("_cell")
    )


def _differing(source: DataFrame, target: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Groups whose bags of rows differ; each side moves one row per group and partition."""

    def digests(rows: DataFrame) -> DataFrame:
        hashes = [c for seed in (1, 2) for c in _halves(f"_h{seed}", _hash(seed, [F.col(c) for c in columns]))]
        return rows.select(*by, F.lit(1).cast("long").alias("_n"), *hashes)

    sums = ["_n", "_h1_lo", "_h1_hi", "_h2_lo", "_h2_hi"]
    return signed(digests(source), digests(target), by, sums).select(*by)


def content_differences(
    source: DataFrame, target: DataFrame, keys: Sequence[str], values: Sequence[str] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """One row per key whose rows differ: keys, source_rows, target_rows, verdict, changed_columns.

    The verdict is ``missing`` (not in the target), ``extra`` (not in the source), ``repeated`` (other numbers
    of rows) or ``changed``.  ``changed_columns`` names, in order, the columns whose values differ as bags
    within the key; it is empty unless ``changed``, and stays empty there where the same values are paired
    in another way over several rows of a key.  NULL keys are a key like any other, NULL differs from every value,
    equal rows count as often as they stand, and two empty tables do not differ.  ``values``: all other
    columns of the source when not given; both tables must have them in the same types.
    """
    values = [c for c in source.columns if c not in keys] if values is None else list(values)
    columns = [*keys, *values]
    a, b = (_marked(rows, keys, values, buckets) for rows in (source, target))
    wide = F.broadcast(_differing(a, b, ["_bucket"], columns))  # at most ``buckets`` rows
    a, b = (rows.join(wide, "_bucket", "left_semi") for rows in (a, b))
    cells = _differing(a, b, ["_bucket", "_cell"], columns)
    a, b = (rows.join(cells, ["_bucket", "_cell"], "left_semi") for rows in (a, b))

    def tagged(rows: DataFrame, sign: int) -> DataFrame:
        hashes = [h for i, c in enumerate([None, *values]) for h in _halves(f"_v{i}", _hash(1, [F.col(x) for x in ([c] if c else columns)]))]
        again = _halves("_w", _hash(2, [F.col(c) for c in columns]))
        side = [F.lit(int(sign == s)).cast("long").alias(n) for s, n in ((1, "source_rows"), (-1, "target_rows"))]
        rows = rows.select(*keys, *side, *hashes, *again)
        sums = [c for c in rows.columns if c.startswith(("_v", "_w"))]
        return rows.select(*keys, "source_rows", "target_rows", *((F.col(c) * sign).alias(c) for c in sums))

    both = tagged(a, 1).unionByName(tagged(b, -1))
    sums = [c for c in both.columns if c not in keys]
    per_key = both.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))

    def moved(name: str) -> Column:
        return (F.col(f"{name}_lo") != 0) | (F.col(f"{name}_hi") != 0)

    verdict = (
        F.when(F.col("target_rows") == 0, MISSING)
        .when(F.col("source_rows") == 0, EXTRA)
        .when(F.col("source_rows") != F.col("target_rows"), REPEATED)
        .otherwise(CHANGED)
    )
    names = F.array_compact(F.array(*(F.when(moved(f"_v{i}"), F.lit(c)) for i, c in enumerate(values, 1)), F.lit(None).cast("string")))
    return (
        per_key.where((F.col("source_rows") != F.col("target_rows")) | moved("_v0") | moved("_w"))
        .withColumn("verdict", verdict)
        .select(
            *keys,
            "source_rows",
            "target_rows",
            "verdict",
            F.when(F.col("verdict") == CHANGED, names).otherwise(F.array().cast("array<string>")).alias("changed_columns"),
        )
    )
