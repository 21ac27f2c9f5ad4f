"""Hot keys from a sketch that is filled while a stage is written.

``watch_keys`` hangs a frequent-items sketch on a frame; whatever job writes the frame fills it, partition by
partition, and Spark merges the parts.  Joins after that are told the hot keys by ``hot_hashes`` and need not
count their input.  The sketch keeps ``TRACKED`` counters; of N rows it names every key held by more than
``least_hot(N)`` of them, and a key it names besides costs a few copies of one lookup row, nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

TRACKED = 65_536
NAMED = 16_384  # more keys than this cannot be hot: least_hot(N) rows each would be over N


def key_hash(keys: Sequence[str | Column]) -> Column:
    """What the sketch counts; two keys of one hash are both treated as hot, which is harmless."""
    return F.xxhash64(*keys)


def least_hot(rows: int, tracked: int = TRACKED) -> int:
    """Every key with more rows than this is named: twice the error of a sketch of this size."""
    return -(-7 * rows // tracked)


def watch_keys(
    df: DataFrame, name: str, keys: Sequence[str], tracked: int = TRACKED, named: int = NAMED
) -> tuple[DataFrame, Callable[[int], list[int]]]:
    """``df`` to be written as usual, and a function that afterwards gives the hashes of the keys with ``hot_rows``
    rows or more.  It raises if the sketch is too small to tell: then take a larger one or more rows as hot.
    Rows without a key are not counted.  An empty frame has no hot keys."""
    seen = Observation(name)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    top = F.call_function("approx_top_k", F.when(whole, key_hash(keys)), F.lit(min(named, tracked)), F.lit(tracked))
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), top.alias("top"))

    def hot_hashes(hot_rows: int) -> list[int]:
        got = seen.get
        if got["rows"] > tracked and least_hot(got["rows"], tracked) > hot_rows:
            raise ValueError(f"{tracked} counters cannot tell which keys hold {hot_rows} of {got['rows']} rows")
        return [r["item"] for r in got["top"] or [] if r["item"] is not None and r["count"] >= hot_rows]

    return watched, hot_hashes
