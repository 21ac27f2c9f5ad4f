"""Set-based merges against a plain row-by-row interpreter, on random batches."""

import random

import pytest

from helpers import rows
from strata.operators import upsert

COLUMNS = ["id", "a", "b", "created_at", "updated_at"]
SCHEMA = "id string, a string, b int, created_at int, updated_at int"


def one_by_one(target, batch, mode, created):
    """Apply the batch row by row, as statements with a conflict clause would."""
    table = {r["id"]: dict(r) for r in target}
    for row in batch:
        held = table.get(row["id"])
        if held is None:
            table[row["id"]] = dict(row)
            continue
        if mode == "absent":
            continue
        for name in COLUMNS[1:]:
            if name == "created_at" and created == "preserve":
                continue
            if mode == "preserve" and row[name] is None:
                continue
            held[name] = row[name]
    return sorted((tuple(r[c] for c in COLUMNS) for r in table.values()), key=str)


def random_batch(rng, n, keys, start):
    def row(i):
        return {
            "id": rng.choice(keys),
            "a": rng.choice([None, None, "x", "y", "z"]),
            "b": rng.choice([None, 1, 2, 3]),
            "created_at": rng.choice([None, start + i, start + i]),
            "updated_at": start + i,
        }

    return [row(i) for i in range(n)]


@pytest.mark.parametrize("seed", range(5))
@pytest.mark.parametrize(
    "mode, created", [("overwrite", "preserve"), ("overwrite", "all"), ("preserve", "preserve"), ("preserve", "all"), ("absent", "preserve")]
)
def test_merge_equals_row_by_row(spark, seed, mode, created):
    rng = random.Random(seed)
    keys = [f"k{i}" for i in range(rng.choice([1, 4, 9]))]
    seen = {}
    for r in random_batch(rng, 6, keys[: max(1, len(keys) // 2)], 0):
        seen[r["id"]] = r
    target, batch = list(seen.values()), random_batch(rng, rng.choice([0, 3, 25]), keys, 100)

    t = spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in target], SCHEMA)
    i = spark.createDataFrame(
        [(*(r[c] for c in COLUMNS), n) for n, r in enumerate(batch)], SCHEMA + ", _ord int"
    ).repartition(3)
    keep = "created_at" if created == "preserve" else None
    if mode == "overwrite":
        got = upsert.upsert_overwrite(t, i, ["id"], ["_ord"], keep)
    elif mode == "preserve":
        got = upsert.upsert_preserve(t, i, ["id"], ["_ord"], keep)
    else:
        got = upsert.insert_absent(t, i, ["id"], ["_ord"])
    assert got.columns == COLUMNS
    assert sorted(rows(got), key=str) == one_by_one(target, batch, mode, created)


def test_order_column_may_be_stored(spark):
    t = spark.createDataFrame([("a", 1, "old")], "id string, n int, v string")
    i = spark.createDataFrame([("a", 3, "last"), ("a", 2, "first"), ("b", 9, "new")], "id string, n int, v string")
    assert sorted(rows(upsert.upsert_overwrite(t, i, ["id"], ["n"]))) == [("a", 3, "last"), ("b", 9, "new")]
    assert sorted(rows(upsert.insert_absent(t, i, ["id"], ["n"]))) == [("a", 1, "old"), ("b", 9, "new")]


def test_order_may_be_partly_stored(spark):
    t = spark.createDataFrame([("a", 1, "old")], "id string, n int, v string")
    i = spark.createDataFrame([("a", 2, "p", 1), ("a", 2, "q", 2), ("a", 1, "r", 9)], "id string, n int, v string, part int")
    for merge in (upsert.upsert_overwrite, upsert.upsert_preserve):
        assert rows(merge(t, i, ["id"], ["n", "part"])) == [("a", 2, "q")]


def test_append(spark):
    t = spark.createDataFrame([("a", 1)], "id string, n int")
    i = spark.createDataFrame([(1, "a", "x")], "n int, id string, other string")
    assert rows(upsert.append_rows(t, i)) == [("a", 1), ("a", 1)]


def test_composite_key(spark):
    schema = "x string, y int, v string, created_at int"
    t = spark.createDataFrame([("a", 1, "old", 1), ("a", 2, "stay", 2)], schema)
    i = spark.createDataFrame([("a", 1, "new", 9, 1), ("b", 1, "ins", 9, 2)], schema + ", _ord int")
    got = upsert.upsert_overwrite(t, i, ["x", "y"], ["_ord"])
    assert sorted(rows(got)) == [("a", 1, "new", 1), ("a", 2, "stay", 2), ("b", 1, "ins", 9)]
