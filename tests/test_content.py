"""Reconciliation by content, hot keys from a sketch, and chains of missing parents, against plain Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import plan
from strata.operators.content import content_differences
from strata.operators.hot import key_hash, least_hot, watch_keys
from strata.operators.relate import broken_chains
from strata.operators.skew import lookup_join

SCHEMA = "k string, l int, a string, b int, extra binary"


def expected(source, target):
    """{key: (source rows, target rows, verdict, changed columns)} row by row."""
    def by_key(rows):
        out = defaultdict(list)
        for r in rows:
            out[r[:2]].append(r[2:4])
        return out

    s, t = by_key(source), by_key(target)
    out = {}
    for key in s.keys() | t.keys():
        x, y = s.get(key, []), t.get(key, [])
        if Counter(x) == Counter(y):
            continue
        if len(x) != len(y):
            verdict = "missing" if not y else "extra" if not x else "repeated"
            out[key] = (len(x), len(y), verdict, ())
        else:
            names = tuple(n for i, n in enumerate("ab") if Counter(r[i] for r in x) != Counter(r[i] for r in y))
            out[key] = (len(x), len(y), "changed", names)
    return out


def found(spark, source, target, buckets):
    s, t = (spark.createDataFrame(rows, SCHEMA).drop("extra") for rows in (source, target))
    df = content_differences(s, t.select("b", "a", "l", "k"), ["k", "l"], buckets=buckets)
    rows = df.collect()
    out = {(r.k, r.l): (r.source_rows, r.target_rows, r.verdict, tuple(r.changed_columns)) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("buckets", [1, 3, 4096])
def test_differences_equal_row_by_row(spark, buckets):
    rng = random.Random(buckets)

    def pick(*values):
        return rng.choice([None, *values])

    source = [(pick("", "x", "y" * 50_000), pick(0, 1, 2, 3), pick("", "v"), pick(0, -5), None) for _ in range(60)]
    target = [r for r in source if rng.random() < 0.8]
    target = [(*r[:3], 9, None) if rng.random() < 0.1 else r for r in target] + [("new", n, "v", 0, None) for n in range(3)]
    assert found(spark, source, target, buckets) == expected(source, target)


def test_null_moves_and_pairings_are_seen(spark):
    one = [("k", 1, None, 5, None), ("m", 1, "p", 1, None), ("m", 1, "q", 2, None), ("n", 1, None, None, None)]
    two = [("k", 1, "5", None, None), ("m", 1, "p", 2, None), ("m", 1, "q", 1, None), (None, 1, None, None, None)]
    got = found(spark, one, two, 16)
    assert got == expected(one, two)
    assert got[("m", 1)] == (2, 2, "changed", ())


def test_equal_and_empty_tables(spark):
    rows = [("k", n % 7, "v", n, None) for n in range(50)]
    assert found(spark, rows, rows[::-1], 8) == {}
    assert found(spark, [], [], 8) == {}
    assert found(spark, rows[:1], [], 8) == {("k", 0): (1, 0, "missing", ())}


def test_a_sketch_misses_no_hot_key(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, "warm").when(F.col("id") % 50 == 2, None)
        .otherwise(F.concat(F.lit("k"), "id")).alias("k"),
        "id",
    ).repartition(6)
    watched, hot = watch_keys(rows, "sketch", ["k"], tracked=1024, named=256)
    watched.write.parquet(str(tmp_path / "rows"))
    true = {r.h for r in rows.groupBy("k").count().where("k is not null and count >= 1000").select(key_hash(["k"]).alias("h")).collect()}
    assert len(true) == 2 and true <= set(hot(1000))
    assert len(hot(1000)) <= 60
    assert least_hot(60_000, 1024) == 411
    with pytest.raises(ValueError, match="cannot tell"):
        hot(100)


def test_a_sketch_of_an_empty_frame(spark, tmp_path):
    watched, hot = watch_keys(spark.createDataFrame([], "k string, n int"), "empty", ["k", "n"])
    watched.write.parquet(str(tmp_path / "none"))
    assert hot(1) == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_joins_told_their_hot_keys(spark, tmp_path, how):
    rows = spark.createDataFrame([("h" if n % 2 else f"k{n % 9}" if n % 5 else None, n) for n in range(400)], "k string, n int")
    lookup = spark.createDataFrame([("h", 1), ("k2", 2), ("k4", 3)], "k string, v int")
    watched, hot = watch_keys(rows, "told", ["k"])
    watched.write.parquet(str(tmp_path / "rows"))
    written = spark.read.parquet(str(tmp_path / "rows"))
    told = lookup_join(written, lookup, ["k"], how, ["n"], salts=4, hot=hot(100))
    assert sorted(map(str, told.collect())) == sorted(map(str, rows.join(lookup, "k", how).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = lookup_join(written, lookup, ["k"], how, ["n"], salts=4, hot=hot(100))
        assert "Aggregate" not in plan(told) and "Broadcast" not in plan(told)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_chains_name_their_broken_ancestor(spark):
    def frame(*rows):
        return spark.createDataFrame(rows, "id string, fk string, n int")

    root = frame(("a1", None, 1), ("a1", None, 2), ("a2", None, 1))
    albums = frame(("g1", "a1", 1), ("g2", "gone", 1), ("g3", None, 1))
    releases = frame(("r1", "g1", 1), ("r2", "g2", 1), ("r3", "lost", 1), ("r4", "g3", 1), ("r5", "g1", 1), ("r5", "g2", 1))
    songs = frame(("s1", "r1", 1), ("s2", "r2", 1), ("s2", "r2", 1), ("s3", "r3", 1), ("s4", "r4", 1), ("s5", "r5", 1), (None, "r9", 1))
    levels = [("album", albums, "id", "fk"), ("release", releases, "id", "fk"), ("song", songs, "id", "fk")]
    got = sorted(map(tuple, broken_chains(root, "id", levels).collect()), key=str)
    assert got == sorted(
        [
            ("album", "g2", "gone", "album", "g2", 0),
            ("release", "r2", "g2", "album", "g2", 1),
            ("release", "r5", "g2", "album", "g2", 1),
            ("release", "r3", "lost", "release", "r3", 0),
            ("song", "s2", "r2", "album", "g2", 2),
            ("song", "s2", "r2", "album", "g2", 2),
            ("song", "s3", "r3", "release", "r3", 1),
            ("song", None, "r9", "song", None, 0),
        ],
        key=str,
    )
    told = broken_chains(root, "id", levels, hot=[[], [], []])
    assert sorted(map(tuple, told.collect()), key=str) == got
    nothing = broken_chains(root.limit(0), "id", [("album", albums.limit(0), "id", "fk")])
    assert nothing.count() == 0
