"""Curated tables kept by differences, against a full rebuild after every batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import curated as A
from strata.operators.deltas import signed, signed_sum
from strata.operators.upsert import upsert_overwrite
from strata.plans import maintain as M
from strata.plans.config import Run, standard_entities
from strata.plans.load import set_up
from strata.sinks.store import Store

BUCKETS = 4


def put(store, entities, name, batch, rows):
    """``rows`` as dicts into a sanitised table, stamped with their batch."""
    table = entities[name].sanitised
    if not rows:
        return
    full = [tuple({**{c: None for c in table.columns.fieldNames()}, **r, "etl_batch_id": batch}.values()) for r in rows]
    df = store.spark.createDataFrame(full, table.columns)
    store.merge(table, df, lambda held, new: upsert_overwrite(held, new, table.key, ["etl_batch_id"], None, table.buckets))


def same(df, expected, key):
    cols = [c for c in expected.columns if c != "etl_batch_id"]
    a, b = ({tuple(r) for r in d.select(*cols).collect()} for d in (df, expected))
    assert a == b
    assert df.count() == expected.count() == len({r[cols.index(key)] for r in a})


def check(store, entities, made):
    artists, releases, recordings, urls = (
        store.read(entities[n].sanitised) for n in ("artists", "releases", "recordings", "urls")
    )
    read = {name: store.read(t) for name, t in made.items()}
    metrics = A.artist_metrics(artists, releases, A.songs_per_release(recordings))
    same(read["artist_metrics"], metrics, "artist_id")
    same(read["country_metrics"], A.country_metrics(metrics), "country")
    same(read["artist_discography"], A.discography(artists, releases), "artist_id")
    same(read["recording_metrics"], A.recording_metrics(releases, recordings), "recording_id")
    same(read["release_metrics"], A.release_metrics(releases, recordings, urls), "release_id")


def random_batch(rng):
    """Some rows of every table; keys repeat across batches, children may come before their release."""
    def name(kind, n):
        return f"{kind}{rng.randrange(n)}"

    def maybe(v):
        return None if rng.random() < 0.2 else v

    artists = {name("a", 6): None for _ in range(rng.randrange(4))}
    releases = {name("r", 14): None for _ in range(rng.randrange(8))}
    recordings = {(name("s", 8), name("r", 14)) for _ in range(rng.randrange(10))}
    urls = {(name("u", 5), name("r", 14)) for _ in range(rng.randrange(5))}
    day = dt.date(2020, 1, 1)
    return {
        "artists": [{"artist_id": a, "name": a.upper(), "country": maybe(name("c", 3))} for a in artists],
        "releases": [
            {
                "release_id": r,
                "artist_id": maybe(name("a", 7)),  # a6 is never sent
                "group_id": maybe(name("g", 3)),
                "release_date": maybe(day + dt.timedelta(days=400 * rng.randrange(4))),
                "country": maybe(name("c", 3)),
                "status": maybe(name("t", 2)),
            }
            for r in releases
        ],
        "recordings": [{"recording_id": s, "release_id": r} for s, r in sorted(recordings)],
        "urls": [{"url_id": u, "release_id": r} for u, r in sorted(urls)],
    }


def fresh(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    entities = standard_entities(buckets=2)
    set_up(store, entities)
    return store, entities


@pytest.mark.parametrize("seed", [1])
def test_random_batches_equal_a_rebuild(spark, tmp_path, seed):
    rng = random.Random(seed)
    store, entities = fresh(spark, tmp_path)
    for n in range(3):
        batch = f"b{n}"
        for name, rows in random_batch(rng).items():
            put(store, entities, name, batch, rows)
        made = M.maintain(store, entities, Run(batch, "2026-05-01 00:00:00", ""), BUCKETS)
        check(store, entities, made)


def test_empty_tables_and_an_empty_batch(spark, tmp_path):
    store, entities = fresh(spark, tmp_path)
    made = M.maintain(store, entities, Run("b0", "2026-05-01 00:00:00", ""), BUCKETS)
    assert all(store.read(t).count() == 0 for t in made.values())


@pytest.mark.parametrize("lost_after", [0, 4])
def test_a_lost_driver_applies_a_batch_once(spark, tmp_path, monkeypatch, lost_after):
    """The driver is lost before or between replacements; the batch is then given again, and once more."""
    rng = random.Random(9)
    store, entities = fresh(spark, tmp_path)
    first, second = (Run(b, "2026-05-01 00:00:00", "") for b in ("b0", "b1"))
    for run in (first, second):
        for name, rows in random_batch(rng).items():
            put(store, entities, name, run.etl_batch_id, rows)
        if run is first:
            M.maintain(store, entities, run, BUCKETS)
    whole, puts = M._Step.put, []

    def put_some(self, *args):
        if len(puts) == lost_after:
            raise ConnectionError("driver lost")
        puts.append(args)
        whole(self, *args)

    monkeypatch.setattr(M._Step, "put", put_some)
    with pytest.raises(ConnectionError):
        M.maintain(store, entities, second, BUCKETS)
    monkeypatch.setattr(M._Step, "put", whole)
    for _ in range(2):
        check(store, entities, M.maintain(store, entities, second, BUCKETS))


def test_untouched_buckets_stay(spark, tmp_path):
    store, entities = fresh(spark, tmp_path)
    put(store, entities, "releases", "b0", [{"release_id": f"r{n}", "artist_id": f"a{n}"} for n in range(40)])
    made = M.maintain(store, entities, Run("b0", "2026-05-01 00:00:00", ""), 16)
    folder = tmp_path / "store" / "state" / "release_state"
    before = {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}
    put(store, entities, "releases", "b1", [{"release_id": "r3", "artist_id": "a9"}])
    M.maintain(store, entities, Run("b1", "2026-05-02 00:00:00", ""), 16)
    after = {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}
    assert len(before) > 4 and len({p.parent for p in before.keys() ^ after.keys()}) == 1
    check(store, entities, made)


def test_held_and_new_rows_are_shuffled_together_once(spark, tmp_path, monkeypatch):
    store, entities = fresh(spark, tmp_path)
    put(store, entities, "releases", "b0", [{"release_id": f"r{n}", "artist_id": f"a{n}"} for n in range(5)])
    made = M.maintain(store, entities, Run("b0", "2026-05-01 00:00:00", ""), BUCKETS)
    step = M._Step(store, made, Run("b1", "2026-05-02 00:00:00", ""))
    held = store.read(made["release_state"])
    plans, after = [], held.where("release_id < 'r2'").withColumn("country", F.lit("x"))
    monkeypatch.setattr(store, "merge", lambda table, new, how: plans.append(how(store.read(table), new)))
    step.put("release_state", after, F.col("release_id") != "r1")
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert sorted((r.release_id, r.country) for r in plans[0].collect()) == [("r0", "x"), ("r2", None), ("r3", None), ("r4", None)]


def test_children_and_support_are_shuffled_once(spark, tmp_path, monkeypatch):
    """Whole buckets are written where their new rows are worked out; putting them in place is a copy."""
    store, entities = fresh(spark, tmp_path)
    plans, copied, prepare = {}, [], Store.prepare_buckets
    children = [{"recording_id": f"s{n % 3}", "release_id": f"r{n}"} for n in range(5)]

    def watched(self, table, incoming, how, path):
        def seen(held, sent, tasks):
            rows = how(held, sent, tasks)
            plans[table.table_name] = rows._jdf.queryExecution().executedPlan().toString()
            return rows

        prepare(self, table, incoming, seen, path)

    monkeypatch.setattr(Store, "prepare_buckets", watched, raising=False)
    monkeypatch.setattr(Store, "merge", lambda self, table, *how, whole=Store.merge: copied.append(table.table_name) or whole(self, table, *how))
    for batch in ("b0", "b1"):
        put(store, entities, "releases", batch, [{"release_id": f"r{n}", "artist_id": f"a{n}{batch}"} for n in range(5)])
        put(store, entities, "recordings", batch, children)
        made = M.maintain(store, entities, Run(batch, "2026-05-01 00:00:00", ""), BUCKETS)
    check(store, entities, made)
    assert plans.keys() == {"release_children", "artist_support", "recording_support"} and not plans.keys() & set(copied)
    for plan in plans.values():
        assert plan.count("Exchange") == 1 and "Join" not in plan and "Window" not in plan


def test_support_of_nothing_leaves_its_bucket(spark, tmp_path):
    """A bucket whose last support row goes is emptied, so that a later batch does not count it again."""
    store, entities = fresh(spark, tmp_path)
    for n, artist in enumerate(("a1", "a2", "a1")):
        put(store, entities, "artists", f"b{n}", [{"artist_id": a, "name": a, "country": "c"} for a in ("a1", "a2")])
        put(store, entities, "releases", f"b{n}", [{"release_id": "r", "artist_id": artist, "group_id": "g"}])
        put(store, entities, "recordings", f"b{n}", [{"recording_id": "s", "release_id": "r"}])
        made = M.maintain(store, entities, Run(f"b{n}", "2026-05-01 00:00:00", ""), 64)
        check(store, entities, made)
        assert [(r.artist_id, r.n) for r in store.read(made["recording_support"]).collect()] == [(artist, 1)]


def test_children_of_no_release_are_new_each_time(spark, tmp_path):
    store, entities = fresh(spark, tmp_path)
    made = M.maintain(store, entities, Run("b0", "2026-05-01 00:00:00", ""), BUCKETS)
    recordings = spark.createDataFrame([("s", None), ("s", None), ("s", "r"), ("s", "r")], "recording_id string, release_id string")
    urls = spark.createDataFrame([("u", "r")], "url_id string, release_id string")
    for n, new in (("b1", [("recording", "r"), ("recording", None), ("url", "r")]), ("b2", [("recording", None)])):
        step = M._Step(store, made, Run(n, "2026-05-01 00:00:00", ""))
        rows = M._new_children(step, recordings, urls)
        assert sorted(((r.kind, r.release_id) for r in rows.where("_new").collect()), key=str) == sorted(new, key=str)
        assert rows.count() == 3
        store.replace_buckets(made["release_children"], f"{step.root}/release_children", rows)
    assert store.read(made["release_children"]).count() == 3


def test_signed_differences(spark):
    old = spark.createDataFrame([("a", 2), ("b", 1), (None, 3)], "k string, n long")
    new = spark.createDataFrame([("a", 2), ("c", 4), (None, 1)], "k string, n long")
    delta = signed(old, new, ["k"], ["n"])
    assert {tuple(r) for r in delta.collect()} == {("b", -1), ("c", 4), (None, -2)}
    again = signed_sum(old.unionByName(delta), ["k"], ["n"])
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in new.collect()}
