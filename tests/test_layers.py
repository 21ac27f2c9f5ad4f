"""Two snapshots with dirty rows, through landing, sanitised, curated and recon."""

import datetime as dt
import json
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import plan
from strata.operators.audit import batch_outcome
from strata.plans.batch import Batch, lost_keys, new_batch_id, phase_log, run_batch
from strata.plans.config import BATCH_LOG, QUARANTINE_TABLE, RECON_LOG, CURATED, Run, standard_entities
from strata.operators.upsert import upsert_overwrite
from strata.plans import ledger
from strata.plans.load import check_target, landing_rows, load_landing, load_sanitised, set_up
from strata.schemas import columns
from strata.sinks.store import Store, TableDef

DAY1, DAY2 = "2026-05-01 00:00:00", "2026-05-02 00:00:00"

ARTISTS_1 = [
    {"id": "a1", "name": "Zoë", "gender": "female", "country": "IN", "score": 100},
    {"id": "a2", "name": "None", "country": "GB", "score": 90},  # no name: rejected
    {"id": "a3", "name": "Kay", "gender": "male", "country": "IN", "score": "abc"},
    {"id": "", "artist_id": "a4", "name": "Alias", "country": "null"},
    {"name": "no key"},
    5,
    "s",
    {"id": "a1", "name": "Zoë", "gender": "none", "country": "SE", "score": 99},
]
ARTISTS_2 = [
    {"id": "a1", "name": "Zoë L.", "gender": None, "country": "SE"},
    {"id": "a5", "name": "New", "country": "GB"},
]
RELEASES = [
    {"id": "r1", "artist_id": "a1", "group_id": "g1", "title": "1989", "date": "1989", "country": "IN", "status": "Official"},
    {"id": "r2", "artist_id": "a1", "group_id": "g1", "title": "B", "date": "2020-13", "country": "IN", "status": "None"},
    {"id": "r3", "artist_id": "a3", "group_id": "g2", "title": "C", "date": "2020-05", "country": "GB", "status": "Official"},
    {"id": "r4", "artist_id": "gone", "group_id": "g3", "title": "D", "date": 1989, "country": "GB"},
]
RECORDINGS = [
    {"id": "r1", "parts": [{"items": [{"recording_id": "s1", "song_name": "x"}, {"recording_id": "s2", "song_name": "old"}, {"recording_id": "s2", "song_name": "y"}]}]},
    {"id": "r3", "parts": [{"items": [{"recording_id": "s1", "song_name": "x"}]}, {"items": []}]},
    {"id": "r2"},
]
URLS = [{"id": "r1", "links": [{"type": "shop", "url_id": "u1", "resource": "http://x"}]}]


def put(root, source, day, rows, indent=4):
    folder = root / source
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{source}_{day}.json").write_text(
        json.dumps(rows, indent=indent, ensure_ascii=False), encoding="utf-8"
    )


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    put(root, "artists", "2026_05_01", ARTISTS_1)
    put(root, "releases", "2026_05_01", RELEASES)
    put(root, "recordings", "2026_05_01", RECORDINGS)
    put(root, "urls", "2026_05_01", URLS)
    return root


def run(raw, as_of, n):
    return Run(f"2026050{n}000000_src", as_of, str(raw))


@pytest.mark.parametrize("buckets", [1, 8])
def test_two_snapshots(spark, tmp_path, raw, buckets):
    store = Store(spark, str(tmp_path / "store"))
    entities = standard_entities(buckets=buckets)
    out = run_batch(store, entities, run(raw, DAY1, 1))
    assert (out["landing.artists"].rows_read, out["landing.artists"].rows_rejected) == (8, 3)
    assert (out["sanitised.artists"].rows_read, out["sanitised.artists"].rows_rejected) == (4, 2)

    lnd = {r.id: r for r in store.read(entities["artists"].landing).collect()}
    assert set(lnd) == {"a1", "a2", "a3", "a4"}
    assert json.loads(lnd["a1"].payload)["score"] == 99
    assert lnd["a1"].created_at == dt.datetime(2026, 5, 1)

    san = {r.artist_id: r for r in store.read(entities["artists"].sanitised).collect()}
    # A score that is no number rejects its row, as a missing name does.
    assert set(san) == {"a1", "a4"}
    assert san["a4"].country is None
    assert (san["a1"].gender, san["a1"].country) == (None, "SE")
    reasons = {r.reject_reason for r in store.read(QUARANTINE_TABLE).collect()}
    assert {"score is not int", "name is null"} <= reasons

    rel = {r.release_id: r for r in store.read(entities["releases"].sanitised).collect()}
    assert (rel["r1"].title, rel["r1"].date_raw, str(rel["r1"].release_date)) == ("1989", "1989-01-01", "1989-01-01")
    assert (rel["r2"].date_raw, rel["r2"].release_date, rel["r2"].status) == ("2020-13-01", None, None)
    assert (rel["r4"].date_raw, rel["r4"].release_date) == ("1989", None)

    metrics = {r.artist_id: r for r in store.read(CURATED["artist_metrics"]).collect()}
    assert (metrics["a1"].release_count, metrics["a1"].album_count, metrics["a1"].recording_count) == (2, 1, 2)
    songs = {r.recording_id: r for r in store.read(CURATED["recording_metrics"]).collect()}
    assert (songs["s1"].release_count, songs["s1"].artist_count) == (2, 2)

    names = {(r.recording_id, r.release_id): r.song_name for r in store.read(entities["recordings"].sanitised).collect()}
    assert names == {("s1", "r1"): "x", ("s2", "r1"): "y", ("s1", "r3"): "x"}

    recon = {r.phase_name: r for r in store.read(RECON_LOG).collect()}
    assert (recon["recon_artists"].source_count, recon["recon_artists"].target_count) == (4, 2)
    assert recon["recon_artists"].status == "FAIL"
    assert recon["recon_recordings"].status == "PASS"
    # Eight rows read, of which three were rejected and one repeats a key, leave four.
    assert (recon["recon_raw_artists"].source_count, recon["recon_raw_artists"].target_count) == (4, 4)
    assert recon["recon_raw_artists"].status == "PASS"
    assert (recon["recon_raw_urls"].diff, recon["recon_raw_urls"].status) == (0, "PASS")
    assert sorted(r.artist_id for r in lost_keys(store, entities["artists"]).collect()) == ["a2", "a3"]
    outcome = batch_outcome(phase_log(store.read(BATCH_LOG))).collect()
    assert [(o.incomplete_phases, o.succeeded) for o in outcome] == [(0, True)]
    phases = {r.phase_name: r for r in phase_log(store.read(BATCH_LOG)).collect()}
    assert (phases["batch"].rows_processed, phases["load_landing_artists"].rows_processed) == (2 + 4 + 4 + 1, 5)
    assert store.read(QUARANTINE_TABLE).count() == 3 + 2

    # Second snapshot: a1 keeps its creation time and the gender stays as it was.
    put(raw, "artists", "2026_05_02", ARTISTS_2)
    second = run(raw, DAY2, 2)
    load_landing(store, entities["artists"], second)
    # Only what the second run landed is read, and only once.
    assert [load_sanitised(store, entities["artists"], second).rows_read for _ in range(2)] == [2, 0]
    lnd = {r.id: r for r in store.read(entities["artists"].landing).collect()}
    assert (lnd["a1"].created_at, lnd["a1"].updated_at) == (dt.datetime(2026, 5, 1), dt.datetime(2026, 5, 2))
    assert lnd["a3"].updated_at == dt.datetime(2026, 5, 1)
    san = {r.artist_id: r for r in store.read(entities["artists"].sanitised).collect()}
    assert (san["a1"].name, san["a1"].score, san["a5"].country) == ("Zoë L.", 99, "GB")

    # Landing loads that no sanitised load has followed yet are all picked up.
    late = Store(spark, str(tmp_path / "late"))
    set_up(late, {"artists": entities["artists"]})
    for day, as_of in (("2026_05_01", DAY1), ("2026_05_02", DAY2)):
        step = Run(day, as_of, str(raw), dt.date(*map(int, day.split("_"))))
        load_landing(late, entities["artists"], step)
    assert load_sanitised(late, entities["artists"], second).rows_read == 5

    # Loading the same snapshot again changes nothing.
    before = sorted(map(str, store.read(entities["artists"].landing).collect()))
    load_landing(store, entities["artists"], second)
    assert sorted(map(str, store.read(entities["artists"].landing).collect())) == before


def files_of(folder):
    return {str(f.relative_to(folder)): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


NAMES = TableDef("s", "names", columns("id string, name string, n long"), ("id",), 64)


def put_names(store, rows):
    frame = store.spark.createDataFrame(rows, "id string, name string, n long")
    how = lambda held, new: upsert_overwrite(held, new, ["id"], ["n"], None, NAMES.buckets)
    return store.merge(NAMES, frame, how)


def test_only_hit_buckets_are_read_and_written(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create_if_absent(NAMES)
    assert put_names(store, [(f"k{i}", "old", i) for i in range(2000)]) == list(range(64))
    folder = tmp_path / "s" / "names"
    before = files_of(folder)
    assert len(before) == 64  # one task writes a bucket
    hit = put_names(store, [("k7", "a", 1), ("k7", "b", 2)])
    after = files_of(folder)
    assert len(hit) == 1 and len(after) == 64
    assert [f for f in before if after.get(f) != before[f]] == [f for f in before if f.startswith(f"bucket={hit[0]}/")]
    got = {r.id: r.name for r in store.read(NAMES).collect()}
    assert got == {f"k{i}": "b" if i == 7 else "old" for i in range(2000)}
    assert put_names(store, []) == [] and files_of(folder) == after
    read = store._bucketed(NAMES).where(F.col("bucket").isin(hit))
    assert "PartitionFilters: [isnotnull(bucket" in plan(read) or "PartitionFilters: [bucket" in plan(read)


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("strata.sinks.store.TASK_BYTES", 20_000)
    store, table = Store(spark, str(tmp_path)), TableDef("s", "few", NAMES.columns, ("id",), 2)
    store.create_if_absent(table)
    rows = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("id"), F.repeat(F.lit("x"), 50).alias("name"), F.col("id").alias("n"))
    assert table.tasks(rows.limit(0)) == 2 and table.tasks(rows.limit(10)) == 2 and table.tasks(rows) >= 8

    def files_per_bucket():
        return Counter(f.split("/")[0] for f in files_of(tmp_path / "s" / "few"))

    store.refresh(table, rows, "b1")
    assert set(files_per_bucket()) == {"bucket=0", "bucket=1"} and min(files_per_bucket().values()) >= 4
    new = rows.where("n < 700").withColumn("name", F.lit("new"))
    hit = store.merge(table, new, lambda held, more: upsert_overwrite(held, more, ["id"], ["n"], None, table.tasks(held, more)))
    assert hit == [0, 1] and min(files_per_bucket().values()) >= 3
    assert {r.n: r.name for r in store.read(table).collect()} == {i: "new" if i < 700 else "x" * 50 for i in range(2000)}
    assert store._bucketed(table).where(F.col("bucket") != table.bucket()).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_bucket_merges_equal_row_by_row(spark, tmp_path, seed):
    rng, model, store = random.Random(seed), {}, Store(spark, str(tmp_path))
    store.create_if_absent(NAMES)
    for step in range(4):
        rows = [(f"k{rng.randrange(300)}", rng.choice(["x", "y", None]), 1000 * step + i) for i in range(rng.choice([1, 5, 200]))]
        put_names(store, rows)
        model.update({r[0]: r for r in rows})
    assert sorted(map(tuple, store.read(NAMES).collect()), key=repr) == sorted(model.values(), key=repr)


def test_failed_load_changes_nothing(spark, tmp_path, raw):
    store = Store(spark, str(tmp_path / "store"))
    entities = standard_entities(buckets=4)
    set_up(store, entities)
    e = entities["artists"]
    load_landing(store, e, run(raw, DAY1, 1))
    folder = tmp_path / "store" / "landing" / "lnd_artists"
    before = files_of(folder)
    rows = store.read(e.landing)
    # The rows fail while the new buckets are being written.
    boom = F.when(F.col("id") == "a3", F.raise_error(F.lit("boom")).cast("string")).otherwise(F.col("payload"))
    with pytest.raises(Exception, match="boom"):
        store.merge(e.landing, rows, lambda held, new: held.withColumn("payload", boom))
    assert files_of(folder) == before and store.read(e.landing).count() == 4
    curated = CURATED["country_metrics"]
    store.refresh(curated, spark.range(3).withColumns({f.name: F.lit(None) for f in curated.columns}), "b1")
    with pytest.raises(Exception, match="boom"):
        store.refresh(curated, rows.select(boom.alias("country"), *(F.lit(None).alias(f.name) for f in curated.columns[1:])), "b2")
    assert store.read(curated).count() == 3 and store.versions(curated) == ["v=000001-b1"]


def test_a_refreshed_table_has_the_new_rows_only(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    plain = TableDef("s", "plain", columns("id string, name string, n long"))
    for table in (NAMES, plain):
        assert store.create_if_absent(table) and not store.create_if_absent(table)
        for n in (500, 3, 40):
            rows = spark.range(n).select(F.concat(F.lit("k"), "id").alias("id"), F.lit("x").alias("name"), F.col("id").alias("n"))
            store.refresh(table, rows, f"b{n}")
            assert sorted(r.n for r in store.read(table).collect()) == list(range(n))
    assert store.versions(plain) == ["v=000002-b3", "v=000003-b40"]
    with pytest.raises(LookupError):
        store.read(TableDef("s", "unknown", plain.columns))


def test_increments_by_batch_lose_nothing(spark, tmp_path, raw):
    """Two runs of one time, a batch with an earlier time, and a sanitised load that dies."""
    store = Store(spark, str(tmp_path / "store"))
    entity = standard_entities()["artists"]
    set_up(store, {"artists": entity})
    first, same, late = Run("b1", DAY2, str(raw)), Run("b2", DAY2, str(raw)), Run("b0", DAY1, str(raw))
    read = lambda run: load_sanitised(store, entity, run).rows_read
    put(raw, "artists", "2026_05_03", [{"id": "x1", "name": "one"}])
    load_landing(store, entity, first)
    assert read(first) == 1 and read(first) == 0
    put(raw, "artists", "2026_05_04", [{"id": "x2", "name": "two"}])
    load_landing(store, entity, same)
    put(raw, "artists", "2026_05_05", [{"id": "x3", "name": "three"}, {"id": "x1", "country": "SE", "name": "one"}])
    load_landing(store, entity, late)
    found = ledger.pending(store, entity.landing, entity.sanitised)
    assert found.batches == ["b0", "b2"]
    assert read(late) == 3 and read(late) == 0
    got = {r.artist_id: (r.country, r.etl_batch_id) for r in store.read(entity.sanitised).collect()}
    assert got == {"x1": ("SE", "b0"), "x2": (None, "b2"), "x3": (None, "b0")}
    # A load that was announced and died before it wrote is read again when it is repeated.
    ledger.announce(store, entity.landing, same)
    assert read(same) == 1
    load_landing(store, entity, late)
    assert ledger.pending(store, entity.landing, entity.sanitised).batches == ["b0"]


def test_a_load_looks_its_target_up(spark, tmp_path, raw):
    store = Store(spark, str(tmp_path / "store"))
    entity = standard_entities()["artists"]
    for bad in (columns("key string"), T.StructType([])):
        with pytest.raises(LookupError):
            check_target(store, replace(entity.landing, table_name="other", columns=bad))
    check_target(store, entity.landing)


def test_phases_are_logged_under_their_own_group(spark, tmp_path, raw):
    store = Store(spark, str(tmp_path / "store"))
    entities = standard_entities(groups={"urls": ("web", "links")})
    run_batch(store, entities, replace(run(raw, DAY1, 1), archive=True))
    labels = {(r.source_system, r.group_name, r.phase_name) for r in store.read(BATCH_LOG).collect()}
    assert {("web", "links", "batch"), ("web", "links", "load_landing_urls"), ("src", "entities", "batch"), ("curated", "metrics", "curate"),
            ("src", "entities", "archive_artists")} <= labels
    assert ("src", "entities", "load_landing_urls") not in labels
    for table in [*CURATED.values(), *(t for e in entities.values() for t in (e.landing, e.sanitised))]:
        assert {r.etl_batch_id for r in store.read(table).collect()} == {"20260501000000_src"}, table


def test_failed_phase_is_logged_and_raised(spark, tmp_path, raw):
    store = Store(spark, str(tmp_path / "store"))
    set_up(store, {})
    batch = Batch(store, run(raw, DAY1, 1), "src", "entities")
    with pytest.raises(ZeroDivisionError):
        batch.phase("p", lambda: 1 / 0)
    row = phase_log(store.read(BATCH_LOG)).first()
    assert (row.status, row.completed, row.ever_failed) == ("FAILED", False, True)
    assert "division" in row.last_error
    batch.phase("p", lambda: None)
    row = phase_log(store.read(BATCH_LOG)).first()
    assert (row.status, row.completed, row.ever_failed) == ("SUCCESS", True, True)


def test_archive_and_setup(spark, tmp_path, raw):
    store = Store(spark, str(tmp_path / "store"))
    entities = standard_entities(buckets=8)
    set_up(store, entities)
    e = entities["artists"]
    assert store.create_if_absent(e.landing) is False
    load_landing(store, e, run(raw, DAY1, 1))
    put(raw, "artists", "2026_05_02", ARTISTS_2)
    load_landing(store, e, replace(run(raw, DAY2, 2), archive=True))
    # The archive holds what the second load superseded, and its neighbours in the buckets hit.
    kept = spark.read.parquet(store.archive_folder(e.landing, "20260502000000_src"))
    held = {r.id: r.etl_batch_id for r in kept.collect()}
    assert held["a1"] == "20260501000000_src" and "a5" not in held


def test_batch_id_text():
    assert new_batch_id(dt.datetime(2026, 7, 30, 17, 38, 28), "cv1") == "20260730173828_cv1"


def test_what_is_no_object_is_told_from_the_text(spark):
    texts = ['{"id":"1"}', ' \n{"id":"1"}', "{}", "[1]", '"{"', "null", "7", "{bad", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "element string").select("element", F.lit("f").alias("src_file"), F.lit(0).alias("_ord"))
    made = landing_rows(rows, standard_entities()["artists"], Run("b", "2026-05-01 00:00:00", ""))
    found = {r.payload: r.reject_reason for r in made.collect()}
    no_object, no_json = "not an object", "invalid json"
    assert list(map(found.get, texts)) == [None, None, "id is null", *[no_object] * 4, *[no_json] * 3]
