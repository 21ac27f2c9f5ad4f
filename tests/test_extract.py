"""Captured responses through extraction and the whole batch."""

import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from strata.functions import payload as P
from strata.plans.batch import run_batch
from strata.plans.config import CURATED, Run, standard_entities
from strata.plans.extract import DAILY_RUN, STOP, Limits, extract, unused_responses
from strata.schemas import RESPONSE
from strata.sinks.store import Store

DAY = dt.date(2026, 5, 1)


def capture():
    def row(endpoint, key, ord, status, body):
        return ("run", endpoint, key, ord, status, json.dumps(body, ensure_ascii=False))

    many = [{"id": f"r{i}", "title": f"T{i}", "date": "2020"} for i in range(120)]
    return [
        row("artist", "Ana", 1, 200, {"artists": [{"id": "a1", "name": "Ana"}, {"id": "a2", "name": "Ana Junior"}]}),
        row("artist", "Zoë", 2, 200, {"artists": [{"id": "a3", "name": "Zoë"}]}),
        row("artist", "Broken", 3, 503, {"error": "later"}),
        row("artist", "Cara", 4, 200, {"artists": [{"id": "a4", "name": "Cara"}]}),
        row("artist", "Empty", 5, 200, {"count": 0}),
        row("release", "a1", 1, 200, {"releases": many}),
        row("release", "a3", 2, 404, {"error": "none"}),
        row("release", "a4", 3, 200, {"releases": [{"id": "s1", "title": "S", "artist_id": "own"}, {}]}),
        row("release", "nobody", 4, 200, {"releases": [{"id": "zz"}]}),
        row("release+recordings", "r1", 1, 200, {"id": "r1", "parts": [{"items": [{"recording_id": "x", "song_name": "X"}]}]}),
        row("release+recordings", "r2", 2, 500, {"error": 1}),
        row("release+url-rels", "r1", 1, 200, {"id": "r1", "links": [{"type": "shop", "url_id": "u", "resource": "h"}]}),
        row("release+url-rels", "r2", 2, 500, {"error": 1}),
    ]


@pytest.fixture
def responses(spark):
    return spark.createDataFrame(capture(), RESPONSE)


def lines(spark, path):
    """Snapshot lines in file and line order."""
    from strata.sources.snapshots import read_json_lines

    return [json.loads(r[0]) for r in read_json_lines(spark, path).orderBy("_ord").select("element").collect()]


def test_stop_at_first_failure(spark, tmp_path, responses):
    paths = extract(responses, Run("b", "2026-05-01 00:00:00", str(tmp_path), DAY), Limits(STOP, 1, 100))
    # Best match per search, nothing after the failing search.
    assert [a["id"] for a in lines(spark, paths["artists"])] == ["a1", "a3"]
    releases = lines(spark, paths["releases"])
    assert [r["id"] for r in releases] == [f"r{i}" for i in range(100)]
    assert {r["artist_id"] for r in releases} == {"a1"}
    assert [r["id"] for r in lines(spark, paths["recordings"])] == ["r1"]
    assert lines(spark, paths["urls"]) == [json.loads(b[5]) for b in capture()[-2:]]


def test_skip_failures(spark, tmp_path, responses):
    paths = extract(responses, Run("b", "2026-05-01 00:00:00", str(tmp_path), DAY), DAILY_RUN)
    assert [a["id"] for a in lines(spark, paths["artists"])] == ["a1", "a2", "a3", "a4"]
    releases = lines(spark, paths["releases"])
    assert len(releases) == 122
    # The requesting artist's key wins over one the object has itself.
    assert releases[-2:] == [{"id": "s1", "title": "S", "artist_id": "a4"}, {"artist_id": "a4"}]


def test_terms_and_no_parents(spark, tmp_path, responses):
    terms = spark.createDataFrame([("ana ",)], "term string")
    paths = extract(responses, Run("b", "x", str(tmp_path), DAY), Limits(), terms)
    assert [a["id"] for a in lines(spark, paths["artists"])] == ["a1", "a2"]
    nobody = spark.createDataFrame([("unknown",)], "term string")
    paths = extract(responses, Run("b", "x", str(tmp_path / "n"), DAY), Limits(), nobody)
    assert [len(lines(spark, p)) for p in paths.values()] == [0, 0, 0, 0]


def test_with_field(spark):
    data = [("{}",), ('{"a":1}',), (' { "k": 2}',), ("5",), ('"{}"',), ("[{}]",)]
    df = spark.createDataFrame(data, "e string").select(P.with_field(F.col("e"), "k", F.lit('q"uote')).alias("e"))
    assert [r[0] for r in df.collect()] == [
        '{"k":"q\\"uote"}', '{"a":1,"k":"q\\"uote"}', ' { "k": 2,"k":"q\\"uote"}', "5", '"{}"', "[{}]",
    ]


def test_captured_responses_to_curated(spark, tmp_path, responses):
    run = Run("20260501000000_src", "2026-05-01 00:00:00", str(tmp_path / "raw"), DAY)
    extract(responses, run, DAILY_RUN)
    store = Store(spark, str(tmp_path / "store"))
    out = run_batch(store, standard_entities(layout="lines"), run)
    assert (out["landing.releases"].rows_read, out["landing.releases"].rows_good) == (122, 122)
    metrics = {r.artist_id: r for r in store.read(CURATED["artist_metrics"]).collect()}
    assert (metrics["a1"].release_count, metrics["a1"].recording_count) == (120, 1)
    assert metrics["a3"].release_count == 0


def test_bigint_keys(spark, tmp_path):
    folder = tmp_path / "raw" / "artists"
    folder.mkdir(parents=True)
    rows = [{"id": "7", "name": "n"}, {"id": "abc", "name": "n"}, {"id": 8, "name": "n"}]
    (folder / "artists_2026_05_01.json").write_text(json.dumps(rows))
    from strata.plans.load import load_landing, load_sanitised, set_up

    store = Store(spark, str(tmp_path / "store"))
    entity = standard_entities(key_type="bigint")["artists"]
    set_up(store, {"artists": entity})
    run = Run("b", "2026-05-01 00:00:00", str(tmp_path / "raw"))
    assert load_landing(store, entity, run).rows_rejected == 1
    assert {r.id for r in store.read(entity.landing).collect()} == {7, 8}
    load_sanitised(store, entity, run)
    assert {r.artist_id for r in store.read(entity.sanitised).collect()} == {"7", "8"}


def test_serial_landing(spark, tmp_path):
    from strata.plans.load import refresh_landing
    from strata.schemas import LANDING_SERIAL
    from strata.sinks.store import TableDef

    folder = tmp_path / "raw" / "artists"
    folder.mkdir(parents=True)
    store = Store(spark, str(tmp_path / "store"))
    table = TableDef("landing", "lnd_artists_serial", LANDING_SERIAL, ("ingestion_id",))
    store.create_if_absent(table)
    entity = standard_entities()["artists"]
    run = Run("b", "2026-05-01 00:00:00", str(tmp_path / "raw"))
    for n in (30, 20):
        (folder / "artists_2026_05_01.json").write_text(json.dumps([{"i": i} for i in range(n)]))
        assert refresh_landing(store, entity, run, table).rows_good == n
    got = {r.ingestion_id: json.loads(r.payload)["i"] for r in store.read(table).collect()}
    assert got == {i + 1: i for i in range(20)}


def test_what_a_stopped_run_leaves_out_is_named(spark, responses):
    twice = responses.unionByName(responses.withColumn("run_id", F.lit("other")))
    bad = twice.withColumn("body", F.when((F.col("run_id") == "other") & (F.col("ord") == 1), "{").otherwise(F.col("body")))
    limits = Limits(STOP)
    left = unused_responses(bad, limits)
    got = sorted((r.run_id, r.endpoint, r.ord, r.reject_reason) for r in left.collect())
    after = [("run", "artist", 3, "status 503"), *(("run", "artist", i, "after a failure") for i in (4, 5))]
    assert [g for g in got if g[:2] == ("run", "artist")] == after
    assert [g[2:] for g in got if g[:2] == ("other", "release")][0] == (1, "body is not JSON")
    from strata.plans.extract import usable

    parts = [bad.where(F.col("endpoint") == e) for e in ("artist", "release")]
    assert sum(usable(p, STOP).count() for p in parts) + left.count() == sum(p.count() for p in parts)


def test_caps_are_per_run(spark, responses):
    from strata.plans.extract import search_artists

    twice = responses.unionByName(responses.withColumn("run_id", F.lit("other")))
    found = search_artists(twice.where("endpoint = 'artist' and request_key = 'Ana'"), Limits(artists_per_search=1))
    assert found.count() == 2


def test_appends_side_by_side(spark, tmp_path):
    from strata.schemas import columns
    from strata.sinks.store import TableDef

    store, table = Store(spark, str(tmp_path)), TableDef("s", "log", columns("id long"))
    store.create_if_absent(table)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: store.append(table, spark.range(n, n + 1)), range(16)))
    assert sorted(r.id for r in store.read(table).collect()) == list(range(16))
    for _ in range(2):
        store.append(table, spark.range(100, 103), key="batch 1")
    assert store.read(table).count() == 19
