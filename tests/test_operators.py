import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from strata.functions import payload as P
from strata.operators import audit, constraints as K, curated as A, expand, filters, fold, relate, skew
from strata.operators import project as J
from strata.operators.numbering import add_surrogate_id
from strata.schemas import columns


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# -- projections ---------------------------------------------------------------


def test_projection_follows_target(spark):
    df = frame(spark, [("1", "x", "9", 5)], "id string, extra string, score string, n int")
    got = J.project_to(df, columns("score int, id long, missing date, m int"), {"m": "n"})
    assert got.columns == ["score", "id", "missing", "m"]
    assert rows(got) == [(9, 1, None, 5)]
    assert rows(J.project_to(frame(spark, [("abc",)], "id string"), columns("id long"))) == [(None,)]


def test_release_projection(spark):
    df = frame(spark, [("r", "t", "2020", "IN", "ok", 1)], "id string, title string, date string, country string, status string, x int")
    got = J.release_projection(df, "a1")
    assert got.columns == ["release_id", "artist_id", "title", "date", "country", "status"]
    assert rows(got) == [("r", "a1", "t", "2020", "IN", "ok")]


def test_explode_children(spark):
    body = '{"id":"r","parts":[{"items":[{"k":1},{"k":2}]},{"items":[]},{},{"items":[{"k":3}]}]}'
    df = frame(spark, [("r", body), ("s", "{}"), ("t", "broken")], "id string, payload string")
    fields = (J.Field("k", "$.k", "value", "int"),)
    got = J.sanitise(df, fields, child_steps=("$.parts", "$.items"), keep=("id", "_at"))
    assert sorted(rows(got)) == [("r", [0, 0], 1), ("r", [0, 1], 2), ("r", [3, 0], 3)]
    assert rows(J.sanitise(df.where("id = 's'"), fields, keep=("id", "_at"))) == [("s", [], None)]


def test_sanitise_rules(spark):
    df = frame(
        spark,
        [(1, '{"t":"1989","d":"1989","s":"7","l":[1,"a"]}'), (2, '{"t":"None","d":1989,"s":"x","l":{"a":"it\'s"}}')],
        "i int, payload string",
    )
    fields = (
        J.Field("t", "$.t"), J.Field("d", "$.d", "date_text"), J.Field("day", "$.d", "day"),
        J.Field("s", "$.s", "value", "int"), J.Field("l", "$.l"), J.Field("i2", "i", "column", "int"),
    )
    assert sorted(rows(J.sanitise(df, fields, keep=("i",)))) == [
        (1, "1989", "1989-01-01", dt.date(1989, 1, 1), 7, '[1,"a"]', 1),
        (2, None, "1989", None, None, '{"a":"it\'s"}', 2),
    ]


# -- filters -------------------------------------------------------------------


def responses(spark):
    return frame(
        spark,
        [("a", 1, 200), ("a", 2, 404), ("a", 3, 200), ("b", 1, 200), ("b", 2, 200), ("c", 1, None), ("c", 2, 200)],
        "run_id string, ord int, status_code int",
    )


def test_success_split(spark):
    good, bad = filters.split_successful(responses(spark))
    assert (good.count(), bad.count()) == (5, 2)
    assert {r.reject_reason for r in bad.collect()} == {"status 404", "status ?"}


def test_prefix_before_failure(spark):
    got = filters.before_first_failure(responses(spark))
    assert sorted(rows(got, "run_id", "ord")) == [("a", 1), ("b", 1), ("b", 2)]


def test_terms(spark):
    df = frame(spark, [("Ana",), (" ana ",), ("Bo Larsen",), (None,)], "name string")
    terms = frame(spark, [("ana",), ("Ana",), ("larsen",)], "term string")
    assert sorted(rows(filters.match_terms(df, terms))) == [(" ana ",), ("Ana",)]
    assert sorted(rows(filters.containing_terms(df, ["Larsen"]))) == [("Bo Larsen",)]
    assert filters.containing_terms(df, []).count() == 0
    assert filters.in_country(frame(spark, [("IN",), ("GB",), (None,)], "country string"), "IN").count() == 1


# -- joins that meet a hot key -------------------------------------------------


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_lookup_join_equals_plain_join(spark, how):
    data = [(i, "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"k{i % 11}"), i % 2) for i in range(600)]
    big = frame(spark, data, "i int, k string, g int")
    lookup = frame(spark, [("hot", 1), ("k1", 2), ("k5", 3), ("gone", 4)], "k string, v int")
    mine = skew.lookup_join(big, lookup, ["k"], how, ["i"], hot_rows=100, salts=4)
    plain = big.join(lookup, "k", how)
    assert sorted(rows(mine.select(*plain.columns)), key=str) == sorted(rows(plain), key=str)


def test_hot_rows_are_spread(spark):
    big = spark.range(10000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"))
    lookup = big.select("k").distinct().withColumn("v", F.lit(1))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.lookup_join(big, lookup, ["k"], "left", ["id"], hot_rows=1000, salts=16)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 10000 and max(sizes) < 3500


def test_left_join_many(spark):
    parents = frame(spark, [(1,), (2,), (3,)], "id int")
    children = frame(spark, [(1, "a"), (1, "b"), (9, "c"), (None, "d")], "request_key int, body string")
    got = skew.left_join_many(parents, children, "id", "request_key")
    assert sorted(rows(got, "id", "body"), key=str) == [(1, "a"), (1, "b"), (2, None), (3, None)]


# -- folds ---------------------------------------------------------------------


def batch(spark):
    return frame(
        spark,
        [("k", 1, "a", None, 10), ("k", 2, None, "x", 20), ("k", 3, "c", None, 30), ("j", 1, None, None, 40)],
        "id string, o int, a string, b string, created_at int",
    )


def test_folds(spark):
    b = batch(spark)
    assert sorted(rows(fold.fold_last(b, ["id"], ["o"], first=["created_at"]))) == [
        ("j", None, None, 40), ("k", "c", None, 10),
    ]
    assert sorted(rows(fold.fold_last_non_null(b, ["id"], ["o"], first=["created_at"]))) == [
        ("j", None, None, 40), ("k", "c", "x", 10),
    ]
    assert sorted(rows(fold.fold_first(b, ["id"], ["o"]))) == [("j", None, None, 40), ("k", "a", None, 10)]
    assert sorted(rows(fold.latest_row(b, ["id"], ["o"]), "id", "a", "created_at")) == [("j", None, 40), ("k", "c", 30)]
    assert rows(fold.fold_last(b.select("id"), ["id"], ["id"]).orderBy("id")) == [("j",), ("k",)]


def test_latest_row_carries_variant(spark):
    df = frame(spark, [("k", 1, "{}"), ("k", 2, '{"a":1}')], "id string, o int, p string")
    got = fold.latest_row(df.withColumn("v", P.parse(F.col("p"))), ["id"], ["o"])
    assert rows(got.select("id", P.get(F.col("v"), "$.a", "int"))) == [("k", 1)]


def test_top_n_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    got = fold.top_n(df, ["k"], [F.desc("id")], 2)
    assert sorted(rows(got)) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    text = plan(got)
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_large_n_is_limited_in_parts_first(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 7).alias("k"), "id")
    got = fold.top_n(df, ["k"], [F.desc("id")], 30, group_limit=10)
    assert plan(got).count("Window [") == 2
    assert sorted(rows(got)) == sorted(rows(fold.top_n(df, ["k"], [F.desc("id")], 30)))


# -- constraints ---------------------------------------------------------------


def test_constraints(spark):
    df = frame(spark, [("1", "n", "5"), (None, "n", "5"), ("abc", "n", "5"), ("2", None, "5"), ("3", "n", "x"), ("4", "n", None)],
               "id string, name string, score string")
    rules = K.Constraints(key=("id",), not_null=("name",), types={"id": "bigint", "score": "int"})
    good, bad = K.split(K.check_rows(df, rules))
    assert sorted(rows(good, "id")) == [("1",), ("4",)]
    assert sorted(r.reject_reason for r in bad.collect()) == [
        "id is not bigint", "id is null", "name is null", "score is not int",
    ]


def test_unique_check(spark):
    df = frame(spark, [("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5), (None, 6)], "id string, o int")
    df = K.check_rows(df, K.Constraints(key=("id",)))
    existing = frame(spark, [("c",)], "id string")
    got = {r.o: r.reject_reason for r in K.check_unique(df, ["id"], ["o"], existing).collect()}
    assert got == {1: None, 2: "duplicate key", 3: None, 4: "duplicate key", 5: "id is null", 6: "id is null"}


def test_rejected_row_takes_no_key(spark):
    df = frame(spark, [("a", 1, "bad"), ("a", 2, None)], "id string, o int, reject_reason string")
    got = {r.o: r.reject_reason for r in K.check_unique(df, ["id"], ["o"]).collect()}
    assert got == {1: "bad", 2: None}


def test_counts_while_writing(spark, tmp_path):
    df = frame(spark, [(1, None), (2, "x"), (3, None)], "i int, reject_reason string")
    watched, seen = K.counted(df, "c")
    watched.write.parquet(str(tmp_path / "o"))
    assert seen.get == {"rows_read": 3, "rows_rejected": 1, "rows_good": 2}


# -- numbering -----------------------------------------------------------------


def test_surrogate_ids_are_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("o"), F.lit("p").alias("payload"))
    got = add_surrogate_id(df.repartition(9), ["o"], start_after=100, partitions=6)
    assert got.columns == ["ingestion_id", "o", "payload"]
    assert got.where("ingestion_id <> o + 101").count() == 0
    assert got.select("ingestion_id").distinct().count() == 5000


# -- expansion -----------------------------------------------------------------


def test_expansions(spark):
    parents = frame(spark, [("r1",), ("r2",), ("r3",)], "id string")
    answers = frame(
        spark,
        [("r1", 1, 200, '{"releases":[{"id":"x"},{"id":"y"}]}'), ("r2", 2, 404, '{"error":1}'), ("zz", 3, 200, "{}")],
        "request_key string, ord int, status_code int, body string",
    )
    assert sorted(rows(expand.expand_children(parents, answers, "releases"), "parent_id", "element")) == [
        ("r1", '{"id":"x"}'), ("r1", '{"id":"y"}'),
    ]
    assert rows(expand.detail_ok(parents, answers), "id") == [("r1",)]
    kept = expand.detail_keep_errors(parents, answers)
    assert sorted(rows(kept, "id", "status_code"), key=str) == [("r1", 200), ("r2", 404), ("r3", None)]
    assert expand.expand_children(parents.where("false"), answers, "releases").count() == 0


# -- hierarchy and aggregates --------------------------------------------------


@pytest.fixture(scope="module")
def hierarchy(spark):
    artists = frame(spark, [(1, "Ana", "IN"), (2, "Ana", "GB"), (3, "None yet", "IN")], "artist_id int, name string, country string")
    releases = frame(
        spark,
        [(10, 1, "g1", "Dawn", dt.date(1999, 4, 22), "IN", "Official"), (11, 1, "g1", "Dawn", dt.date(2009, 1, 1), "GB", "Official"),
         (12, 2, "g2", "Tide", dt.date(2008, 1, 1), "IN", None), (13, 99, None, "Lost", None, None, None)],
        "release_id int, artist_id int, group_id string, title string, release_date date, country string, status string",
    )
    recordings = frame(spark, [("s1", 10, "Dawn"), ("s1", 11, "Dawn"), ("s2", 10, "Yard"), ("s3", 12, "Harbour"), ("s9", 77, "?"), (None, 12, "?")],
                       "recording_id string, release_id int, song_name string")
    urls = frame(spark, [("u1", 10), ("u2", 10), ("u3", 12)], "url_id string, release_id int")
    return artists, releases, recordings, urls


def test_songs(spark, hierarchy):
    artists, releases, recordings, _ = hierarchy
    # A recording on two releases counts twice, and namesakes are one name.
    assert rows(A.ranked_songs_per_artist(artists, releases, recordings)) == [("Ana", 4)]
    assert rows(A.most_active(artists, releases, recordings, 1)) == [("Ana", 4)]
    assert relate.artist_songs(artists, releases, recordings).count() == 5
    albums = frame(spark, [("g1", 1, "Dawn"), ("g2", 2, "Tide")], "group_id string, artist_id int, title string")
    assert sorted(rows(relate.artist_albums(artists, albums, releases)))[0] == ("Ana", "Dawn", dt.date(1999, 4, 22))


def test_metrics(spark, hierarchy):
    artists, releases, recordings, urls = hierarchy
    songs = A.songs_per_release(recordings)
    per_artist = A.artist_metrics(artists, releases, songs)
    assert sorted(rows(per_artist)) == [
        (1, "Ana", "IN", 2, 1, 3, dt.date(1999, 4, 22), dt.date(2009, 1, 1)),
        (2, "Ana", "GB", 1, 1, 1, dt.date(2008, 1, 1), dt.date(2008, 1, 1)),
        (3, "None yet", "IN", 0, 0, 0, None, None),
    ]
    assert sorted(rows(A.country_metrics(per_artist))) == [("GB", 1, 1, 1), ("IN", 2, 2, 3)]
    assert sorted(rows(A.release_metrics(releases, recordings, urls))) == [
        (10, 1, 1999, "Official", 2, 2), (11, 1, 2009, "Official", 1, 0), (12, 2, 2008, None, 1, 1), (13, 99, None, None, 0, 0),
    ]
    assert sorted(rows(A.recording_metrics(releases, recordings.where("recording_id is not null")))) == [
        ("s1", 2, 1), ("s2", 1, 1), ("s3", 1, 1), ("s9", 1, 0),
    ]
    assert sorted(rows(A.discography(artists, releases)))[0] == (1, "Ana", 2, dt.date(1999, 4, 22), dt.date(2009, 1, 1), 2, 1)
    assert sorted(rows(A.albums_per_artist(artists, releases))) == [(1, "Ana", 1), (2, "Ana", 1)]
    assert sorted(rows(A.release_trend(releases)), key=str) == [(1999, 1), (2008, 1), (2009, 1), (None, 1)]
    assert sorted(rows(A.artists_by_country(artists))) == [("GB", 1), ("IN", 2)]


def test_tags(spark, hierarchy):
    tagged = frame(spark, [(1, ["folk", "folk", "pop"]), (2, ["folk"]), (3, None)], "artist_id int, tags array<string>")
    bridge = relate.tag_bridge(tagged)
    assert sorted(rows(bridge)) == [(1, "folk"), (1, "pop"), (2, "folk")]
    more = bridge.union(frame(spark, [(3, "pop")], "artist_id int, tag_name string"))
    assert rows(A.tag_counts(more)) == [("folk", 2), ("pop", 2)]  # a tie is ordered by name
    tags = frame(spark, [("folk", 7)], "tag_name string, tag_id int")
    assert sorted(rows(relate.tagged_artists(hierarchy[0], bridge, tags), "name", "tag_id")) == [("Ana", 7), ("Ana", 7)]


def test_orphans(spark, hierarchy):
    artists, releases, recordings, _ = hierarchy
    assert rows(relate.orphans(releases, artists, "artist_id", "artist_id")) == [(99, 1)]
    assert rows(relate.orphan_rows(recordings, releases, "release_id", "release_id"), "recording_id") == [("s9",)]


# -- audit ---------------------------------------------------------------------


def test_reconciliation(spark):
    raw, landed = spark.range(1000), spark.range(1000)
    kept = landed.where(~F.col("id").isin(5, 500, 999))
    at = F.lit("2026-05-01").cast("timestamp")
    first = audit.reconcile(raw, landed, "raw", "lnd", "p", "b", at).first()
    assert (first.diff, first.status) == (0, "PASS")
    second = audit.reconcile(landed, kept, "lnd", "san", "p", "b", at).first()
    assert (second.source_count, second.target_count, second.diff, second.status) == (1000, 997, 3, "FAIL")
    assert sorted(rows(relate.lost_records(landed, kept, ["id"]))) == [(5,), (500,), (999,)]


def test_phase_state(spark):
    log = frame(
        spark,
        [("b1", "load", 1, "STARTED", None, None), ("b1", "load", 2, "FAILED", 0, "boom"), ("b1", "load", 3, "SUCCESS", 10, None),
         ("b1", "clean", 4, "STARTED", None, None), ("b2", "load", 5, "SUCCESS", 7, None)],
        "etl_batch_id string, phase_name string, at int, status string, rows_processed long, error_message string",
    )
    phases = audit.batch_rollup(log, ["at"])
    assert sorted(rows(phases)) == [
        ("b1", "clean", "STARTED", None, False, False, None),
        ("b1", "load", "SUCCESS", 10, True, True, "boom"),
        ("b2", "load", "SUCCESS", 7, True, False, None),
    ]
    assert sorted(rows(audit.batch_outcome(phases))) == [("b1", 2, 1, 10, False), ("b2", 1, 0, 7, True)]
    latest = {(r.etl_batch_id, r.phase_name): r.status for r in audit.phase_status(log, "at").collect()}
    assert latest == {("b1", "load"): "SUCCESS", ("b1", "clean"): "STARTED", ("b2", "load"): "SUCCESS"}
    assert rows(A.request_counts(log, ["phase_name"]).orderBy("phase_name")) == [("clean", 1), ("load", 4)]


def test_a_hot_key_is_spread_by_its_size(spark):
    """A key's rows per task do not grow with the key: ten times ``hot_rows`` takes more than ``salts`` tasks."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}
    held = {k: spark.conf.get(k) for k in settings}
    big = spark.range(4000).select(F.lit("a").alias("k"), F.col("id").alias("i"))
    lookup = spark.createDataFrame([("a", 1)], "k string, v int")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = skew.lookup_join(big, lookup, ["k"], "left", ["i"], hot_rows=100, salts=4)
        sizes = [r["count"] for r in joined.where("v = 1").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 4000 and max(sizes) < 800
