import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from strata.operators.filters import split_objects
from strata.schemas import REGISTRY, columns
from strata.sinks.snapshots import write_partitioned_snapshot, write_snapshot
from strata.operators import filters
from strata.sources import responses, snapshots, tables


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def test_newest_snapshot(spark, tmp_path):
    for day in ("2026_05_02", "2026_04_30", "2026_05_01"):
        write(tmp_path, f"artists_{day}.json", "[]")
    write(tmp_path, "releases_2026_06_01.json", "[]")
    path = snapshots.latest_snapshot_path(spark, str(tmp_path), "artists")
    assert path.endswith("artists_2026_05_02.json")
    assert snapshots.dated_snapshot_path("d", "artists", dt.date(2026, 5, 1)) == "d/artists_2026_05_01.json"
    for folder in (tmp_path, tmp_path / "missing"):
        with pytest.raises(FileNotFoundError):
            snapshots.latest_snapshot_path(spark, str(folder), "urls")


@pytest.mark.parametrize(
    "text, n, objects",
    [
        ('[{"a": 1}, {"a": 2}]', 2, 2),
        (' \n{"a": 1}\n ', 1, 1),
        ("[]", 0, 0),
        ('[{"a": 1}, {"a":', 0, 0),
        ("", 0, 0),
        ('[{"a": 1}, 5, "s", null, [1]]', 5, 1),
        ("null", 1, 0),
    ],
)
def test_array_file(spark, tmp_path, text, n, objects):
    read = snapshots.read_array_files(spark, write(tmp_path, "a.json", text))
    good, bad = split_objects(read)
    assert (read.count(), good.count(), bad.count()) == (n, objects, n - objects)


def test_invalid_files_are_listed(spark, tmp_path):
    write(tmp_path, "a.json", "[]")
    write(tmp_path, "b.json", '[{"a":')
    write(tmp_path, "c.json", "null")
    bad = rows(snapshots.invalid_array_files(spark, str(tmp_path)))
    assert [r[0].rsplit("/", 1)[1] for r in bad] == ["b.json"]


def test_arrival_order_of_array_files(spark, tmp_path):
    write(tmp_path, "a.json", json.dumps([{"i": i} for i in range(50)]))
    write(tmp_path, "b.json", json.dumps([{"i": i} for i in range(50, 80)]))
    read = snapshots.read_array_files(spark, str(tmp_path)).repartition(7)
    order = [json.loads(r[0])["i"] for r in read.orderBy("_ord").select("element").collect()]
    assert order == list(range(80))


@pytest.mark.parametrize("layout", ["lines", "indented"])
def test_large_file_is_split_and_keeps_order(spark, tmp_path, layout):
    objects = [{"i": i, "t": "a }, {\n    },\n ] " * (i % 4), "n": {"l": [1, {"z": None}]}} for i in range(3000)]
    if layout == "lines":
        path = write(tmp_path, "x.jsonl", "\n".join(json.dumps(o, ensure_ascii=False) for o in objects))
    else:
        path = write(tmp_path, "x.json", json.dumps(objects, indent=4, ensure_ascii=False))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = snapshots.READERS[layout](spark, path)
        assert read.rdd.getNumPartitions() > 5
        got = [json.loads(r[0]) for r in read.repartition(5).orderBy("_ord").select("element").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == objects


@pytest.mark.parametrize(
    "objects",
    [
        [], [{}], [5], [{"a": 1}], [{"a": 1}, {"b": [{"c": {}}]}], [{}, {}], [{"a": 1}, 5, {"b": 2}, {}, "s", [{"x": 1}], {"c": 3}],
        [[1], {"a": [[1], [2]]}, [{}, {"z": []}]], [{"a": 1}, 7], [{"t": "]\\n]"}, {"t": "x"}],
    ],
)
def test_indented_edges(spark, tmp_path, objects):
    path = write(tmp_path, "x.json", json.dumps(objects, indent=4))
    read = snapshots.read_indented_arrays(spark, path).orderBy("_ord").select("element")
    got = [json.loads(r[0]) for r in read.collect()]
    assert got == objects


def test_snapshot_write(spark, tmp_path):
    df = spark.createDataFrame([('{"n":"Zoë"}',), ('{\n  "n":\r\n"two\\nlines"\n}',)], "element string")
    path = write_snapshot(df, str(tmp_path), "artists", dt.date(2026, 5, 1))
    write_snapshot(df.limit(1), str(tmp_path), "artists", dt.date(2026, 5, 1))
    assert snapshots.read_json_lines(spark, path).count() == 1
    write_snapshot(df, str(tmp_path), "artists", dt.date(2026, 5, 2))
    newest = snapshots.latest_snapshot_path(spark, str(tmp_path), "artists", "jsonl")
    got = {json.loads(r[0])["n"] for r in rows(snapshots.read_json_lines(spark, newest), "element")}
    assert got == {"Zoë", "two\nlines"}


def test_partitioned_snapshot(spark, tmp_path):
    folder = str(tmp_path / "s")
    df = spark.createDataFrame([("{}",), ("{}",)], "element string")
    write_partitioned_snapshot(df, folder, dt.date(2026, 5, 1))
    write_partitioned_snapshot(df, folder, dt.date(2026, 5, 2))
    write_partitioned_snapshot(df.limit(1), folder, dt.date(2026, 5, 2))
    days = spark.read.schema("value string, snapshot_date date").text(folder)
    assert sorted(rows(days.groupBy("snapshot_date").count())) == [(dt.date(2026, 5, 1), 2), (dt.date(2026, 5, 2), 1)]
    assert snapshots.latest_rows(days, "snapshot_date").count() == 1


def test_day_filters_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    text = plan(snapshots.dated_rows(events, "ts", dt.date(2024, 1, 5)).select("event_id"))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "GreaterThanOrEqual(ts" in plan(snapshots.latest_day_rows(events, "ts"))
    mark = F.lit("2024-01-20").cast("timestamp_ntz")
    assert "GreaterThan(ts" in plan(tables.changed_since(events, mark, "ts"))


def test_envelopes(spark):
    df = spark.createDataFrame(
        [(1, '{"artists":[{"id":"a"},{"id":"b"}]}'), (2, '{"artists":[]}'), (3, '{"error":1}'), (4, "broken")],
        "k int, body string",
    )
    got = rows(responses.unwrap_envelope(df, "artists").orderBy("k", "pos"))
    assert got == [(1, 0, '{"id":"a"}'), (1, 1, '{"id":"b"}')]
    good, missing = responses.split_strict_envelope(df, "artists")
    assert good.count() == 2
    assert sorted(rows(missing, "k", "reject_reason")) == [(3, "no artists in body"), (4, "no artists in body")]


def test_concat_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "i int, a string")
    b = spark.createDataFrame([(1, 2.0)], "i int, b double")
    got = sorted(rows(responses.concat_all(a, b, a), "i", "a", "b"), key=str)
    assert got == [(1, "x", None), (1, "x", None), (1, None, 2.0)]


def test_responses_read_with_fixed_schema(spark, tmp_path):
    line = {"run_id": "r", "endpoint": "artist", "request_key": "k", "ord": 1, "status_code": 200, "body": "{}", "x": 1}
    path = write(tmp_path, "r.jsonl", json.dumps(line) + "\n" + json.dumps({**line, "endpoint": "url"}))
    got = responses.read_responses(spark, path, "artist")
    assert rows(got) == [("r", "artist", "k", 1, 200, "{}")]


def test_target_schema(spark):
    assert tables.target_schema(spark, "landing.lnd_artists", REGISTRY).fieldNames() == [
        "id", "payload", "created_at", "updated_at", "etl_batch_id",
    ]
    spark.createDataFrame([(1, "a")], "n int, t string").createOrReplaceTempView("some_target")
    assert tables.target_schema(spark, "some_target", {}).fieldNames() == ["n", "t"]
    with pytest.raises(LookupError):
        tables.target_schema(spark, "nowhere", REGISTRY)


def test_parse_payload(spark):
    df = spark.createDataFrame([(1, '{"a":1,"d":"2020-01-02"}'), (2, "broken")], "i int, payload string")
    got = tables.parse_payload(df, columns("a int, d date"))
    assert sorted(rows(got)) == [(1, 1, dt.date(2020, 1, 2)), (2, None, None)]


def test_strings_trailing_text_and_cut_files_give_no_objects(spark, tmp_path):
    bodies = ['["{\\"id\\":\\"fake\\"}", {"id": "real"}]', '[{"id":"1"}] garbage', '{"id":1}],[{"id":2}', '[{"n":12345678901234567890.125}]']
    df = spark.createDataFrame([(b,) for b in bodies], "value string")
    got = [r[0] for r in snapshots.unwrap_arrays(df).collect()]
    objects = rows(filters.split_objects(snapshots.unwrap_arrays(df))[0], "element")
    assert objects == [('{"id":"real"}',), ('{"n":12345678901234567890.125}',)] and len(got) == 3
    text = json.dumps([{"id": "a"}, {"id": "b", "name": "b", "z": {"y": 1}}], indent=4)
    whole = write(tmp_path, "whole.json", text)
    cut = write(tmp_path, "cut.json", text[: text.index(',\n        "z"')])
    single = write(tmp_path, "single.json", json.dumps({"id": "a", "z": {"y": 1}}, indent=4))
    assert snapshots.read_indented_arrays(spark, whole).count() == 2
    assert snapshots.read_indented_arrays(spark, [cut, single]).count() == 0


def test_unfinished_snapshots_are_passed_over(spark, tmp_path):
    df = spark.createDataFrame([("{}",)], "element string")
    write_snapshot(df, str(tmp_path), "artists", dt.date(2026, 5, 1))
    (tmp_path / "artists_2026_05_02.jsonl" / "_temporary").mkdir(parents=True)
    assert snapshots.latest_snapshot_path(spark, str(tmp_path), "artists", "jsonl").endswith("2026_05_01.jsonl")


def test_part_files_sort_by_number(spark):
    names = ["d/part-99999-a.txt", "d/part-100000-a.txt", "d/part-00002-a.txt", "d/other.json"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = [r.p for r in df.orderBy(snapshots.file_order("p")).collect()]
    assert got == ["d/other.json", "d/part-00002-a.txt", "d/part-99999-a.txt", "d/part-100000-a.txt"]
