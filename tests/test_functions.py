import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import column, plan, rows
from strata.functions import clean as C
from strata.functions import payload as P
from strata.functions import stamp as S

X = "x"


def test_null_words(spark):
    values = ["None", "NULL", "null", " none ", "", "text", None]
    assert column(spark, values, C.null_if_sentinel(F.col(X))) == [None, None, None, " none ", "", "text", None]
    assert column(spark, values, C.null_if_sentinel(F.col(X), empty_is_null=True))[4] is None
    assert column(spark, values, C.is_null_word(F.col(X))) == [True, True, True, False, False, False, True]


def test_partial_dates(spark):
    values = ["1989", "2020-05", "2020-13", "2020-01-31", "1989\n", "2020-05\n", "abc", "", "１９８９", None, "198", "19891"]
    assert column(spark, values, C.complete_partial_date(F.col(X))) == [
        "1989-01-01", "2020-05-01", "2020-13-01", "2020-01-31", "1989\n", "2020-05\n", "abc", "", "１９８９", None,
        "198", "19891",
    ]


def test_typed_date_and_flag(spark):
    values = ["2020-13-01", "2020-02-29", "abc", None]
    assert column(spark, values, C.to_day(F.col(X))) == [None, dt.date(2020, 2, 29), None, None]
    assert column(spark, values, C.bad_date(F.col(X))) == [True, False, True, False]


def test_date_rule_is_limited_to_date_columns(spark):
    df = spark.createDataFrame([("1989", "1989", 1989)], "title string, date string, n int")
    assert rows(C.clean_strings(df, ["date"])) == [("1989", "1989-01-01", 1989)]
    assert rows(C.clean_strings(df)) == [("1989", "1989", 1989)]
    assert rows(C.clean_strings(df, None)) == [("1989-01-01", "1989-01-01", 1989)]


def test_truthy_coalesce(spark):
    df = spark.createDataFrame(
        [("", 0, False, "z"), ("a", 1, True, "z"), (None, None, None, "z")], "s string, n int, b boolean, z string"
    )
    assert rows(df.select(C.truthy_coalesce(df, ["s", "z"]))) == [("z",), ("a",), ("z",)]
    assert rows(df.select(C.truthy(F.col("n"), T.IntegerType()), C.truthy(F.col("b"), T.BooleanType()))) == [
        (None, None), (1, True), (None, None),
    ]


def payload(spark, text):
    return P.parsed(spark.createDataFrame([(text,)], "payload string"))


def test_payload_values(spark):
    text = '{"a":1,"a":2,"name":"Zoë","active-years":"q","it\'s":"k","n":null,"l":[1,"x"],"o":{"q":"it\'s \\"b\\""},"f":1.5,"t":true}'
    df = payload(spark, text)
    v = F.col("v")
    got = df.select(
        P.get(v, "$.a", "int"), P.get(v, "$.name"), P.get(v, P.field("active-years")), P.get(v, P.field("it's")),
        P.get(v, "$.n"), P.get(v, "$.l"), P.get(v, "$.o"), P.get_or(v, "$.zz", F.lit("d")), P.get(v, "$.name", "int"),
    ).first()
    assert tuple(got) == (2, "Zoë", "q", "k", None, '[1,"x"]', '{"q":"it\'s \\"b\\""}', "d", None)
    kinds = df.select(*(P.kind(v, f"$.{c}") for c in ("name", "a", "f", "t", "l", "o", "n", "zz"))).first()
    assert tuple(kinds) == ("string", "number", "number", "boolean", "list", "object", "null", None)


@pytest.mark.parametrize(
    "text, key",
    [
        ('{"id":"x","artist_id":"y"}', "x"),
        ('{"id":"","artist_id":"y"}', "y"),
        ('{"id":0,"artist_id":"y"}', "y"),
        ('{"id":"0","artist_id":"y"}', "0"),
        ('{"id":false,"artist_id":7}', "7"),
        ('{"id":[],"artist_id":"y"}', "y"),
        ('{"id":{},"artist_id":"y"}', "y"),
        ('{"id":"[]"}', "[]"),
        ('{"artist_id":"y"}', "y"),
        ('{"id":null}', None),
        ("{}", None),
        ("5", None),
        ("not json", None),
    ],
)
def test_key_alias(spark, text, key):
    from strata.operators.project import key_alias

    assert key_alias(payload(spark, text)).first().id == key


def test_serialise_keeps_null_fields(spark):
    df = spark.createDataFrame([(1, None, "Zoë")], "a int, b string, c string")
    assert df.select(P.serialise("a", "b", "c")).first()[0] == '{"a":1,"b":null,"c":"Zoë"}'


def test_malformed_payload_is_null(spark):
    assert payload(spark, '{"a":').first()[0] is None


def test_payload_is_parsed_once_below_filters(spark):
    from helpers import plan

    df = payload(spark, '{"a": 1}').select(P.get(F.col("v"), "$.a", "int").alias("a")).where("a is not null and a > 0")
    assert plan(df).lower().count("parsejson") == 1


def test_audit_stamps(spark):
    now = dt.datetime(2026, 5, 1, 15)
    df = spark.createDataFrame(
        [(1, None), (2, ""), (3, "none"), (4, "NULL"), (5, "2020-01-02 03:04:05")], "i int, created_at string"
    )
    got = rows(S.audit_stamps(df, now).orderBy("i"), "created_at", "updated_at")
    assert got == [(now, now)] * 4 + [(dt.datetime(2020, 1, 2, 3, 4, 5), now)]
    assert rows(S.audit_stamps(df.select("i"), now).orderBy("i"), "created_at")[0] == (now,)


def test_now_is_one_value_per_query(spark):
    df = spark.range(1000).select(S.moment(None).alias("a"), S.moment(None).alias("b"))
    assert df.distinct().count() == 1 and df.where("a <> b").count() == 0


def test_aware_times_become_utc(spark):
    zone = dt.timezone(dt.timedelta(hours=5, minutes=30))
    got = spark.range(1).select(S.moment(dt.datetime(2026, 5, 1, 15, tzinfo=zone))).first()[0]
    assert got == dt.datetime(2026, 5, 1, 9, 30)


def test_date_and_batch_text(spark):
    ts = F.lit("2026-07-30 17:38:28").cast("timestamp")
    got = spark.range(1).select(S.iso_text(ts), S.date_stamp(ts), S.batch_id(ts, "cv1")).first()
    assert tuple(got) == ("2026-07-30T17:38:28Z", "2026_07_30", "20260730173828_cv1")


def test_column_defaults(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "i int, a string")
    got = S.column_defaults(df, {"a": F.lit("d"), "b": F.lit(0)})
    assert rows(got.orderBy("i")) == [(1, "d", 0), (2, "x", 0)]


def test_fields_of_a_payload_are_sized_in_proportion(spark, tmp_path):
    rows = spark.range(20_000).select(P.serialise("id", F.sha2(F.col("id").cast("string"), 256).alias("more")).alias("payload"))
    rows.write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    size = lambda df: int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    keys = P.parsed(read).select(P.get(F.col("v"), "$.id", "bigint").alias("id"))
    assert size(keys) > 0.3 * size(read)
    assert keys.where("id < 5").count() == 5 and plan(keys.where("id = 5")).count("parseJson") == 1
