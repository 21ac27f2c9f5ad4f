"""Type profiles of payloads and drift against a target, against plain Python."""

import json
from collections import Counter

from pyspark.sql import types as T

from strata.sources.drift import schema_drift, type_profile

TARGET = T.StructType(
    [
        T.StructField("a", T.LongType()),
        T.StructField("b", T.StructType([T.StructField("c", T.StringType())])),
        T.StructField("l", T.ArrayType(T.DoubleType())),
    ]
)


def kinds(value, path="$", depth=2):
    name = {type(None): "VOID", bool: "BOOLEAN", int: "BIGINT", float: "DECIMAL", str: "STRING", dict: "OBJECT", list: "ARRAY"}
    yield path, name[type(value)]
    if depth and isinstance(value, dict):
        for k, v in value.items():
            yield from kinds(v, f"{path}.{k}", depth - 1)
    if depth and isinstance(value, list):
        for v in value:
            yield from kinds(v, f"{path}[]", depth - 1)


BODIES = ['{"a":1,"b":{"c":"x","d":[true]},"l":[1.5,2,"s",null]}', '{"a":"1","b":null,"l":[]}', "[1,{}]", "7", '{"a":2}']


def test_profile_equals_a_walk(spark):
    df = spark.createDataFrame([(b, 1) for b in [*BODIES, BODIES[0], "{", None]], "payload string, path int")
    got = {(r.path, r.kind): r.n for r in type_profile(df).collect()}
    want = Counter(k for b in [*BODIES, BODIES[0]] for k in kinds(json.loads(b)))
    assert got == {**want, ("$", "INVALID"): 1}


def test_drift(spark):
    df = spark.createDataFrame([(b,) for b in [*BODIES[:2], BODIES[4]]], "payload string")
    got = {tuple(r) for r in schema_drift(type_profile(df), TARGET).collect()}
    assert got == {
        ("$.a", "retyped", "long", "STRING", 1),
        ("$.b.d", "new", None, "ARRAY", 1),
        ("$.l[]", "retyped", "double", "STRING", 1),
    }


def test_an_empty_snapshot_has_lost_all(spark):
    got = schema_drift(type_profile(spark.createDataFrame([], "payload string")), TARGET).collect()
    assert {(r.path, r.verdict, r.n) for r in got} == {(p, "lost", 0) for p in ("$", "$.a", "$.b", "$.b.c", "$.l", "$.l[]")}
