"""Split array scans against the scan of whole files, on ranges of every size."""

import json
import random

import pytest

from strata.sources import array_split, snapshots


def odd_value(rng, deep=0):
    kind = rng.randrange(9 if deep < 3 else 7)
    if kind == 7:
        return {rng.choice(["a", "b}", "c\\", 'd"', "é{"]): odd_value(rng, deep + 1) for _ in range(rng.randrange(4))}
    if kind == 8:
        return [odd_value(rng, deep + 1) for _ in range(rng.randrange(4))]
    return [None, True, rng.randrange(99), 1.5, "", 'q"}],{[\\', "一😀}" * rng.randrange(60)][kind]


def odd_files(rng):
    """Texts of files: valid in every layout, or broken in one place."""
    for i in range(30):
        rows = [odd_value(rng) for _ in range(rng.choice([0, 1, 2, 40]))]
        text = json.dumps(rows, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 2, 4]), separators=rng.choice([None, (",", ":")]))
        yield rng.choice(["", " \n"]) + text + rng.choice(["", "\n", "  "])
        if i % 2:
            at = rng.randrange(len(text))
            yield text[:at] + rng.choice(['"', "}", "]", "[", ",", "\\", "x", ""]) + text[at + 1 :]
    yield from ('{"a": 1}', '{"a": [1, {"b": "}"}]}', '{"a": 1', "[", "]", "[]", "[ ]", "[,]", "[1,]", "[1 2]", "[1}", "[{]}", "[1]]", "[1] [2]",
                "[1],", '["a', '"s"', "5", "null", "", "   ", "x", "{}", "[{}]", "[{}}]", '[{"a":"\\}"}]', "[[],[[]],{}]", "[1]x", '{"a":1} {"b":2}')


@pytest.fixture
def folder(tmp_path):
    rng = random.Random(4)
    for i, text in enumerate(odd_files(rng)):
        (tmp_path / f"f{i:03d}.json").write_text(text, encoding="utf-8")
    big = [{"id": i, "name": "x}" * rng.randrange(5), "n": [i, {"k": "]"}]} for i in range(600)] + ["long }" * 2000]
    (tmp_path / "big.json").write_text(json.dumps(big))
    (tmp_path / "bigbad.json").write_text(json.dumps(big)[:-1])
    (tmp_path / "number.json").write_text("[" + ",".join(map(str, range(900))) + "]")
    return str(tmp_path)


def found(df):
    return sorted((r._ord.src_file, r._ord.block, r._ord.pos, r._ord.part, r.element) for r in df.collect())


@pytest.mark.parametrize("split, broadcast", [(700, True), (4000, False), (134217728, True)])
def test_split_scan_equals_whole_scan(spark, folder, monkeypatch, split, broadcast):
    expected = found(snapshots.read_array_files(spark, folder))
    monkeypatch.setattr(array_split, "BROADCAST_RANGES", 10**6 if broadcast else 0)
    settings = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1", "spark.sql.adaptive.coalescePartitions.enabled": "true"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = found(snapshots.read_split_arrays(spark, folder))
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert [(x[0], x[4]) for x in got] == [(x[0], x[4]) for x in expected]
    assert len({x[:4] for x in got}) == len(got) > 1500
    if split < 1000:
        assert len({x[1] for x in got if "big.json" in x[0]}) > 20  # many ranges have elements of their own


def test_large_files_are_split_and_small_ones_are_not(spark, tmp_path):
    (tmp_path / "a_2026_05_01.json").write_text(json.dumps([{"i": i} for i in range(500)]))
    whole = snapshots.read_arrays(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    try:
        split = snapshots.read_arrays(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [x[4] for x in found(split)] == [x[4] for x in found(whole)] and len({x[1] for x in found(split)}) > 1


def test_states_compose():
    """The maps of ranges, composed, give the state that reading from the start gives."""
    rng = random.Random(1)
    for _ in range(200):
        texts = ["".join(rng.choice('{}[],"a \\"') for _ in range(rng.randrange(12))).encode() for _ in range(30)]
        texts = [t.rstrip(b"\\") for t in texts]
        cuts = sorted(rng.sample(range(1, 30), 4))
        inside = deep = 0
        for a, b in zip([0, *cuts], [*cuts, 30]):
            plain = b"".join(array_split.ESCAPED.sub(b"", t + b"}") for t in texts[:a])
            state, level = 0, 0
            for c in plain.decode():
                state ^= c == '"'
                level += 0 if state else {"{": 1, "[": 1, "}": -1, "]": -1}.get(c, 0)
            assert (inside, deep) == (state, level)
            now = array_split.Profile({"rid": 0})
            now.add(texts[a:b])
            deep += now.deep[inside]
            inside = (inside + now.flips) % 2
