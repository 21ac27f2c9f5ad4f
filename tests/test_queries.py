"""Every registered query against its check SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as contract
import check
import queries as registered
from helpers import plan

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(registered.runners())
WRITES = {"snapshot_write", "snapshot_partitions", "landing_load", "sanitised_load", "archived_version",
          "curation_stage", "full_refresh", "extraction_run", "sanitised_rejects", "arrival_order",
          "merge_hit_buckets", "incremental_batches", "batch_run", "array_split_scan", "maintained_metrics", "watched_lookup"}


@pytest.fixture(scope="module")
def duck():
    con = check.connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    assert check.compare(spark, duck, FOLDER, name) is None


@pytest.mark.parametrize("name", [n for n in NAMES if n not in WRITES])
def test_plan_shape(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(contract.queries()[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "NestedLoop", "ObjectHashAggregate"):
        assert node not in text, (name, node)
    if name != "surrogate_id":  # its one window runs over one row per partition
        assert "Window [" not in text or "SinglePartition" not in text, name


def test_every_query_has_sql():
    assert set(registered.oracles()) == set(NAMES)


def test_check_sees_differences(spark, duck, monkeypatch):
    wrong = {"key_extract": "SELECT c_custkey + 1 AS id FROM customer"}
    monkeypatch.setattr(contract, "oracle_sql", lambda: wrong)
    assert check.compare(spark, duck, FOLDER, "key_extract").startswith("values")


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["name", "total_songs"] and df.count() > 0


def test_partial_aggregation_precedes_every_shuffle(spark):
    for name in ("songs_per_artist", "artist_metrics", "upsert_overwrite", "batch_rollup", "recording_metrics"):
        lines = plan(contract.queries()[name](spark, FOLDER)).splitlines()
        shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
        assert shuffles, name
        aggregated = [i for i in shuffles if "Aggregate" in lines[i + 1]]
        assert aggregated, name


def test_top_k_sorts_only_what_it_keeps(spark):
    for name in ("head5", "most_active"):
        assert "TakeOrderedAndProject" in plan(contract.queries()[name](spark, FOLDER)), name


def test_scans_are_pruned(spark):
    text = plan(contract.queries()["songs_per_artist"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text
    text = plan(contract.queries()["country_filter"](spark, FOLDER))
    assert "EqualTo(r_name,ASIA)" in text
