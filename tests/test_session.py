"""The shared work folder."""

from types import SimpleNamespace

import pytest

from strata import session


def asked(spark, **settings):
    """The session's file systems under other settings."""
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings.get(key.replace(".", "_"), default)),
        _jvm=spark._jvm,
        _jsparkSession=spark._jsparkSession,
    )


@pytest.mark.parametrize("warehouse", ["/some/warehouse", "file:/some/warehouse/"])
def test_a_local_warehouse_is_refused_on_a_cluster_alone(spark, warehouse):
    local = asked(spark, spark_master="local[4]", spark_sql_warehouse_dir=warehouse)
    assert session.work_dir(local) == warehouse.rstrip("/") + "/_strata_work"
    far = asked(spark, spark_master="spark://host:7077", spark_sql_warehouse_dir=warehouse)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(far)


def test_the_named_folder_is_taken_as_it_is(spark):
    far = asked(spark, spark_master="spark://host:7077", spark_sql_warehouse_dir="/w", spark_checkpoint_dir="/shared/")
    assert session.work_dir(far) == "/shared"
