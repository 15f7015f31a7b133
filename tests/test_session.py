import pytest
from pyspark.errors import AnalysisException

from chatterlens import session


def pretend(master, **settings):
    """A stand-in for a session with the given master and settings."""

    class Session:
        class sparkContext:
            pass

        class conf:
            get = staticmethod(lambda name, default=None: settings.get(name.replace(".", "_"), default))

    Session.sparkContext.master = master
    Session.sparkContext.applicationId = "app-1"
    Session.sparkContext.environment = {}
    return Session


def test_shared_folder_is_new_and_below_the_named_place():
    cluster = pretend("yarn", spark_checkpoint_dir="hdfs://shared/place/")
    first, second = (session.shared_folder(cluster, "x") for _ in range(2))
    assert first != second and first.startswith("hdfs://shared/place/chatterlens/app-1/x-")


def test_shared_folder_lies_in_the_warehouse_if_no_place_is_named():
    for master in ("yarn", "local[2]"):
        folder = session.shared_folder(pretend(master, spark_sql_warehouse_dir="hdfs://tables"), "x")
        assert folder.startswith("hdfs://tables/chatterlens/app-1/x-")


def test_a_sessions_folders_can_be_dropped(spark):
    folder = session.shared_folder(spark, "x")
    spark.range(3).write.parquet(folder)
    session.drop_shared_folders(spark)
    with pytest.raises(AnalysisException):
        spark.read.parquet(folder)


def test_prepare(spark):
    session.prepare(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert "RocksDB" not in spark.conf.get(session.STATE_STORE)
    changed = {}
    cluster = pretend("yarn", **{session.STATE_STORE.replace(".", "_"): "x.HDFSBackedStateStoreProvider"})
    cluster.conf.set = staticmethod(changed.__setitem__)
    session.prepare(cluster)
    assert changed[session.STATE_STORE] == session.ROCKSDB
