"""The shared work folder."""

from oddsline.session import use_utc, work_folder


def test_folder_of_the_cluster_is_used(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first.startswith(f"{root}/x-") and first != second


class Unset:
    """A session without ``spark.checkpoint.dir``."""

    conf = {"spark.sql.warehouse.dir": "hdfs://store/warehouse"}

    class sparkContext:
        @staticmethod
        def getCheckpointDir():
            return None


def test_without_setting_the_warehouse_is_used():
    first, second = work_folder(Unset, "a"), work_folder(Unset, "b")
    assert first.startswith("hdfs://store/warehouse/_work/a-") and first != second


def test_time_zone(spark):
    assert use_utc(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_partitions_of_batch_and_live_jobs():
    from oddsline import session

    assert int(session.BATCH_OPTIONS["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 10000
    assert int(session.STREAM_OPTIONS["spark.sql.shuffle.partitions"]) <= 64
