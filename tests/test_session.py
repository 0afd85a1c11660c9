"""Session helpers and write edge cases."""

from marlstone.schemas import BRONZE
from marlstone.session import JOB_CONF, scale_conf
from marlstone.sources.zones import write_table


def test_scale_conf_sizes_partitions():
    conf = scale_conf(100 * 1024 ** 4, total_cores=8000)      # 100 TiB
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"
    small = scale_conf(1024 ** 3, total_cores=64)              # 1 GiB
    assert int(small["spark.sql.shuffle.partitions"]) == 128    # two per core


def test_empty_table_write_counts_zero(spark, scratch):
    empty = spark.createDataFrame([], BRONZE["staging_order_item_refunds"])
    res = write_table(empty, scratch, "bronze", "staging_order_item_refunds")
    assert res.row_count == 0
    assert spark.read.parquet(res.path).count() == 0


def test_static_broadcasts_are_off_and_measured_ones_on():
    assert JOB_CONF["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert JOB_CONF["spark.sql.adaptive.autoBroadcastJoinThreshold"] == "10MB"
