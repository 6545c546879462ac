import pytest
from pyspark import SparkConf

from dosewise.session import HASH_JOIN_LIMIT, build_session, hash_join_limit, shuffle_partitions, tune


def test_tune_only_fills_in_what_is_off(spark, conf):
    conf(**{HASH_JOIN_LIMIT: "0"})
    tune(spark)
    assert int(spark.conf.get(HASH_JOIN_LIMIT)) == hash_join_limit(spark.sparkContext.getConf()) > 0
    spark.conf.set(HASH_JOIN_LIMIT, "5m")
    assert tune(spark).conf.get(HASH_JOIN_LIMIT) == "5m"


def test_running_session_is_reused(spark):
    assert build_session(master="local[1]", spark_sql_shuffle_partitions="4") is spark


@pytest.mark.parametrize(
    "settings, expected",
    [
        ({"spark.master": "yarn", "spark.executor.memory": "20g", "spark.executor.cores": "5"}, (20 << 30) // 100),
        ({"spark.master": "spark://h:7077", "spark.executor.memory": "2000m"}, (2000 << 20) // 20),
        ({"spark.master": "local[4]", "spark.driver.memory": "8g"}, (8 << 30) // 80),
    ],
)
def test_hash_joins_follow_the_memory_of_a_task(settings, expected):
    conf = SparkConf(False)
    for key, value in settings.items():
        conf.set(key, value)
    assert hash_join_limit(conf) == expected


def test_partitions_follow_the_input():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(100 * 10**12) == 745059
