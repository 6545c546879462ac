import os
import random

import pytest
from conftest import final_plan
from pyspark.sql import functions as F

from dosewise.llm import simhash, tables
from dosewise.llm.components import components, handed


@pytest.fixture()
def small_pieces(conf):
    conf(
        spark_sql_autoBroadcastJoinThreshold="-1",
        spark_sql_shuffle_partitions="40",
        spark_sql_adaptive_advisoryPartitionSizeInBytes="64k",
        spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes="64k",
        spark_sql_adaptive_skewJoin_skewedPartitionFactor="2",
        spark_sql_adaptive_maxShuffledHashJoinLocalMapThreshold="0",
    )


def roots(links):
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in links:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    return {x: find(x) for x in root}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(70)]  # a chain
    links += [(2000, 2001 + i) for i in range(90)] + [(5, 5)]  # a hub, and a node with itself
    found = components(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.root for r in found} == {k: v for k, v in roots([p for p in links if p[0] != p[1]]).items()}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_a_hub_is_split(spark, small_pieces):
    """A node with 400,000 links is handed on by several tasks."""
    links = spark.range(1, 400_001, 1, 8).select(F.lit(0).cast("bigint").alias("u"), F.xxhash64("id").alias("v"))
    links = tables.stored(links.union(spark.range(1000, 3000).selectExpr("id as u", "id + 5000 as v")), "hub")
    least = tables.stored(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    joined = handed(links, least)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 402_000 - 2_001  # all but those that are the least themselves


def test_a_long_posting_list_is_split(spark, small_pieces):
    postings = tables.stored(spark.range(0, 300_000, 1, 8).selectExpr("id as fingerprint", "0 as list", "if(id % 3 = 0, 0, id) as key"), "p")
    sizes = tables.stored(postings.groupBy("list", "key").agg(F.count("*").alias("n")), "sizes")
    assert "skew=true" in final_plan(postings.join(sizes, ["list", "key"]))


def test_rounds_leave_one_table_behind(spark):
    folder = tables.run_folder(spark).removeprefix("file:")
    links = spark.createDataFrame([(i, i + 1) for i in range(20)], "u bigint, v bigint")
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    assert components(links).count() == 21
    assert len(set(os.listdir(folder)) - before) == 1
    kept = tables.stored(spark.range(3).toDF("x"), "kept")
    assert kept.count() == 3
    tables.drop(kept)
    assert not any(name.startswith("kept-") for name in os.listdir(folder))
    tables.drop(spark.range(3).toDF("x"))  # nothing stored: nothing happens
    assert simhash.near_duplicates(spark.createDataFrame([(1, "a"), (2, "a")], "doc_id bigint, text string")).count() == 2
