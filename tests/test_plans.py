"""Joins beyond their broadcast bounds, lineage cuts."""

import os
import random

import pytest
from pyspark.sql import functions as F

from axonframe.plans import cut_lineage, discard, joins, shared_dir
from axonframe.plans.tree import tree_levels


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_lookup_join_keeps_rows_without_a_key(spark, monkeypatch, most):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", most)
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (4, None), (5, "a")], "i int, k string")
    table = spark.createDataFrame([("a", 10), ("b", 20)], "k string, v int")
    got = joins.lookup_join(df, table, "k").select("i", "k", "v")
    assert rows(got) == rows(spark.createDataFrame([(1, "a", 10), (2, None, None), (3, "z", None), (4, None, None), (5, "a", 10)], "i int, k string, v int"))
    assert rows(joins.lookup_join(df, table, "k", how="inner").select("i")) == [(1,), (5,)]


@pytest.mark.parametrize("bound", [0, 1 << 20])
def test_skew_safe_join(spark, monkeypatch, bound):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", bound)
    monkeypatch.setattr(joins, "HOT_GROUPS", 4)
    r = random.Random(1)
    data = [(r.choice([1] * 20 + list(range(40))), i) for i in range(500)]
    df = spark.createDataFrame(data, "k int, i int")
    states = df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k <> 7")
    got = joins.skew_safe_join(df, states, "k", F.col("n"), len(data))
    n = {k: sum(1 for x, _ in data if x == k) for k, _ in data}
    assert rows(got.select("k", "i", "n")) == sorted([(k, i, n[k]) for k, i in data if k != 7], key=str)
    assert joins.skew_safe_join(df.limit(0), states, "k", F.col("n"), 0).count() == 0


def test_cut_lineage_writes_to_the_shared_folder(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    cut = cut_lineage(df)
    assert rows(cut) == rows(df) and cut.schema == df.schema
    assert all(f.startswith(shared_dir(spark)) or f.startswith(shared_dir(spark).replace("file://", "file:")) or shared_dir(spark).removeprefix("file://") in f for f in cut.inputFiles())
    assert cut_lineage(df.limit(0)).count() == 0


def test_size_of_a_broadcast_counts_texts(spark):
    df = spark.createDataFrame([(1, "x" * 1000), (2, None)], "a int, b string")
    assert joins.table_bytes(df) == 2 * (joins.ROW_BYTES + 16) + 1000 and joins.table_bytes(df.limit(0)) == 0
    assert joins.fits_broadcast(df) and not joins.fits_broadcast(df.crossJoin(spark.range(40000)))


def test_cuts_are_deleted(spark):
    cut = cut_lineage(spark.range(3).toDF("a"))
    path = cut.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    discard(cut, spark.range(1))
    assert not os.path.exists(path)


def test_the_tree_follows_the_partitions():
    assert [tree_levels(n, 8) for n in (1, 64, 65, 8**5, 8**5 + 1, 8**9)] == [2, 2, 3, 5, 6, 9]
