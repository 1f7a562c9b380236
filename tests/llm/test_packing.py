"""Packing: capacities hold, nothing is lost, little space is."""

import random

import numpy as np
import pytest

from axonframe.llm.packing import Capacity, best_fit, pack_documents

SCHEMA = "doc_id bigint, text string"


def check(rows, docs, cap):
    bins, pieces = {}, {}
    for r in rows:
        assert 1 <= r.n_tokens <= cap.tokens
        bins.setdefault(r.container, []).append(r.n_tokens)
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.n_tokens))
    for sizes in bins.values():
        assert sum(sizes) <= cap.tokens and len(sizes) <= cap.documents and sum((s / cap.tokens) ** 2 for s in sizes) - (max(sizes) / cap.tokens) ** 2 <= cap.cost + 1e-9
    for i, text in docs:
        size = len((text or "").encode()) + 1
        mine = sorted(pieces[i])
        assert sum(p[2] for p in mine) == size and len(mine) == -(-size // cap.tokens)
        assert [p[1] for p in mine] == [k * cap.tokens for k in range(len(mine))]
    return bins


@pytest.mark.parametrize("cap", [Capacity(100, 5), Capacity(100, 5, rule="dot"), Capacity(100, 1000, 0.02)])
def test_capacities_and_completeness(spark, cap):
    r = random.Random(3)
    docs = [(i, "é" * r.choice([0, 1, 5, 20, 33, 49, 50, 51, 180])) for i in range(400)] + [(1000, None), (1001, ""), (1002, "a" * 99), (1003, "a" * 100)]
    rows = pack_documents(spark.createDataFrame(docs, SCHEMA), cap, shard_items=64).collect()
    assert len(rows) == len({(r.doc_id, r.piece) for r in rows})
    check(rows, docs, cap)


def test_little_space_is_left(spark):
    r = random.Random(5)
    docs = [(i, "a" * int(r.lognormvariate(4, 1))) for i in range(2000)]
    cap = Capacity(1000, 256)
    bins = check(pack_documents(spark.createDataFrame(docs, SCHEMA), cap, shard_items=500).collect(), docs, cap)
    assert sum(map(sum, bins.values())) / (len(bins) * cap.tokens) > 0.97


def test_empty_table_and_clashing_columns(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, "ab", 4, 4), (None, "ab", 4, 4)], SCHEMA + ", shard int, bin int")
    assert sorted((r.doc_id is None, r.n_tokens) for r in pack_documents(df).collect()) == [(False, 3), (True, 3)]


def test_cost_constraint():
    """The cost beside the largest piece binds: halves do not go together, and a large piece still takes small ones."""
    sizes = [90, 50, 50, 40, 30, 10, 10]
    place = best_fit(np.array(sizes), Capacity(100, 10, 0.1))
    bins = {}
    for b, s in zip(place, sizes, strict=True):
        bins.setdefault(b, []).append(s)
    assert all(sum(s * s for s in v) - max(v) ** 2 <= 1000 for v in bins.values())
    assert sorted(map(sorted, bins.values())) == [[10, 40, 50], [10, 90], [30, 50]] or len(bins) <= 4
    with pytest.raises(ValueError):
        best_fit(np.array([101]), Capacity(100, 10, 0.4))


def test_containers_do_not_follow_from_the_layout(spark):
    docs = [(i % 40, "a" * (i % 97)) for i in range(300)] + [(7, "b" * 250)] * 3
    df = spark.createDataFrame(docs, SCHEMA)
    cap = Capacity(100, 5)
    one = pack_documents(df.repartition(1), cap, shard_items=64).collect()
    assert sorted(one) == sorted(pack_documents(df.repartition(7), cap, shard_items=64).collect()) and len(one) == 300 + 9
