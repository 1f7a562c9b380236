"""Mixing: apportionment against the plain rule, shares and repeats."""

import random

import numpy as np
import pytest

from axonframe.llm.mixing import highest_quotients, mix_sources, shard_quotas


def plain(weights, seats, caps):
    got = [0] * len(weights)
    for _ in range(seats):
        free = [i for i, w in enumerate(weights) if got[i] < caps[i] and w > 0]
        if not free:
            break
        got[max(free, key=lambda i: (weights[i] / (2 * got[i] + 1), -i))] += 1
    return got


def test_quotients_equal_the_plain_rule():
    r = random.Random(2)
    for _ in range(300):
        n = r.randint(1, 9)
        w = [r.choice([0.0, 0.1, 0.25, 0.3, 1.0, r.random()]) for _ in range(n)]
        caps = [r.choice([0, 1, 3, 50]) for _ in range(n)]
        seats = r.randint(0, 60)
        assert highest_quotients(np.array(w), seats, np.array(caps)).tolist() == plain(w, seats, caps), (w, caps, seats)


def test_shard_quotas_equal_the_plain_rule(spark):
    r = random.Random(3)
    rows = [(s, k, r.choice([1, 40, 40, r.randint(1, 90)]), r.randint(0, 9)) for s in "ab" for k in range(20)]
    held = spark.createDataFrame(rows, "source string, part bigint, t bigint, cap bigint")
    plan = spark.createDataFrame([("a", 60), ("b", 31), ("c", 5)], "source string, quota bigint")
    got = {(x.source, x.part): x.quota for x in shard_quotas(held, plan, 20).collect()}
    for s, q in (("a", 60), ("b", 31)):
        mine = [x for x in rows if x[0] == s]
        want = plain([x[2] for x in mine], q, [x[3] for x in mine])
        assert [got.get((s, k), 0) for k in range(20)] == want
    levels = shard_quotas(held, plan, 20, fan=3).collect()
    assert all(0 < x.quota <= next(y[3] for y in rows if y[:2] == (x.source, x.part)) for x in levels)
    assert {s: sum(x.quota for x in levels if x.source == s) for s in "ab"} == {s: min(q, sum(x[3] for x in rows if x[0] == s)) for s, q in (("a", 60), ("b", 31))}


def docs(n=600):
    r = random.Random(4)
    return [(i, "x" * r.randint(0, 400), r.choice(["a", "A ", "b", "b", "b", "b", "c", None, "other"])) for i in range(n)]


@pytest.mark.parametrize("fan", [4096, 2])
def test_shares_and_repeats(spark, fan):
    df = spark.createDataFrame(docs(), "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 5), ("B", 0.3, 1), ("c", 0.1, 1), ("none", 0.1, 9)], "source string, target_share double, max_repeat int")
    mixture, report = mix_sources(df, targets, block=64, shard_docs=100, fan=fan)
    rows, rep = mixture.collect(), {r.source: r for r in report.collect()}
    size = {i: len(t) + 1 for i, t, _ in docs()}
    total = sum(size.values())
    blocks = {}
    for r in rows:
        assert 0 <= r.start and r.start + r.n_tokens <= size[r.doc_id] and 1 <= r.copies <= {"a": 5, "b": 1, "c": 1}[r.source]
        b = blocks.setdefault((r.source, r.shard, r.block), [0, r.copies])
        b[0] += r.n_tokens
        assert b[0] <= 64 and b[1] == r.copies
    for s in "abc":
        assert rep[s].mixed_tokens == sum(r.n_tokens * r.copies for r in rows if r.source == s)
        assert rep[s].quota_blocks == sum(n for (x, _, _), (_, n) in blocks.items() if x == s) <= max(rep[s].cap_blocks, 0)
        assert rep[s].quota_blocks * 64 - 64 * 5 * 10 <= rep[s].mixed_tokens <= rep[s].quota_blocks * 64
        assert rep[s].short == (rep[s].max_repeat * rep[s].n_tokens < rep[s].target_share * total)
    assert rep["none"].short and rep["none"].mixed_tokens == 0 and sum(r.quota_blocks for r in rep.values()) == round(total / 64)
    again = mix_sources(df.repartition(7), targets, block=64, shard_docs=100, fan=fan)[0].collect()
    assert sorted(again) == sorted(rows)


def test_a_source_taken_whole_loses_nothing(spark):
    df = spark.createDataFrame([(i, "y" * (i * 37 % 200), "a" if i % 2 else "b") for i in range(50)], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 0.9, 2), ("b", 0.1, 1)], "source string, target_share double, max_repeat int")
    mixture, report = mix_sources(df, targets, block=16, shard_docs=10)
    rep = {r.source: r for r in report.collect()}
    took = {}
    for r in mixture.collect():
        took[r.doc_id] = took.get(r.doc_id, 0) + r.n_tokens * r.copies
    assert rep["a"].quota_blocks <= rep["a"].cap_blocks and all(took.get(i, 0) <= 2 * (i * 37 % 200 + 1) for i in range(50))


def test_empty_and_null(spark):
    targets = spark.createDataFrame([("a", 1.0, 1), (None, 0.5, 1), ("n", None, None)], "source string, target_share double, max_repeat int")
    mixture, report = mix_sources(spark.createDataFrame([], "doc_id bigint, text string, source string"), targets)
    assert mixture.count() == 0 and {r.actual_share for r in report.collect()} == {None}
    df = spark.createDataFrame([(None, None, "a", 1), (2, "", " A", 1), (3, "zz", None, 1)], "doc_id bigint, text string, source string, shard int")
    mixture, report = mix_sources(df, targets, block=1)
    assert sorted((r.doc_id is None, r.n_tokens, r.copies) for r in mixture.collect()) == [(False, 1, 1), (True, 1, 1)]
    rep = {r.source: r for r in report.collect()}
    assert rep["a"].actual_share == 1.0 and rep["a"].short and rep["n"].quota_blocks == 0


def test_repeated_rows_are_spread(spark):
    df = spark.createDataFrame([(1, "x" * 9, "a")] * 400 + [(2, "", "b")], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeat int")
    mixture, _ = mix_sources(df, targets, block=7, shard_docs=50)
    rows = mixture.collect()
    assert len({r.shard for r in rows}) == 9 and len({r.copy for r in rows}) == 400
