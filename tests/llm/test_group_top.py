"""Top N per group against sorting."""

import random

import pytest

from axonframe.llm.group_top import top_by_bisection

SCHEMA = "g bigint, s bigint, i bigint"


def brute(rows, n):
    groups = {}
    for g, s, i in set(rows):
        if s is not None and i is not None:
            groups.setdefault(g, []).append((-s, i))
    return {(g, -s, i) for g, v in groups.items() for s, i in sorted(v)[: max(n, 0)]}


@pytest.mark.parametrize("n", [0, 1, 3, 50])
def test_equals_sorting(spark, n):
    r = random.Random(n)
    rows = [(r.choice([1, 1, 1, 2, 3, None, 2**60]), r.choice([-5, 0, 1, 1, 7, 2**40, None]), r.randint(-9, 9) + r.choice([0, 2**61])) for _ in range(600)]
    rows += [(9, 4, k) for k in range(300)] + [(8, -(2**63), 2**63 - 1), (8, 2**63 - 1, -(2**63)), (8, 0, 0), (8, 0, None)] + rows[:20]
    got = top_by_bisection(spark.createDataFrame(rows, SCHEMA), "g", "s", "i", n).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == brute(rows, n)


def test_empty_and_clashing_columns(spark):
    assert top_by_bisection(spark.createDataFrame([], SCHEMA), "g", "s", "i", 3).count() == 0
    rows = [(1, 5, 2, "x", 1, 1), (1, 5, 1, "x", 2, 2), (1, 9, 3, "y", 3, 3)]
    df = spark.createDataFrame(rows, "pre bigint, n bigint, k bigint, slot string, phase int, shift int")
    assert set(map(tuple, top_by_bisection(df, "pre", "n", "k", 2).collect())) == {(1, 9, 3), (1, 5, 1)}


def test_groups_beyond_the_broadcast_bound(spark, monkeypatch):
    from axonframe.plans import joins

    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_GROUPS", 5)
    r = random.Random(8)
    rows = [(r.choice([1] * 30 + list(range(20))), r.randint(0, 4), i) for i in range(900)]
    got = top_by_bisection(spark.createDataFrame(rows, SCHEMA), "g", "s", "i", 3).collect()
    assert set(map(tuple, got)) == brute(rows, 3) and len(got) == len(brute(rows, 3))


@pytest.mark.parametrize("kind", ["double", "float", "decimal(10,2)"])
def test_fractional_scores(spark, kind):
    from decimal import Decimal

    make = (lambda x: Decimal(str(x))) if kind.startswith("decimal") else float
    values = [1.9, 1.2, -1.5, -1.25, 0.0, -0.0, 0.5, 1.9, -3.75, 2048.25]
    rows = [(k % 3, make(v), k) for k, v in enumerate(values * 3)] + [(7, make(1.2), 1), (7, make(1.9), 2), (7, None, 3)]
    if not kind.startswith("decimal"):
        rows += [(7, float("nan"), 4), (8, float("inf"), 1), (8, float("-inf"), 2), (8, 1e30, 3)]
    df = spark.createDataFrame(rows, f"g bigint, s {kind}, i int")
    got = top_by_bisection(df, "g", "s", "i", 1)
    want = {}
    for g, s, i in df.collect():
        if s is not None and s == s and (g not in want or (s, -i) > (want[g][0], -want[g][1])):
            want[g] = (s, i)
    assert {r.g: (r.s, r.i) for r in got.collect()} == want and got.schema["s"].dataType == df.schema["s"].dataType


def test_types_without_an_order_of_64_bits(spark):
    df = spark.createDataFrame([(1, "a", 1.5)], "g int, s string, i double")
    for score, ident in (("s", "g"), ("g", "i")):
        with pytest.raises(TypeError):
            top_by_bisection(df, "g", score, ident, 1)
