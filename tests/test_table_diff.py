"""Table differences against brute force."""

import datetime as dt
import random

import pytest

from axonframe.operators.table_diff import Field, diff_tables

SCHEMA = "k bigint, r string, a bigint, x double, nt string, loaded_at timestamp"
FIELDS = [Field("a"), Field("x", 0.0045), Field("nt")]


def standing(rows):
    out = {}
    for k, r, a, x, nt, at in rows:
        key = (k, r)
        stamp = at or dt.datetime(1, 1, 1)
        if key not in out or stamp > out[key][0]:
            out[key] = (stamp, a, x, nt)
    return out


def brute(main, mirror):
    m, c = standing(main), standing(mirror)
    out = []
    for key in m.keys() | c.keys():
        if key not in c:
            out.append((*key, "only_main"))
        elif key not in m:
            out.append((*key, "only_mirror"))
        else:
            (_, a, x, nt), (_, b, y, mt) = m[key], c[key]
            out += [(*key, "a")] * (a != b) + [(*key, "nt")] * (nt != mt)
            out += [(*key, "x")] * ((x is None) != (y is None) or x is not None and abs(x - y) > 0.0045)
    return sorted(out, key=str)


def table(seed, n, like=None):
    r = random.Random(seed)
    t = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)
    rows = list(dict.fromkeys(like)) if like else [(r.choice([None, *range(n)]), r.choice([None, "", "u"]), r.randint(0, 3), r.choice([None, 0.5, 0.25]), r.choice([None, "gaba"]), t(i)) for i in range(n)]
    if like:
        for i in range(len(rows)):
            if r.random() < 0.2:
                k, g, a, x, nt, at = rows[i]
                rows[i] = r.choice([(k, g, a + 1, x, nt, at), (k, g, a, (x or 0) + 0.004, nt, at), (k, g, a, (x or 0) + 0.005, nt, at), (k, g, a, x, "da", at), (k, "new", a, x, nt, at)])
    return rows + r.sample(rows, min(5, len(rows)))


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    main = table(seed, 200)
    mirror = table(seed + 50, 0, like=main)
    got = diff_tables(spark.createDataFrame(main, SCHEMA), spark.createDataFrame(mirror, SCHEMA), ["k", "r"], FIELDS, rows_per_bucket=4)
    assert sorted(map(tuple, got.collect()), key=str) == brute(main, mirror)


def test_nulls_count_by_their_place(spark):
    t = dt.datetime(2024, 1, 1)
    schema = "pre bigint, post bigint, v bigint, loaded_at timestamp"
    a, b = spark.createDataFrame([(None, 5, 1, t), (6, 7, 1, t)], schema), spark.createDataFrame([(5, None, 1, t), (6, 7, 1, t)], schema)
    assert sorted(map(tuple, diff_tables(a, b, ["pre", "post"], [Field("v")]).collect()), key=str) == [(5, None, "only_mirror"), (None, 5, "only_main")]


def test_equal_copies_and_empty_ones(spark):
    main = table(1, 50)
    df, none = spark.createDataFrame(main, SCHEMA), spark.createDataFrame([], SCHEMA)
    assert diff_tables(df, df, ["k", "r"], FIELDS).count() == 0
    assert diff_tables(none, none, ["k", "r"], FIELDS).count() == 0
    assert {r["diff"] for r in diff_tables(df, none, ["k", "r"], FIELDS).collect()} == {"only_main"}
    assert {r["diff"] for r in diff_tables(none, df, ["k", "r"], FIELDS).collect()} == {"only_mirror"}


def test_clashing_columns_and_hot_key(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(7, 1, i, t + dt.timedelta(seconds=i), 0, 0) for i in range(300)] + [(8, 1, 5, t, 0, 0)]
    df = spark.createDataFrame(rows, "id bigint, v bigint, w bigint, loaded_at timestamp, bucket int, mask int")
    other = spark.createDataFrame(rows[:299] + rows[300:], df.schema)
    assert [tuple(r) for r in diff_tables(df, other, ["id"], [Field("v"), Field("w")]).collect()] == [(7, "w")]
