"""Shared spans against brute force."""

import itertools
import random

import pytest

from axonframe.llm import shared_spans as S

SCHEMA = "doc_id bigint, text string"


def brute_pairs(docs, n):
    grams = {i: {t[k : k + n] for k in range(len(t) - n + 1)} for i, t in docs if i is not None and t is not None}
    return {(a, b) for a in grams for b in grams if a < b and grams[a] & grams[b]}


def brute_share(docs, n):
    grams = {i: {t[k : k + n] for k in range(len(t) - n + 1)} for i, t in docs}
    out = {}
    for i, t in docs:
        marked = set()
        for j, g in grams.items():
            if i != j:
                for k in range(len(t) - n + 1):
                    if t[k : k + n] in g:
                        marked |= set(range(k, k + n))
        out[i] = (len(t), len(marked))
    return out


def corpus(seed, n_docs, alphabet="abcdé字😀"):
    r = random.Random(seed)
    text = lambda n: "".join(r.choice(alphabet) for _ in range(n))
    pool = [text(r.choice([15, 19, 20, 21, 25, 60, 140])) for _ in range(6)]
    docs = []
    for i in range(n_docs):
        parts = [text(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            parts += [r.choice(pool), text(r.randint(0, 30))]
        docs.append((i * 7 + 720575940600000000, "".join(parts)))
    return docs


@pytest.mark.parametrize(("seed", "direct", "fan"), [(0, 10_000, 4096), (1, 1, 4096), (2, 10_000, 1)])
def test_pairs_equal_brute_force(spark, seed, direct, fan, monkeypatch):
    monkeypatch.setattr(S, "DIRECT", direct)
    docs = corpus(seed, 40)
    df = spark.createDataFrame(docs, SCHEMA)
    got = S.shared_pairs(df, min_span=20, chunk_chars=400, fan=fan).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == brute_pairs(docs, 20)


def test_share_equals_brute_force(spark):
    """Some anchors here have few blocks, some more than a span has ways to lie over them."""
    docs = corpus(9, 30) + [(1, "x" * 300), (2, "x" * 70 + "y"), (3, "xy" * 80), (4, "")]
    df = spark.createDataFrame(docs, SCHEMA)
    got = {r.doc_id: (r.n_chars, r.shared_chars) for r in S.shared_share(df, min_span=20, chunk_chars=900).collect()}
    assert got == brute_share(docs, 20)


def test_runs_are_maximal(spark):
    a, b = "k" * 5 + "0123456789" * 3 + "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "!", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ?" + "z" * 30
    got = S.shared_runs(spark.createDataFrame([(1, a), (2, b)], SCHEMA), min_span=20).collect()
    assert [tuple(r) for r in got] == [(1, 2, 25, 0, 36)]


def brute_runs(docs, n):
    out = set()
    for i, a in docs:
        for j, b in docs:
            if i < j:
                for shift in range(-len(a), len(b)):
                    equal = [0 <= k + shift < len(b) and a[k] == b[k + shift] for k in range(len(a))]
                    at = 0
                    for same, run in itertools.groupby(equal):
                        size = len(list(run))
                        if same and size >= n:
                            out.add((i, j, at, at + shift, size))
                        at += size
    return out


@pytest.mark.parametrize("direct", [10_000, 60, 1])
def test_runs_equal_brute_force(spark, direct, monkeypatch):
    monkeypatch.setattr(S, "DIRECT", direct)
    p = "The quick brown fox jumps over the lazy dog, twice a day."
    docs = corpus(4, 12) + [(1, "x" * 45), (2, "x" * 33 + "y"), (3, p + "1" + p), (4, "2" + p + "3" + p), (5, "4" + p[3:40] + "5" + p[10:])]
    got = [tuple(r) for r in S.shared_runs(spark.createDataFrame(docs, SCHEMA), min_span=20, chunk_chars=900).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_runs(docs, 20)


def test_exact_threshold(spark):
    r = random.Random(1)
    p = "".join(chr(r.randint(97, 122)) for _ in range(200))
    docs = [(1, "1" + p), (2, "2" + p + "3"), (3, "4" + p[:-1] + "5"), (4, p[:199])]
    assert set(map(tuple, S.shared_pairs(spark.createDataFrame(docs, SCHEMA)).collect())) == brute_pairs(docs, 200) == {(1, 2)}


def test_nulls_empty_and_clashing_columns(spark):
    p = "abcdefghijklmnopqrstuvwxyz"
    df = spark.createDataFrame([(1, p, 0, 0), (2, p, 0, 0), (None, p, 0, 0), (3, None, 0, 0), (4, "", 0, 0)], SCHEMA + ", chunk int, fp int")
    assert set(map(tuple, S.shared_pairs(df, min_span=20).collect())) == {(1, 2)}
    share = {r.doc_id: tuple(r)[1:] for r in S.shared_share(df, min_span=20).collect()}
    assert share[1] == (26, 26) and share[3] == share[4] == (0, 0)
    empty = spark.createDataFrame([], SCHEMA)
    assert S.shared_pairs(empty).count() == S.shared_runs(empty).count() == S.shared_share(empty).count() == 0


def test_pack_round_trip():
    import numpy as np

    for values in ([], [0], [5, 300, 2**32 - 1], list(range(1000)), [254, 255, 510, 766], [65535, 65536, 2**60], [k * 999 for k in range(99)], [k << 20 for k in range(9)]):
        a = np.array(values, dtype=np.uint64)
        assert (S._unpack(S._pack(a)) == a).all()
