"""Hard negatives against plain Python; the index drops nothing that reaches a threshold."""

import math
import random

import numpy as np
import pytest

from vitrine.llm import hard_negatives as H


def brute_force(rows, every=100):
    """All (anchor_id, positive_id, rank, negative_id, positive_score, negative_score), sorted."""
    kept = []
    for vec_id, label, x in rows:
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        kept.append((vec_id, label, [math.floor(256 * float(np.float32(v))) for v in x]))
    at = lambda i: (i is None, i or 0)
    out = []
    for a, own, q in kept:
        if a is None or a % every:
            continue
        score = lambda v: sum(x * y for x, y in zip(q, v))
        near = sorted((-score(v), at(i), i) for i, label, v in kept if label == own and i != a)[:5]
        far = sorted((-score(v), at(i), i) for i, label, v in kept if label != own)
        for p, _, i in near:
            window = [(n, j) for n, _, j in far if 80 * -p <= 100 * -n <= 100 * -p][:5]
            out += [(a, i, k + 1, j, -p, -n) for k, (n, j) in enumerate(window)]
    return sorted(out, key=repr)


def table(spark, rows, clashes=True):
    names = ["row", "g", "query", "low", "high", "floor", "score", "rank", "norm", "q", "block", "anchor"] if clashes else []
    return spark.createDataFrame([(*r, *range(len(names))) for r in rows],
                                 "vec_id long, label int, embedding array<float>" + "".join(f", {n} int" for n in names))


def vectors(seed, n=700, width=12):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rnd.choice(centres)
        rows.append((i, rnd.randrange(10), [0.2 * a + rnd.gauss(0, 0.1) for a in c]))
    rows += [(n + i, i % 3, list(rows[100][2])) for i in range(250)]  # copies under several labels
    return rows


def awkward():
    rows = vectors(4, 300)
    nan, inf = float("nan"), float("inf")
    rows += [(None, 3, rows[0][2]), (None, 1, rows[0][2]), (900, None, [1.0]), (1000, 2, None), (1100, 2, [nan] * 12), (1200, 2, [0.1, inf]),
             (1300, 2, [None, 0.5]), (1400, 2, []), (1500, 0, [0.0] * 12), (1600, 5, [0.3, 0.2]), (-100, -3, rows[0][2]), (-101, -3, rows[0][2]),
             (1700, 4, [-0.3] * 20), (1800, 1, [3e4] * 12), (1801, 1, [2e4] * 12), (1802, 2, [1.9e4] * 12)]
    return rows + [rows[0], rows[0], rows[5], rows[100]]


@pytest.mark.parametrize("seed", [1, 2])
def test_whole_result_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_ROWS", 90 * seed)
    rows = vectors(seed)
    got = sorted((tuple(r) for r in H.hard_negatives(table(spark, rows).repartition(3 * seed)).collect()), key=repr)
    assert got == brute_force(rows) and len(got) > 50


def test_awkward_rows(spark):
    rows = awkward()
    got = sorted((tuple(r) for r in H.hard_negatives(table(spark, rows).repartition(4)).collect()), key=repr)
    assert got == brute_force(rows)


def test_few_rows_and_none(spark):
    assert H.hard_negatives(table(spark, [])).collect() == []
    rows = [(0, 1, [0.5, 0.5]), (1, 2, [0.5, 0.5]), (2, 2, [0.5, 0.4]), (3, 1, [0.49, 0.5])]
    assert sorted(tuple(r) for r in H.hard_negatives(table(spark, rows, False)).collect()) == brute_force(rows)


@pytest.mark.parametrize("share", [-1.0, 0.0, 0.2, 0.5, 0.9, 1.5])
def test_threshold_join_is_exact(share):
    rnd = np.random.default_rng(int(10 * share) + 20)
    for rows, width in ((1, 1), (50, 3), (400, 37)):
        x = np.floor(rnd.normal(0, 60, (rows, width)) * (rnd.random((rows, width)) < 0.6))
        q = np.floor(rnd.normal(0, 60, (9, width)))
        q[0] = 0
        asked = share * (q * q).sum(axis=1)
        full = (q @ x.T).astype(np.int64)
        a, b, s = H.joined(x, q, asked)
        assert sorted(zip(a.tolist(), b.tolist(), s.tolist())) == [
            (i, j, full[i, j]) for i in range(9) for j in range(rows) if full[i, j] >= asked[i]]


def test_index_omits_what_cannot_reach_the_threshold():
    x = np.floor(np.random.default_rng(1).normal(0, 30, (500, 32)))
    high, low = H.Index(x, 150.0), H.Index(x, 20.0)
    assert high.indexed.sum() < low.indexed.sum() < x.size
    assert all(high.postings(j) >= high.postings(j + 1) for j in range(31))
