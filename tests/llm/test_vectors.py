"""Hard negatives and whitening against plain programs."""

import numpy as np
import pytest

from sensorloom.llm import hard_negatives, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, _x int"


def some(n, size, seed, copies=0):
    r = np.random.default_rng(seed)
    v = (r.standard_normal((n, size)) * 0.3 + r.integers(0, 3, n)[:, None] * 0.2).astype(np.float32)
    if copies:
        v[:copies] = v[0]
    return [(i, v[i].tolist(), int(r.integers(0, 4)), i) for i in range(n)]


ODD = [(None, [1.0, 2.0], 1, 0), (9001, None, 1, 0), (9002, [float("nan"), 1.0], 1, 0), (9003, [None, 1.0], 1, 0), (9004, [float("inf"), 1.0], 1, 0),
       (9050, [1.0, 0.5], None, 0), (9006, [], 1, 0), (9100, [0.0, 0.0, 0.0], 2, 0)]


def plain_negatives(rows):
    kept = {}
    for i, v, label, _ in rows:
        if i is None or label is None or not v or any(c is None or not np.isfinite(c) for c in v):
            continue
        x = [int(np.floor(256 * float(np.float32(c)))) for c in v]
        kept.setdefault(i, []).append(((label + 1) % 10 if i % 7 == 0 else label, x))
    kept = {i: min(v) for i, v in kept.items()}
    out = set()
    for a, (la, xa) in kept.items():
        if a % 50:
            continue
        scored = sorted((-sum(p * q for p, q in zip(xa, x)), i, label) for i, (label, x) in kept.items() if i != a and len(x) == len(xa))
        for sp, p, _ in [s for s in scored if s[2] == la][:5]:
            fits = [(s, i) for s, i, label in scored if label != la and -50 * sp <= -100 * s <= -95 * sp]
            out |= {(a, p, rank, i, -sp, -s) for rank, (s, i) in enumerate(fits[:3], 1)}
    return out


@pytest.mark.parametrize("rows", [some(700, 6, 1), some(400, 6, 2, copies=200) + some(30, 6, 2) + ODD, []], ids=["even", "copies", "empty"])
def test_hard_negatives(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in hard_negatives.hard_negatives(df, block=64, cells=16, sample=200).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_negatives(rows)


def test_tree_eliminates_children_that_hold_nothing():
    r = np.random.default_rng(3)
    x = np.concatenate([r.standard_normal((100, 4)) + 40 * c for c in np.eye(4)])
    tree = hard_negatives.Tree.grow(x, np.zeros(400), 4, 100, 16)
    leaf = tree.fit_ranges(x, np.zeros(400))
    met = list(tree.survivors(x[:1], np.zeros(1), np.zeros((1, 1)), np.full((1, 1), 3.0), 1e-9))
    assert [k for k, _ in met] == [leaf[0]] and tree.leaves > 1


def plain_whitening(rows, k=16):
    lengths = [len(v) for _, v, *_ in rows if v and not any(c is None or not np.isfinite(c) for c in v)]
    size = max(set(lengths), key=lambda s: (lengths.count(s), s))
    fine = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) + 1_000_000) for i, v, *_ in rows
            if v and len(v) == size and not any(c is None or not np.isfinite(c) for c in v)]
    fit = np.unique([x for _, x in fine], axis=0)
    n, total = len(fit), fit.sum(0)
    off = (fit * n - total) / n
    e, q = np.linalg.eigh(off.T @ off / n)
    return fine, n, total, e[::-1], q[:, ::-1]


@pytest.mark.parametrize("rows", [some(300, 20, 4) + ODD, some(60, 3, 5, copies=30)], ids=["many", "few"])
def test_whitening(spark, rows):
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    fine, n, total, e, q = plain_whitening(rows)
    k = min(16, len(e))
    assert len(out) == k * len(fine)
    by = {}
    for r in out:
        by.setdefault((r.id, r.component), []).append(r)
    sign = {}
    for i, x in fine:
        d = [n * int(a) - int(s) for a, s in zip(x, total)]
        y = np.array(d) / n @ q[:, :k] / np.sqrt(e[:k])
        for c in range(1, k + 1):
            r = by[i, c].pop()
            assert (r.n, r.deviation) == (n, sum(a * a for a in d))
            assert abs(r.explained - e[c - 1] / e.sum()) < 1e-9 and r.identity_error < 1e-9
            s = sign.setdefault(c, np.sign(y[c - 1]) * np.sign(r.whitened)) if abs(y[c - 1]) > 1e-3 else sign.get(c)
            assert s is None or abs(r.whitened * s - y[c - 1]) < 1e-7


def test_whitening_without_variance(spark):
    rows = [(i, [0.5, 0.25], 1, 0) for i in range(4)]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 8 and all(r.whitened is None and r.n == 1 and r.deviation == 0 and r.explained is None for r in out)
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rank_one_update_equals_the_eigenvalues_of_the_sum():
    r = np.random.default_rng(6)
    for rows in (r.standard_normal((80, 9)), np.repeat(r.standard_normal((3, 9)), 20, 0), r.integers(0, 2, (50, 9)).astype(float)):
        one, two = whitening.Spectrum(9), whitening.Spectrum(9)
        for x in rows[:30]:
            one.add(x)
        for x in rows[30:]:
            two.add(x)
        one.join(two)
        off = rows - rows.mean(0)
        back = one.vectors * one.values @ one.vectors.T
        assert np.abs(back - off.T @ off).max() < 1e-11 * np.abs(back).max()
        assert np.abs(one.vectors.T @ one.vectors - np.eye(9)).max() < 1e-12
