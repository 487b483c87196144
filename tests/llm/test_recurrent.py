"""The language model's counts against a plain program, its probabilities against their sum, its training against held-out texts."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from sensorloom.llm import recurrent

SCHEMA = "doc_id long, text string, block int, codes string"


def texts(n, seed):
    r = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        at, doc = int(r.integers(60)), []
        for _ in range(int(r.integers(1, 40))):
            at = (at + int(r.integers(1, 4))) % 60
            doc.append(words[at] if r.random() > 0.02 else f"Rare{r.integers(400)}")
        out.append((i, " ".join(doc), 0, ""))
    return out


ODD = [(None, "w1 w2", 0, ""), (7001, None, 0, ""), (7002, "", 0, ""), (7003, " \t\n", 0, ""), (7003, "Ärger w1\x0bW2", 0, ""),
       (7004, "unseen " * 3000, 0, ""), (7005, "w5", 0, ""), (7005, "w5", 0, "")]


def plain(rows):
    def split(t):
        return (t or "").encode().lower().split() + [b""]

    def held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

    counts = Counter(w for i, t, *_ in rows if not held(i) for w in split(t))
    n, v = sum(counts.values()), len(counts)
    return sorted((i is None, i or 0, held(i), len(split(t)), sum(counts[w] > 0 for w in split(t)), n,
                   round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in split(t)), 6)) for i, t, *_ in rows)


@pytest.mark.parametrize("rows", [texts(300, 1) + ODD, ODD[1:4], []], ids=["many", "empty texts", "empty table"])
def test_counts_and_base(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = recurrent.log_likelihoods(df, head=40, hidden=8, lanes=16, block=500).collect()
    assert sorted((r.id is None, r.id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == plain(rows)
    assert all(np.isfinite(r.score) and r.score < 0 for r in out)


def test_held_out_texts_are_likelier_than_by_counts(spark):
    out = recurrent.log_likelihoods(spark.createDataFrame(texts(3000, 2), SCHEMA), head=64, hidden=16, lanes=16, block=20000).where("held_out").collect()
    assert sum(r.score for r in out) > 0.9 * sum(r.base_score for r in out)


def vocabulary():
    head = [300, 200, 100, 90, 80, 70]
    rare = {3: 4 + 5, 1: 1}  # words seen 4, 5 and 1 times
    bands = {0: 1, 3: sum(c + 1 for c in (4, 5)), 1: 2}
    return recurrent.Vocabulary(sum(head) + sum(rare.values()), 9, [f"h{i}" for i in range(6)], head, bands)


def random_model():
    model = recurrent.Model(vocabulary(), 5, width=4)
    r = np.random.default_rng(3)
    for name in ("wc", "ww", "b"):
        model.p[name] += r.standard_normal(model.shapes[name]).astype(np.float32)
    return model


def scores(model, codes, lengths, lanes, steps):
    total = np.zeros(len(lengths))
    for first, active, inputs, fresh, target, used, doc in model.windows(codes, lengths, lanes, steps):
        h = np.zeros((active, model.hidden), np.float32) if first else h[:active]
        out, _ = model.states(inputs, fresh, h)
        h = out[-1]
        total += np.bincount(doc[used], model.outputs(out[used], target[used])[0], len(total))
    return total


def test_probabilities_sum_to_one_and_begin_as_counts():
    words, n = vocabulary(), 6 + 3
    start = recurrent.Model(words, 5, width=4)
    one = start.outputs(np.ones((n, 5), np.float32), np.arange(n))[0]
    mass = [c + 1 for c in words.head_counts] + [words.bands[b] for b in sorted(words.bands)]
    assert np.allclose(np.exp(one), np.array(mass) / words.total, rtol=1e-5)
    for h in np.random.default_rng(4).standard_normal((3, 5)).astype(np.float32):
        assert abs(np.exp(random_model().outputs(np.repeat(h[None], n, 0), np.arange(n))[0]).sum() - 1) < 1e-5


def test_state_runs_from_window_to_window():
    r = np.random.default_rng(5)
    lengths = np.array([1, 40, 7, 100, 2, 2, 33], np.int32)
    codes = r.integers(0, 9, lengths.sum()).astype(np.uint16)
    model = random_model()
    alone = np.concatenate([scores(model, codes[b - n:b], np.array([n]), 1, 1) for n, b in zip(lengths, np.cumsum(lengths), strict=True)])
    for lanes, steps in ((1, 1000), (3, 8), (7, 5), (50, 64)):
        assert np.allclose(scores(model, codes, lengths, lanes, steps), alone, atol=1e-3)


def test_gradients_of_a_window():
    r = np.random.default_rng(6)
    codes, target = r.integers(0, 9, (6, 3)), r.integers(0, 9, (6, 3))
    fresh, used = r.random((6, 3)) < 0.2, r.random((6, 3)) < 0.9
    h = r.standard_normal((3, 5)).astype(np.float32)
    model = random_model()
    model.p = {n: v.astype(np.float64) for n, v in model.p.items()}

    def loss():
        return -model.outputs(model.states(codes, fresh, h)[0][used], target[used])[0].sum()

    before = {n: v.copy() for n, v in model.p.items()}
    for name in ("embed", "wx", "wh", "b", "wc", "bc", "ww", "bw"):
        numeric = []
        at = [tuple(int(r.integers(s)) for s in model.shapes[name]) for _ in range(4)]
        for i in at:
            model.p[name][i] += 1e-2
            up = loss()
            model.p[name][i] -= 2e-2
            numeric.append((up - loss()) / 2e-2)
            model.p[name][i] += 1e-2
        model.p = {n: v.copy() for n, v in before.items()}
        model.seen = {n: np.full(v.shape, 1e12) for n, v in before.items()}  # steps in proportion to gradients
        model.learn(codes, fresh, target, used, h, 1e6, 1e-3)
        got = [(before[name][i] - model.p[name][i]) * 1e3 for i in at]
        model.p = {n: v.copy() for n, v in before.items()}
        assert np.allclose(got, numeric, atol=2e-2, rtol=2e-2), name
