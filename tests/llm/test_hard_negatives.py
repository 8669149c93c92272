"""Threshold joins against all scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from revbridge.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=10, positives=5, negatives=10):
    good = []
    for d, v, c in rows:
        if d is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints = [math.floor(256 * x) for x in v]
            if sum(x * x for x in ints) < 1 << 62:
                good.append((d, c, ints))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    anchors = {}
    for d, c, v in good:
        if d % every == 0:
            anchors.setdefault(d, []).append((c, v))
    out = []
    for a, own in anchors.items():
        label, vec = min(own, key=lambda r: (r[0], np.array(r[1], np.int64).tobytes()))
        pos = sorted(((-dot(vec, v), d) for d, c, v in good if c == label and d != a))[:positives]
        for p, pid in pos:
            neg = sorted((-dot(vec, v), d) for d, c, v in good if c != label and d != a and 30 * -p <= 100 * dot(vec, v) <= 90 * -p)[:negatives]
            out += [(a, pid, r + 1, d, -p, -s) for r, (s, d) in enumerate(neg)]
    return sorted(out)


def result(spark, rows, every=10, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = hard_negatives.mine(df, F.col("vec_id") % every == 0, **kw)
    return sorted(map(tuple, out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def clustered(n, dim, seed, spread=0.6):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    v = centres[rng.integers(0, 6, n)] + spread * rng.standard_normal((n, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(i, [float(x) for x in v[i]], int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("dim", [1, 7, 20])
def test_against_all_scores(spark, dim):
    rows = clustered(300, dim, dim)
    assert result(spark, rows) == brute(rows)


def test_blocks_of_anchors(spark):
    rows = clustered(200, 12, 5)
    assert result(spark, rows, every=3, block=16) == brute(rows, every=3)


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i % 90, [float(rng.randrange(-3, 4)) for _ in range(rng.choice([0, 1, 4, 9]))], rng.randrange(2)) for i in range(150)]  # ties, lengths, repeated ids
    rows += [(rows[20][0], rows[20][1], rows[20][2])] * 30
    rows += [(None, [1.0], 1), (10, None, 1), (10, [None, 1.0], 1), (20, [math.nan], 0), (30, [math.inf], 1), (40, [1.0, 2.0], None), (50, [0.0] * 4, 0), (60, [], 1)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_large_numbers_are_exact(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 3, 6]) for _ in range(6)], rng.randrange(3)) for i in range(120)]
    rows += [(130, [1e200, 1.0], 0), (140, [-1e300], 1), (150, [1e-200], 1)]
    assert result(spark, rows) == brute(rows)


def test_index_and_bounds_leave_work_out():
    """After the first batch, lists stop short of the tails and few pairs are scored."""
    rng = np.random.default_rng(3)
    weight = np.linspace(1, 0.05, 64)
    x = np.floor(256 * rng.standard_normal((8192, 64)) * weight).astype(np.int64)
    labels = rng.integers(0, 2, len(x))
    q, ql = x[:40], labels[:40]
    windows = hard_negatives.Windows(np.arange(40), np.full(40, hard_negatives.NONE + 1), np.full(40, hard_negatives.FAR), 5, 40)
    join = hard_negatives.Join(np.arange(40), ql, q, windows, True)
    for i in range(0, len(x), 1024):
        join.add(np.arange(i, i + 1024), labels[i : i + 1024], x[i : i + 1024])
    scores = (q @ x.T).astype(float)
    for a in range(40):
        ok = np.flatnonzero((labels == ql[a]) & (np.arange(len(x)) != a))
        best = ok[np.lexsort((ok, -scores[a, ok]))][:5]
        assert windows.ids[a].tolist() == best.tolist()
    assert join.accumulated < 0.95 * len(x) * 8
    assert join.scored < 0.1 * 40 * len(x)
