import numpy as np
from pyspark.sql import functions as F

from lexiforge.llm import topk


def brute(rows, k=5):
    vectors = []
    for i, e in rows:
        if i is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        vectors.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in e]))
    out = []
    for i, q in vectors:
        if i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, c, strict=False)), j) for j, c in vectors if j != i)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(i, e, 1, 2, "z") for i, e in rows], "vec_id long, embedding array<float>, v int, rank int, row string").repartition(3)
    return sorted(tuple(r) for r in topk.exact_top_k(df, F.col("vec_id") % 50 == 0).collect())


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 2)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(9)]  # ties
    rows += [(401, None), (402, [1.0, None] * 4), (403, [float("nan")] * 8), (404, [float("inf")] * 8), (405, []), (406, [0.5] * 3), (407, [0.0] * 8)]
    rows += [(450, rows[3][1] + [9.0]), (7, rows[7][1])]  # another length; a repeated row
    assert run(spark, rows) == brute(rows)


def test_few_rows_and_none(spark):
    assert run(spark, [(50, [1.0]), (51, [2.0])]) == [(50, 1, 51, 256 * 512)]
    assert run(spark, [(50, [1.0])]) == []
    assert run(spark, [(None, [1.0]), (None, None)]) == []


def test_large_components_stay_exact(spark):
    rows = [(0, [30000.0, -30000.5]), (1, [30000.25, 30000.0]), (2, [-1.0, 1.0])]
    assert run(spark, rows) == brute(rows)


def test_scores_beyond_64_bits_are_the_nearest(spark):
    rows = [(0, [1e13, 0.0]), (1, [-3e13, 1.0]), (2, [2e13, 0.0]), (3, [1e30, 0.0]), (4, [0.0, 1.0]), (5, [1.0, 0.0])]
    got = run(spark, rows)
    top, low = 2**63 - 1, -(2**63)
    assert [r[2:] for r in got] == [(2, top), (3, top), (5, 256 * int(np.floor(256 * float(np.float32(1e13))))), (4, 0), (1, low)]


def test_many_deals_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 3)
    monkeypatch.setattr(topk, "CANDIDATES", 16)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 4)]) for i in range(400)]
    assert run(spark, rows) == brute(rows)
