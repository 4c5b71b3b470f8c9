import math
import random

import numpy as np
import pytest

from scarp.llm import topk


def brute(rows, k=5, every=50):
    good = [(i, [math.floor(x * 256) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i % every == 0:
            scored = sorted((-min(max(sum(a * b for a, b in zip(q, v)), -2 ** 63), 2 ** 63 - 1), j) for j, v in good if j != i)
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def result(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<double>, score double")
    return sorted(tuple(r) for r in topk.top_k(df, **how).collect())


def test_against_all_scores(spark):
    rng = random.Random(2)
    rows = [(k, [rng.gauss(0, 0.2) for _ in range(12)]) for k in range(400)]
    same = [0.5] * 12
    rows += [(1000 + k, same) for k in range(150)]  # ties, one of them a query
    rows += [(2000, None), (2001, []), (2002, [1.0, None]), (2003, [float("nan")] * 12), (2004, [float("inf")]), (None, same),
             (2050, [0.3] * 4), (2051, [0.3] * 20)]
    got = result(spark, rows, block=64, queries=4)
    assert got == brute(rows) and {r[0] for r in got} >= {1000, 1050, 2050}


def test_fewer_rows_than_k_and_none(spark):
    assert result(spark, [(50, [1.0]), (51, [2.0])]) == [(50, 1, 51, 256 * 512)]
    assert result(spark, [(50, [1.0])]) == [] and result(spark, [(51, [1.0])]) == []
    assert result(spark, [(1, None)]) == []


def test_numbers_beyond_exact_doubles(spark):
    rows = [(k, [float(3 ** (k + 20)), float(k) * 1e9 + 0.1, -1.0]) for k in range(0, 60, 5)]
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("shift", [0.0, 50.0])
def test_bounds_hold_for_every_pair(shift):
    rng = np.random.default_rng(1)
    m, q = np.floor(rng.normal(shift, 40, (300, 9))), np.floor(rng.normal(0, 40, (20, 9)))
    m[:40] = m[0]
    upper = topk.bounds(q, *topk.cells_of(m))
    assert (upper >= q @ m.T).all() and upper.mean() < np.abs(q).sum(1).mean() * np.abs(m).max()


def test_exact_vectors_are_read_for_few_pairs_only(spark, monkeypatch):
    """The approximation decides: of all pairs of a query and a row hardly more than the results are read."""
    rng = np.random.default_rng(5)
    m = rng.normal(size=(3000, 24))
    rows = [(k, [float(x) for x in v / np.linalg.norm(v)]) for k, v in enumerate(m)]
    read = []
    real = topk.exact_scores
    monkeypatch.setattr(topk, "exact_scores", lambda pairs, entries, asked: read.append(pairs.count()) or real(pairs, entries, asked))
    got = result(spark, rows, block=500, queries=16)
    assert got == brute(rows)
    assert 60 * 5 <= sum(read) < 60 * 12 and len(read) == 2      # 60 queries, of 180,000 pairs


def test_lower_bounds_hold_and_approximations_suffice():
    rng = np.random.default_rng(6)
    m, q = np.floor(rng.normal(0, 40, (400, 9))), np.floor(rng.normal(0, 40, (20, 9)))
    code, edges = topk.cells_of(m)
    assert code.dtype == np.uint8
    upper, lower = topk.both_bounds(q, code, edges)
    exact = q @ m.T
    assert (lower <= exact).all() and (exact <= upper).all()
    n, r, _, _ = topk.scan_block(q, code, edges, float(np.abs(m).max()), 5)
    for k in range(20):
        assert set(np.argsort(-exact[k], kind="stable")[:5]) <= set(r[n == k])


def test_a_common_vector_is_one_entry(spark):
    same, rng = [0.25] * 8, random.Random(3)
    rows = [(k, same if k % 3 == 0 else [rng.gauss(0, 0.2) for _ in range(8)]) for k in range(1200)]
    rows += rows[:20]                                             # repeated rows count once
    assert result(spark, rows, block=64, queries=8) == brute(rows[:1200])


def test_copies_of_queries_and_vectors_are_never_broadcast(spark, monkeypatch):
    """The copies of the queries, one for every group of rows, are many times the file by which Spark chooses a broadcast."""
    plans, real, rng = {}, topk.scratch_table, random.Random(4)
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(topk, "scratch_table", lambda df, name: plans.update({name: plan_of(df)}) or real(df, name))
    rows = [(k, [rng.gauss(0, 0.2) for _ in range(8)]) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = topk.top_k(df, block=32, queries=2)
    assert "Broadcast" not in "".join(plans[x] for x in ("topk-passed", "topk-left", "topk-first")) + plan_of(out)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows)


def test_every_query_meets_every_row_once(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE", 3000)                       # several groups of rows and of queries
    monkeypatch.setattr(topk, "SPREAD", 3)
    met, real, rng = [], topk.passed_on, random.Random(5)
    monkeypatch.setattr(topk, "passed_on", lambda store, asked, k, queries: met.append(
        real(store, asked, 1000, queries).collect()) or real(store, asked, k, queries))
    rows = [(k, [rng.gauss(0, 0.2) for _ in range(6)]) for k in range(500)]
    assert result(spark, rows, block=16, queries=3, every=7) == brute(rows, every=7)
    pairs = [(r["q"], r["first"]) for r in met[0]]
    assert len(pairs) == len(set(pairs)) == len(rows) * len(range(0, 500, 7))


@pytest.mark.parametrize("unit", [1.0, 300.0, 1e9, 1e20, 1e160])
def test_a_tile_keeps_the_best_rows_of_every_query(unit):
    """Sums in single precision, in double precision and beyond both; blocks and queries of different lengths."""
    rng, k = np.random.default_rng(7), 4
    dims = (9, 5, 9, 12)
    blocks = [np.floor(rng.normal(0, 40, (n, d)) * u) for n, d, u in zip((60, 3, 90, 40), dims, (1, unit, unit, 1))]
    asked = [np.floor(rng.normal(0, 40, (7, d)) * unit) for d in (9, 12)]
    def stored(n, m):
        code, edges = topk.cells_of(m, 8)
        return {"n": len(m), "dim": m.shape[1], "keys": np.arange(100 * n, 100 * n + len(m)).astype("<i8").tobytes(), "codes": code.tobytes(),
                "edges": edges.astype("<f8").tobytes(), "top": float(np.abs(m).max())}
    found = topk.scan_tile([stored(n, m) for n, m in enumerate(blocks)], [
        {"q_n": 7, "q_dim": m.shape[1], "q_keys": np.arange(10 * n, 10 * n + 7).astype("<i8").tobytes(), "q_vectors": m.astype("<f8").tobytes()}
        for n, m in enumerate(asked)], k, 5)
    bounds = {(q, row): (upper, lower) for q, row, upper, lower in zip(*(x.tolist() for x in found))}
    cut = lambda x: min(max(x, -2 ** 63), 2 ** 63)
    for q, v in ((10 * n + i, v) for n, m in enumerate(asked) for i, v in enumerate(m.tolist())):
        scores = {100 * n + i: cut(sum(int(a) * int(b) for a, b in zip(v, w))) for n, m in enumerate(blocks) for i, w in enumerate(m.tolist())}
        kth = sorted(scores.values())[-k]
        assert {row for row, x in scores.items() if x >= kth} <= {row for at, row in bounds if at == q}
        assert all(low <= scores[row] <= up for (at, row), (up, low) in bounds.items() if at == q)
    if unit == 1.0:
        assert len(bounds) < 14 * 193 / 2
