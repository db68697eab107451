import math

import numpy as np
from pyspark.sql import functions as F

from funnelwright.llm import nearest

KIND = "vec_id long, embedding array<float>, label int, score double, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, None, 0.0, 1) for i, v in rows], KIND)


def brute(rows, k, divisor):
    usable = []
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable.append((i, tuple(float(np.float32(x)) for x in v)))
    out = []
    for a, (q, x) in enumerate(usable):
        if q % divisor:
            continue
        scored = []
        for b, (c, y) in enumerate(usable):
            if a != b and len(x) == len(y):
                total = 0.0
                for s, t in zip(x, y, strict=True):
                    total += s * t
                scored.append((-total, c))
        out += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def got(spark, rows, k=20, divisor=20):
    found = nearest.nearest(table(spark, rows), F.col("vec_id") % divisor == 0, k)
    return sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in found.collect())


def test_nearest_against_all_pairs(spark, rng):
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(600)]
    rows += [(i, rows[5][1]) for i in range(600, 700)]  # many copies of one vector
    rows += [(700, None), (701, []), (702, [0.0] * 16), (703, [None] + [1.0] * 15), (704, [float("nan")] * 16)]
    rows += [(705, [float("inf")] + [0.0] * 15), (None, rows[0][1]), (706, [1.0, 2.0]), (720, [3.0, 4.0])]
    rows += [(40, rows[40][1]), (41, rows[42][1]), (740, [1e30] * 16), (741, [1e-30] * 16), (-20, rows[9][1])]
    assert got(spark, rows) == brute(rows, 20, 20)


def test_tiles_do_not_change_results(spark, rng, monkeypatch):
    monkeypatch.setattr(nearest, "QUERY_TILE", 7)
    monkeypatch.setattr(nearest, "CANDIDATE_TILE", 50)
    rows = [(i, [float(rng.randrange(-2, 3)) for _ in range(4)]) for i in range(300)]  # many ties
    assert got(spark, rows, 5, 10) == brute(rows, 5, 10)


def test_fewer_candidates_than_asked_and_empty(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [2.0, 0.0])]
    assert got(spark, rows) == brute(rows, 20, 20) == [(0, 1, 2, 2.0), (0, 2, 1, 0.5)]
    assert got(spark, [(1, [1.0])]) == [] and got(spark, [(0, [1.0])]) == [] and got(spark, []) == []


def test_bounds_hold(rng):
    left = np.array([[rng.gauss(0, 3) for _ in range(24)] for _ in range(50)])
    right = np.array([[rng.expovariate(1) for _ in range(24)] for _ in range(60)])
    a, b = nearest.Quantised(left), nearest.Quantised(right)
    about = (a.int8.astype(float) @ b.int8.T) * a.scale[:, None] * b.scale
    bound = a.near_norm[:, None] * b.error + a.error[:, None] * b.norm
    assert (np.abs(about - left @ right.T) <= bound + 1e-9).all()


def test_rows_that_share_an_id_all_count(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (0, [3.0, 1.0])]
    found = got(spark, rows)
    assert found == brute(rows, 20, 20) and len(found) == 2 * 4
