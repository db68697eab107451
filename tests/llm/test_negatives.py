import math

import numpy as np
from pyspark.sql import functions as F

from funnelwright.llm import negatives

KIND = "vec_id long, embedding array<float>, label int, score long, uid string, x int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "u", 2) for i, v, label in rows], KIND)


def brute(rows, divisor=100):
    fit = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fit.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for a, (anchor, label, x) in enumerate(fit):
        if anchor % divisor:
            continue
        scored = [
            (-sum(p * q for p, q in zip(x, y, strict=True)), i, other)
            for b, (i, other, y) in enumerate(fit)
            if a != b and len(x) == len(y)
        ]
        scored.sort()
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            band = [(n, i) for n, i, other in scored if other != label and 80 * -p <= 100 * -n <= 100 * -p]
            out += [(anchor, positive, rank, i, -p, -n) for rank, (n, i) in enumerate(band[:5], 1)]
    return sorted(out)


def got(spark, rows, divisor=100):
    found = negatives.hard_negatives(table(spark, rows), F.col("vec_id") % divisor == 0, label=negatives.moved_label())
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


def vectors(rng, n, size=20, spread=0.4):
    return [(i, [rng.gauss(0, spread) + (i % 3 == 0) * 0.2 for _ in range(size)], rng.randrange(4)) for i in range(n)]


def test_against_all_pairs(spark, rng):
    rows = vectors(rng, 500)
    rows += [(i, rows[200][1], i % 2) for i in range(500, 640)]  # copies of an anchor under two labels
    rows += [(None, rows[0][1], 1), (701, None, 1), (702, [], 1), (800, [], 1), (703, rows[0][1], None)]
    rows += [(704, [None] * 20, 2), (705, [float("nan")] * 20, 2), (706, [float("inf")] * 20, 2), (900, [0.0] * 20, 3)]
    rows += [(100, rows[100][1], rows[100][2]), (100, rows[7][1], 1), (707, [1.0, 2.0], 1), (1000, [2.0, 1.0], 1), (708, [1.5, 1.0], 2)]
    expected = brute(rows)
    assert expected and got(spark, rows) == expected


def test_tiles_do_not_change_results(spark, rng, monkeypatch):
    for name, value in (("ANCHOR_TILE", 9), ("ROW_TILE", 60), ("CELLS", 100)):
        monkeypatch.setattr(negatives, name, value)
    rows = [(i, [float(rng.randrange(-1, 2)) / 16 for _ in range(5)], rng.randrange(3)) for i in range(200)]  # many ties
    assert got(spark, rows, 10) == brute(rows, 10)


def test_few_rows(spark):
    one = [(0, [1.0, 1.0], 3)]
    assert got(spark, []) == [] and got(spark, one) == []
    # label 3 becomes 4; its only positive has no negative in the band, then one
    pair = [*one, (1, [1.0, 0.9], 4)]
    assert got(spark, pair) == []
    assert got(spark, [*pair, (2, [0.9, 0.9], 5), (3, [0.1, 0.1], 5)]) == brute([*pair, (2, [0.9, 0.9], 5), (3, [0.1, 0.1], 5)])


def test_components_too_large_for_longs_take_no_part(spark):
    rows = [(0, [1.0, 1.0], 3), (1, [1.0, 0.9], 4), (2, [0.9, 0.9], 5)]
    assert got(spark, [*rows, (4, [1e30, 1.0], 4), (5, [-1e9, 1.0], 5)]) == got(spark, rows) != []


def test_intervals_hold_and_filter(rng):
    generator = np.random.default_rng(rng.randrange(100))
    for size in (1, 3, 64, 100):
        rows = generator.integers(-300, 300, (400, size))
        anchors = generator.integers(-5000, 200, (30, size))
        lower, upper = negatives.Anchors(anchors).intervals(slice(3, 25), negatives.Codes.of(rows))
        exact = anchors[3:25] @ rows.T
        assert (lower <= exact).all() and (exact <= upper).all()
    reach = np.linalg.norm(anchors[3:25], axis=1)[:, None] * np.linalg.norm(rows, axis=1)
    assert ((upper - lower) < 0.4 * reach).all()  # far narrower than what the lengths alone allow: 2


def test_an_alignment_is_the_inner_product_with_its_code():
    rows = np.random.default_rng(5).integers(-9, 9, (10, 64))
    codes, (hadamard, signs) = negatives.Codes.of(rows), negatives.rotations(64)
    bits = np.unpackbits(codes.words[:, 0].copy().view(np.uint8).reshape(10, -1), axis=1)
    units = ((2.0 * bits - 1) @ hadamard) * signs[0] / 64
    assert np.allclose(np.linalg.norm(units, axis=1), 1) and np.allclose((units * rows).sum(axis=1), codes.alignment[:, 0])
