from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cliqueflow.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>, ints string, part string"


def plain(rows, scale=256, positives=5, negatives=5, least=80, most=100):
    ok = [(i, y, [math.floor(scale * c) for c in e]) for i, y, e in rows if i is not None and y is not None and e is not None and all(c is not None and math.isfinite(c) for c in e)]
    out = []
    for a, y, e in ok:
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(e, f)), i, z == y) for i, z, f in ok if i != a)
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            near = [x for x in scored if not x[2] and -least * s <= -100 * x[0] <= -most * s][:negatives]
            out += [(a, p, n, i, -s, -c) for n, (c, i, _) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(hard_negatives.CANDIDATES, hard_negatives.ANCHORS), (50, 3)])
def test_negatives_equal_all_products(spark, monkeypatch, sizes):
    monkeypatch.setattr(hard_negatives, "CANDIDATES", sizes[0])
    monkeypatch.setattr(hard_negatives, "ANCHORS", sizes[1])
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 0, 1, 2]), [rng.choice([-0.5, 0.0, 0.25, 0.3, 0.7]) for _ in range(rng.choice([3, 4, 6]))]) for i in range(1200)]
    rows += [(i, 1, [0.5, 0.5, 0.5]) for i in range(2000, 2300)]  # one common vector
    rows += [(3000, None, [1.0]), (3100, 1, None), (3200, 1, [float("nan")]), (3300, 1, [None]), (3400, 1, [float("inf")]), (3500, 1, []), (None, 1, [1.0])]
    rows += [rows[100], rows[101], rows[101]]  # a repeated anchor, a repeated candidate
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    scaled = hard_negatives.scaled(df, "vec_id", "embedding", F.col("label"), 256)
    got = hard_negatives.mine(scaled, scaled.filter("id % 100 = 0"))
    assert dict(got.dtypes)["rank"] == "int"
    want = plain(rows)
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want
    assert hard_negatives.mine(scaled.limit(0), scaled.limit(0)).count() == 0


def test_wide_products_are_exact():
    rng = np.random.default_rng(4)
    for peak in (1, 2, 300, 1 << 20, 1 << 40):
        a, c = rng.integers(-peak, peak + 1, (5, 7)), rng.integers(-peak, peak + 1, (23, 7))
        want = np.clip(a.astype(object) @ c.T.astype(object), *hard_negatives.LONG).astype(np.int64)
        assert (hard_negatives.wide_products(a, c) == want).all()
    same = np.full((2, 3), 9)
    assert (hard_negatives.wide_products(same, same) == 243).all()
    assert hard_negatives.wide_products(np.zeros((2, 0), np.int64), np.zeros((3, 0), np.int64)).tolist() == [[0] * 3] * 2


def test_first_rows_break_ties_by_order():
    scores = np.array([5, 7, 7, 7, 1, 9])
    assert hard_negatives.first_rows(scores, np.arange(6), 3).tolist() == [5, 1, 2]
    assert hard_negatives.first_rows(scores, np.array([0, 4]), 5).tolist() == [0, 4]
