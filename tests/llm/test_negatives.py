"""Hard negatives against brute force, and the bounds that end a walk."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest

from fleetlake.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """The contract as written, over distinct rows."""
    kept = set()
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.add((i, (y + 1) % 10 if i % 7 == 0 else y, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = []
    for a, y, q in kept:
        if a % 100:
            continue
        scored = sorted((-sum(s * t for s, t in zip(q, v, strict=True)), i, z) for i, z, v in kept if i != a)
        for ps, p, _ in [r for r in scored if r[2] == y][:5]:
            fit = [r for r in scored if r[2] != y and 30 * -ps <= 100 * -r[0] <= 90 * -ps][:10]
            out += [(a, p, k, n, -ps, -ns) for k, (ns, n, _) in enumerate(fit, 1)]
    return sorted(out)


def check(spark, rows):
    found = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = brute(rows)
    assert sorted(tuple(r) for r in found) == expected
    return expected


def test_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "HEAD", 60)
    monkeypatch.setattr(negatives, "CHUNK_ROWS", 100)
    monkeypatch.setattr(negatives, "CHUNK_MEMBERS", 6)
    monkeypatch.setattr(negatives, "STEP", 16)
    draw = np.random.default_rng(2)
    centre = draw.normal(size=(9, 8))
    rows = [(k, (centre[k % 9] + 0.5 * draw.normal(size=8)).tolist(), int(draw.integers(0, 10))) for k in range(2500)]
    assert len(check(spark, rows)) > 1000


def test_negatives_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "HEAD", 50)
    same = [0.5, 0.25, -0.25]
    rows = [(k, same, k % 2) for k in range(300)] + [(5, same, 1)] * 3 + [(100, [0.1, 0.2, 0.3], 4), (100, same, 1)]
    rows += [(400, [0.0] * 3, 3), (401, [0.0] * 3, 3), (500, None, 1), (600, [float("nan")] * 3, 1), (700, [1.0, None, 1.0], 1)]
    rows += [(800, same, None), (None, same, 1), (402, [0.3, 0.2, -0.1], 2), (403, [0.31, 0.2, -0.1], 2), (1400, [-1.0, 0.0, 0.0], 8), (1401, [1.0, 0.0, 0.0], 9)]
    rows += [(404, [0.2, 0.1, -0.1], k) for k in range(4)]
    assert check(spark, rows)
    assert negatives.hard_negatives(spark.createDataFrame([(100, [1.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], SCHEMA)).count() == 0
    for none in ([], [(1, [1.0], 1)], [(100, None, 1)], [(100, [1.0], 1)]):
        found = negatives.hard_negatives(spark.createDataFrame(none, SCHEMA))
        assert found.count() == 0 and found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_clashing_columns(spark):
    rows = [(100, [1.0, 0.0], 3, "x", 1, 1), (1, [1.0, 0.1], 3, "x", 1, 1), (2, [0.5, 0.0], 4, "x", 1, 1)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, k string, v int, cluster int")
    assert [tuple(r) for r in negatives.hard_negatives(docs).collect()] == [(100, 1, 1, 2, 256 * 256, 128 * 256)]


def test_bounds_hold_for_every_member():
    draw = np.random.default_rng(1)
    members, rows = ((draw.normal(size=(n, 6)) * 300).astype(np.int64) for n in (200, 500))
    centre = negatives.centres(members, 5)
    angle, length = negatives.angles(members, centre)
    cluster = angle.argmin(1)
    radius = np.array([angle[cluster == c, c].max() for c in range(5)])
    bound = negatives.upper_bounds(rows, centre, radius)
    assert (negatives.products(members, rows) <= bound[:, cluster].T * length[:, None] + 1e-6).all()


@pytest.mark.parametrize("narrow", [True, False])
def test_walks_end_early_where_the_bound_allows(narrow, monkeypatch):
    """A walk reads the list's head only if its members are close together."""
    draw = np.random.default_rng(3)
    rows = (draw.normal(size=(4000, 8)) * 100).astype(np.int32)
    member = np.array([[300] * 8], np.int32)
    centre, radius = negatives.units(member)[0], np.array([0.05 if narrow else 1.5])
    steps = []
    monkeypatch.setattr(negatives, "products", lambda a, b, f=negatives.products: steps.append(len(b)) or f(a, b))
    as_lists = lambda x: negatives.lists(x, pa.int32())
    chunk = pa.table({"bound": negatives.upper_bounds(rows, centre, radius)[:, 0], "vec_id": np.arange(4000), "label": np.ones(4000, np.int64), "v": as_lists(rows)})
    asked = pa.table({"anchor_id": [-1], "k": [0], "own": [1], "v": as_lists(member), "low": [-(2**62)], "high": [2**62], "floor": [-(2**62)]})
    found = negatives.walk(chunk, asked, 8, negatives.Asked(True, 5))
    score = rows.astype(np.int64) @ member[0].astype(np.int64)
    assert found.column("score").to_pylist() == sorted(score.tolist(), reverse=True)[:5]
    assert (sum(steps) < 1000) == narrow
