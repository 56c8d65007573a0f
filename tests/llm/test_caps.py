"""Embedding near-duplicates against all pairs, and recall at the threshold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import caps, common


def plain(rows, cosine=0.9):
    good, out = [], {}
    for k, (_, v) in enumerate(rows):
        x = None if v is None or any(c is None for c in v) else np.array(v, float)
        if x is not None and len(x) and np.isfinite(x).all() and x.any():
            good.append((k, x / np.linalg.norm(x)))
    links = {k: [j for j, y in good if j != k and len(x) == len(y) and x @ y >= cosine] for k, x in good}
    comp = list(range(len(rows)))
    for _ in rows:
        for k, js in links.items():
            comp[k] = min([comp[k], *(comp[j] for j in js)])
    for k, (i, _) in enumerate(rows):
        own = [rows[j][0] for j in range(len(rows)) if comp[j] == comp[k] and rows[j][0] is not None]
        c = i if k not in links else min(own, default=None)
        out[k] = (i, len(links.get(k, [])), c, None if i is None or c is None else i == c)
    return sorted(out.values(), key=str)


def judged(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({"node": F.lit("x"), "raw": F.lit(0), "size": F.lit(1)})
    return sorted((tuple(r) for r in caps.near_vectors(df).collect()), key=str)


def test_matches_all_pairs(spark):
    rng = np.random.default_rng(9)
    rows, key = [], 0
    for dim in (1, 3, 16, 33):
        for _ in range(12):
            centre = rng.standard_normal(dim)
            for _ in range(6):
                rows.append((key, (centre + 0.25 * rng.standard_normal(dim)).astype(np.float32).tolist()))
                key += 1
    rows += [(1000 + k, [1.0, 2.0, 3.0]) for k in range(30)] + [(2000, [2.0, 4.0, 6.0]), (7, rows[7][1]), (None, rows[40][1])]
    rows += [(3000, None), (3001, []), (3002, [0.0, -0.0]), (3003, [1.0, None]), (3004, [float("nan"), 1.0]), (3005, [float("inf"), 1.0]), (None, None), (3006, [1e-38, 0.0]), (3007, [1e38, 0.0]), (3008, [-0.0, 5.0]), (3009, [0.0, 5.0])]
    assert judged(spark, rows) == plain(rows)


def test_blocks_of_a_crowded_filter(spark, monkeypatch):
    monkeypatch.setattr(caps, "BLOCK", 8)
    monkeypatch.setattr(caps, "SLICE", 5)
    rng = np.random.default_rng(1)
    centre = rng.standard_normal(8)
    rows = [(k, (centre + 0.3 * rng.standard_normal(8)).astype(np.float32).tolist()) for k in range(150)]
    assert judged(spark, rows) == plain(rows)


def test_hubs_and_copies_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    monkeypatch.setattr(common, "HOT_SHARE", 10**9)
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(16)
    rows = [(k, (centre + (0.1 if k % 3 else 1.0) * rng.standard_normal(16)).astype(np.float32).tolist()) for k in range(80)]
    rows += [(100 + k, rows[1][1]) for k in range(40)]
    assert judged(spark, rows) == plain(rows)


def test_doubles_and_long_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal(1500)
    rows = [(1, x.tolist()), (2, (x * (1 + 1e-12)).tolist()), (3, (-x).tolist()), (4, [1.0, 1e-17]), (5, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in caps.near_vectors(df).collect()) == [(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 1, 4), (5, 1, 4)]


def test_ties_of_the_last_filter_all_count():
    code = caps.Code(4, 16)
    code.a[1], code.b[3] = code.a[0], code.b[2]  # equal directions tie
    unit = np.random.default_rng(2).standard_normal((50, 4))
    for n in (1, 3, 10):
        row, name = code.decode(unit, n)
        turned = unit @ code.turn
        sums = ((turned[:, :2] @ code.a.T)[:, :, None] + (turned[:, 2:] @ code.b.T)[:, None, :]).reshape(50, -1)
        for r in range(50):
            want = set(np.flatnonzero(sums[r] >= np.sort(sums[r])[-n]).tolist())
            assert set(name[row == r].tolist()) == want


def test_empty_table(spark):
    assert judged(spark, []) == [] and judged(spark, [(1, None)]) == [(1, 0, 1, True)]


@pytest.mark.parametrize("k", [16, 64, 256, 512, 1024, 2048, 4096, 8192])
def test_recall_at_the_threshold(k):
    """Pairs at cosine exactly 0.9, for every size of the code up to some 1.4 billion vectors."""
    rng = np.random.default_rng(5)
    n = 4000
    x = rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    g = rng.standard_normal((n, 64))
    g -= (g * x).sum(1)[:, None] * x
    g /= np.linalg.norm(g, axis=1)[:, None]
    y = 0.9 * x + np.sqrt(1 - 0.81) * g
    codes = caps.Codes(64, k, caps.FILTERS)
    assert sum(not set(a.tolist()) & set(b.tolist()) for a, b in zip(codes.decode(x), codes.decode(y))) <= 2
