import math

import numpy as np
import pytest

from acctlens.llm.ann import (STEPS, ann_search, codes_of, fitted_rotation, in_ring, index_bytes, index_from, parts_of, radius_by_cosine,
                               rings, search, substrings)
from acctlens.llm.topk import accumulate, exact_top_k, select_best

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, score string, rank string, n string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], VECTORS)


def edge_vectors():
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(12)]) for i in range(1, 140)]
    rows += [(0, rows[0][1]), (200, rows[0][1]), (201, rows[0][1]), (100, rows[99][1]), (100, rows[5][1])]  # ties, repeats
    return rows + [(300, None), (301, [None] * 12), (302, [NAN] * 12), (303, [INF] + [0.0] * 11), (350, [0.0] * 12),
                   (None, rows[3][1]), (304, rows[7][1][:5])]


def fine(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def test_exact_top_k_equals_brute_force(spark):
    rows = edge_vectors()
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and fine(v)]
    want = []
    for n, (q, v) in enumerate(good):
        if q % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), c) for m, (c, w) in enumerate(good) if m != n)[:5]
            want += [(q, k, c, -x) for k, (x, c) in enumerate(s, 1)]
    got = sorted(tuple(r) for r in exact_top_k(vectors(spark, rows)).collect())
    assert got == sorted(want)


def test_few_rows_and_empty_tables(spark):
    two = [(50, [1.0, 2.0]), (51, [2.0, 1.0])]
    assert [tuple(r) for r in exact_top_k(vectors(spark, two)).collect()] == [(50, 1, 51, 256 * 256 * 4)]
    (row,) = ann_search(vectors(spark, two)).collect()
    assert row[:3] == (50, 1, 51) and abs(row.score - 0.8) < 1e-12
    for f in (exact_top_k, ann_search):
        assert f(vectors(spark, [])).collect() == []


def test_accumulate_is_the_inner_product():
    rng = np.random.default_rng(1)
    q, c = rng.integers(-9, 9, (5, 7)), rng.integers(-2, 3, (40, 7)) * (rng.random((40, 7)) < 0.3)
    assert (accumulate(q, np.asfortranarray(c)) == q @ c.T).all()
    assert sorted(select_best(np.array([5, 7, 7, 7, 1]), 2, 1)) == [2, 3]


def test_ann_edge_cases(spark):
    rows = edge_vectors()
    good = [(i, np.array(v + [0.0] * (12 - len(v)))) for i, v in rows if i is not None and fine(v) and any(v)]
    got = {}
    for r in ann_search(vectors(spark, rows)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i, _ in good if i % 50 == 0}
    hits = asked = 0
    for n, (q, v) in enumerate(good):
        if q % 50 or q == 100:  # 100 is there twice
            continue
        cos = sorted((-float(v @ w / math.sqrt(v @ v) / math.sqrt(w @ w)), c) for m, (c, w) in enumerate(good) if m != n)
        assert [k for k, _, _ in sorted(got[q])] == [1, 2, 3, 4, 5]
        hits += len({c for _, c in cos[:5]} & {c for _, c, _ in got[q]})
        asked += 5
    assert hits >= 0.9 * asked
    assert [c for _, c, _ in sorted(got[0])][:3] == [1, 200, 201]  # equal vectors, ties to the smaller id


@pytest.mark.parametrize("ring", range(6))
def test_probing_sees_every_code_in_the_radius(ring):
    rng = np.random.default_rng(ring)
    codes = rng.integers(0, 256, (3000, 8), dtype=np.uint8)
    parts = parts_of(64, len(codes))
    assert parts[0][0] == 0 and parts[-1][1] == 64 and max(hi - lo for lo, hi in parts) <= 13
    same, index = index_from(index_bytes(codes, parts), len(codes), parts)
    assert (same == codes).all()
    seen = np.zeros(len(codes), bool)
    rows = np.concatenate([in_ring(substrings(codes[17:18], parts)[:, 0], a, index, parts, seen) for a in range(ring + 1)])
    assert len(set(rows.tolist())) == len(rows) == seen.sum()
    far = np.unpackbits(codes ^ codes[17], axis=1)
    assert set(np.flatnonzero(far.sum(axis=1) < len(parts) * (ring + 1))) <= set(rows.tolist())
    assert set(rows.tolist()) == set(np.flatnonzero(np.min([far[:, lo:hi].sum(axis=1) for lo, hi in parts], axis=0) <= ring))
    assert [len(r) for r in rings(4)] == [1, 4, 6, 4, 1]


def clustered(n):
    rng = np.random.default_rng(8)
    m = rng.standard_normal((n // 20, 64))[rng.integers(0, n // 20, n)] + 0.3 * rng.standard_normal((n, 64))
    return m / np.sqrt((m * m).sum(axis=1))[:, None]


def test_the_radius_follows_what_is_found():
    """Clustered vectors: few rows are probed and reranked, nearly all neighbours are found."""
    m = clustered(8000)
    mean, turn = fitted_rotation(m[:4000])
    codes = codes_of(m, mean, turn)
    radii = radius_by_cosine(m[:4000], codes[:4000], 0.97)
    assert len(radii) == STEPS + 1 and (np.diff(radii) <= 0).all()
    parts = parts_of(64, len(m))
    _, index = index_from(index_bytes(codes, parts), len(m), parts)
    hits = seen = ranked = 0
    for q in range(0, len(m), 80):
        rows, scores, probed = search(codes[q], codes, index, parts, radii, lambda r: m[r] @ m[q], 5, skip=q)
        assert q not in rows and len(set(rows.tolist())) == len(rows) and np.allclose(scores, m[rows] @ m[q])
        s = m @ m[q]
        s[q] = -2
        hits += len(set(np.argsort(-s)[:5].tolist()) & set(rows.tolist()))
        seen, ranked = seen + probed, ranked + len(rows)
    assert hits >= 0.9 * 500 and seen < 0.2 * 100 * len(m) and ranked < 0.05 * 100 * len(m)


def test_ann_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    m = df.toPandas()
    x = np.array(m.embedding.tolist(), float)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    found = ann_search(df).toPandas().groupby("query_id").vec_id.apply(set)
    hits = asked = 0
    for i in np.flatnonzero(m.vec_id % 50 == 0):
        s = x @ x[i]
        s[i] = -2
        hits += len(set(m.vec_id[np.argsort(-s)[:5]]) & found[m.vec_id[i]])
        asked += 5
    assert hits >= 0.9 * asked


def test_rotation_is_orthogonal():
    sample = np.random.default_rng(2).standard_normal((300, 16))
    mean, r = fitted_rotation(sample)
    assert np.allclose(r.T @ r, np.eye(16), atol=1e-8)
    assert codes_of(sample, mean, r).shape == (300, 2)
