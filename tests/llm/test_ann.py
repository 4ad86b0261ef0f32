import numpy as np
import pytest

from stemma.llm import ann as A

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k=20):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in ok:
        if q % 20 == 0 and q not in out:
            s = sorted((-(np.float32(x).astype(float) * np.float32(v).astype(float)).sum(), i) for i, x in ok if i != q)
            out[q] = [(i, -a) for a, i in s[:k]]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    out = {}
    for r in sorted(A.search(df, **kw).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def close(a, b):
    assert a.keys() == b.keys()
    for q in a:
        assert [i for i, _ in a[q]] == [i for i, _ in b[q]]
        assert np.allclose([s for _, s in a[q]], [s for _, s in b[q]], rtol=0, atol=1e-9)


def test_small_tables_are_exact(spark):
    r = np.random.default_rng(1)
    rows = [(i, (r.standard_normal(16) * r.uniform(0.1, 3)).tolist()) for i in range(200)]
    odd = [(1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [None] + [1.0] * 15), (1080, [float("inf")] * 16), (None, [1.0] * 16), (1100, []), (1120, [1.0] * 3)]
    close(run(spark, rows + odd), brute(rows))
    close(run(spark, rows[:8]), brute(rows[:8]))
    assert run(spark, []) == run(spark, odd[:2]) == {}


def test_ties_and_copies(spark):
    one = [0.6, 0.8, 0.0, 0.0]
    rows = [(i, one) for i in range(60)] + [(i, [0.0, 0.0, 1.0, 0.5]) for i in range(60, 90)]
    close(run(spark, rows), brute(rows))
    close(run(spark, rows, lists=2), brute(rows))


@pytest.mark.parametrize("hot", [0, 1500])
def test_recall(spark, monkeypatch, hot):
    monkeypatch.setattr(A, "VECTORS", 300)  # many cells, also within a list
    monkeypatch.setattr(A, "QUERIES", 40)
    r = np.random.default_rng(2)
    x = r.standard_normal((3000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[:hot] = x[0]
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    got, want = run(spark, rows, lists=25), brute(rows)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit / (20 * len(want)) >= 0.9
    v = dict(rows)
    for q, found in got.items():
        assert found == sorted(found, key=lambda p: (-p[1], p[0]))
        assert all(abs(s - np.dot(np.float32(v[q]).astype(float), np.float32(v[i]).astype(float))) < 1e-12 for i, s in found)
