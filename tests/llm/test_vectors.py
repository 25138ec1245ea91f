"""Operators on embeddings against brute force."""
import math
from collections import Counter

import numpy as np
import pytest

from ledgerflow.llm import lattice_dedup, rp_forest

SCHEMA = "vec_id long, embedding array<float>, label int, node long, id string, cell long"
DIMS = 24


def vectors():
    """Clusters, exact copies, a chain of links, and every kind of vector that takes no part."""
    rng = np.random.default_rng(3)
    out = [rng.standard_normal(DIMS) for _ in range(60)]
    for base in out[:4]:
        out += [base + 0.12 * rng.standard_normal(DIMS) for _ in range(12)]
    out += [out[5], out[5], out[6] * 2]
    a, b = np.eye(DIMS)[0], np.eye(DIMS)[1]
    out += [math.cos(x) * a + math.sin(x) * b for x in np.arange(0, 1.6, 0.3)]
    rows = [(3 * i, [float(x) for x in v], i % 2 if i < 60 else 1, 1, "x", 2) for i, v in enumerate(out)]
    rows = [r[:2] + ((0,) if 60 <= i < 108 else (r[2],)) + r[3:] for i, r in enumerate(rows)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * DIMS, [nan] + [1.0] * (DIMS - 1), [inf] * DIMS, [None] + [1.0] * (DIMS - 1),
           [1.0, 2.0]]
    rows += [(1000 + i, v, 0, None, None, None) for i, v in enumerate(odd)]
    rows += [(2000, rows[0][1], None, 1, "x", 1), (None, rows[0][1], 0, 1, "x", 1), rows[10]]
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(vectors(), SCHEMA).repartition(3).cache()


def fine(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_lattice_against_brute_force(spark, table):
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    live = [i for i, (d, v, lab) in enumerate(rows) if fine(v) and d is not None and lab is not None]
    links, parent = Counter(), {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in live:
        for j in live:
            (a, u, la), (b, v, lb) = rows[i], rows[j]
            if i != j and la == lb and len(u) == len(v):
                u, v = np.array(u, dtype=float), np.array(v, dtype=float)
                if u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.93:
                    links[i] += 1
                    lo, hi = sorted((root(a), root(b)))
                    parent[hi] = lo
    want = Counter((d, links[i], root(d), d is None or root(d) == d) for i, (d, _, _) in enumerate(rows))
    got = Counter(tuple(r) for r in lattice_dedup.near_duplicates(table).collect())
    assert got == want
    assert lattice_dedup.near_duplicates(table.limit(0)).count() == 0


def test_lattice_tables_rarely_miss_a_link():
    """Pairs at the threshold: missed by all tables together less than once in 100,000."""
    rng = np.random.default_rng(6)
    a, b = rng.standard_normal((2, 4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= np.einsum("ij,ij->i", a, b)[:, None] * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cos = lattice_dedup.THRESHOLD
    b = cos * a + math.sqrt(1 - cos ** 2) * b
    args = lattice_dedup.TABLES, lattice_dedup.PROBES, lattice_dedup.SCALE
    (own, near), (own2, near2) = lattice_dedup.cells(a, *args), lattice_dedup.cells(b, *args)
    meet = ((own == own2) | (own[:, :, None] == near2).any(axis=2) | (own2[:, :, None] == near).any(axis=2))
    assert (1 - meet.mean()) ** lattice_dedup.TABLES < 1e-5


def test_nearest_lattice_point():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 8)) * 2
    p = lattice_dedup.nearest(x)
    assert np.allclose((2 * p) % 2, (2 * p[:, :1]) % 2) and np.allclose(p.sum(axis=1) % 2, 0)
    far = ((x - p) ** 2).sum(axis=1)
    for v in lattice_dedup.shortest():
        assert (far <= ((x - p - v) ** 2).sum(axis=1) + 1e-9).all()
    assert (far <= 1 + 1e-9).all()  # the covering radius


def brute_nearest(rows, queries, k):
    out = {}
    for q, u in queries:
        far = {}
        for d, v in rows:
            if d != q:
                s = float(np.sqrt(((np.array(v, dtype=float) - np.array(u, dtype=float)) ** 2).sum()))
                far[d] = min(s, far.get(d, s))
        out[q] = sorted((s, d) for d, s in far.items())[:k]
    return out


def test_forest_is_exact_when_everything_is_in_reach(spark, table):
    rows = [(r.vec_id, r.embedding) for r in table.collect()
            if r.vec_id is not None and fine(r.embedding) and len(r.embedding) == DIMS]
    asked = table.where("vec_id % 5 = 0")
    want = brute_nearest(rows, {(q, tuple(v)) for q, v in rows if q % 5 == 0}, 10)
    got = {}
    for r in rp_forest.search(table, asked, 10, reach=10.0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want)
    for q, found in got.items():
        found.sort()
        assert [x[0] for x in found] == list(range(1, len(want[q]) + 1))
        assert [x[1] for x in found] == [d for _, d in want[q]]
        assert np.allclose([x[2] for x in found], [s for s, _ in want[q]], atol=1e-12, rtol=0)


def test_forest_few_candidates_and_empty(spark, table):
    few = table.where("vec_id IN (0, 3, 6)")
    got = rp_forest.search(few, few, 10).collect()
    assert Counter(r.query_id for r in got) == {0: 2, 3: 2, 6: 2}
    assert rp_forest.search(table.limit(0), table.limit(0), 10).count() == 0


def test_forest_recall(spark):
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = t.select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    hits = total = 0
    got = {}
    for r in rp_forest.search(t, t.where("vec_id % 100 = 0"), 10).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    for i in np.flatnonzero(ids % 100 == 0):
        far = ((x - x[i]) ** 2).sum(axis=1)
        far[i] = np.inf
        near = set(ids[np.lexsort((ids, far))[:10]])
        hits += len(near & got[ids[i]])
        total += len(near)
    assert hits / total >= 0.95
