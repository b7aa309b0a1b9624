import hashlib

import numpy as np
import pytest

from snapline.llm import simplex as S

SCHEMA = "vec_id long, embedding array<float>, cluster int, q int, id int"


def plain(vectors, k, rounds, scale):
    """``(id, cluster, distance)`` by loops over whole numbers."""
    rows = [(i, [min(max(int(np.floor(float(np.float32(x)) * scale)), -S.LIMIT), S.LIMIT) for x in v]) for i, v in vectors]
    order = sorted(rows, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda v: min((square(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = [best(v)[1] for _, v in rows]
        for j in range(len(centroids)):
            mine = [v for (_, v), c in zip(rows, own) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, best(v)[1], best(v)[0]) for i, v in rows], centroids


def frame(llm, vectors):
    return llm.createDataFrame([(i, v, 1, 1, 1) for i, v in vectors], SCHEMA)


@pytest.mark.parametrize("pivots", [1, 3, 12])
def test_against_loops(llm, pivots):
    drawn = np.random.default_rng(4)
    centers = drawn.normal(size=(5, 6)) * 3
    vectors = [(i, (centers[i % 5] + drawn.normal(size=6) * 0.4).tolist()) for i in range(150)]
    vectors += [(200 + i, vectors[i][1]) for i in range(30)] + [(0, vectors[0][1]), (None, vectors[1][1]), (None, [0.0] * 6)]
    want, centroids = plain(vectors, 7, 3, 16)
    got = S.clusters(frame(llm, vectors), k=7, rounds=3, size=6, scale=16, pivots=pivots).collect()
    key = lambda r: (r[0] is None, r)
    plainly = lambda rows: sorted(((i is None, i or 0, c, d) for i, c, d in rows))
    assert plainly((r.vec_id, r.cluster, r.distance) for r in got) == plainly(want) and key
    for r in got:
        assert r.centroid == centroids[r.cluster] and r.inertia == sum(d for _, _, d in want)
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)


def test_bounds_hold_and_drop_centroids():
    drawn = np.random.default_rng(1)
    q, c = drawn.integers(-2000, 2000, (300, 8)), drawn.integers(-2000, 2000, (20, 8))
    exact = S._squares(q, c)
    for n in (1, 2, 4, 8, 20):
        base = S.simplex(c, n)
        assert len(base.pivots) == min(n, 9)  # nine corners span eight dimensions
        low, high = S.bounds(base.apexes(S._squares(q, base.pivots)), base.apexes(S._squares(c, base.pivots)))
        assert (low <= exact).all() and (exact <= high).all()
        cluster, best, computed = S.nearest(q, low, high, c)
        assert (cluster == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert computed < 2 * len(q)  # with all corners the bounds are the distances


def test_degenerate_vectors(llm):
    same = [(i, [1.0, 2.0, 3.0]) for i in range(9)]
    got = S.clusters(frame(llm, same), k=4, rounds=2, size=3).collect()
    assert {(r.cluster, r.distance) for r in got} == {(0, 0)} and len(got) == 9
    line = [(i, [float(i % 4), 0.0, 0.0]) for i in range(20)]
    assert plain(line, 5, 2, 256)[0] == sorted((r.vec_id, r.cluster, r.distance) for r in S.clusters(frame(llm, line), k=5, rounds=2, size=3).collect())
    huge = [(1, [3e38, 0.0, 0.0]), (2, [-3e38, 0.0, 0.0]), (3, [1.0, 1.0, 1.0])]
    got = S.clusters(frame(llm, huge), k=2, rounds=1, size=3).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == plain(huge, 2, 1, 256)[0]


def test_which_rows_are_kept(llm):
    bad = [(1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, 2.0, None]), (5, [1.0, 2.0, float("nan")]), (6, [float("inf"), 0.0, 0.0]), (7, [1.0, 2.0, 3.0])]
    got = S.clusters(frame(llm, bad), size=3).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in got] == [(7, 0, 0, 0)]
    empty = S.clusters(frame(llm, bad[:6]), size=3)
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
