"""Near-duplicate vectors against all pairs, and the odd cases."""

from collections import Counter

import numpy as np
import pytest

from tarnworks.llm import embedding_dedup as ed

ROW = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=ed.COSINE):
    """n_links and component of each (vec_id, embedding, label) by all pairs."""
    good = [k for k, (i, v, label) in enumerate(rows) if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, up = Counter(), list(range(len(rows)))

    def root(k):
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    groups = {}
    for k in good:
        groups.setdefault((rows[k][2], len(rows[k][1])), []).append(k)
    for own in groups.values():
        x = np.array([rows[k][1] for k in own], np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= cosine, 1))):
            links[own[a]] += 1
            links[own[b]] += 1
            up[root(own[a])] = root(own[b])
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, links[k], least.get(root(k)), i == least.get(root(k))) for k, (i, _, _) in enumerate(rows)), key=repr)


def rows_of(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


def at_cosine(rng, v, cosine):
    u = rng.standard_normal(len(v))
    u -= u @ v / (v @ v) * v
    return cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine**2) * u / np.linalg.norm(u)


def made(n, dim, seed=1, labels=2):
    """Vectors of which a third are near copies of others, at cosines around the least, and some are exact copies."""
    rng, out = np.random.default_rng(seed), []
    for i in range(n):
        if i % 3 == 2:
            v, label = out[rng.integers(len(out))][1:]
            v = v if i % 4 == 2 else [float(x) for x in at_cosine(rng, np.array(v), rng.uniform(0.91, 0.99)).astype(np.float32)]
        else:
            v, label = [float(x) for x in rng.standard_normal(dim).astype(np.float32)], int(rng.integers(labels))
        out.append((i, v, label))
    return out


def recall(got, want):
    return sum(min(g[1], w[1]) for g, w in zip(got, want)) / sum(w[1] for w in want)


def test_small_groups_are_exact(spark):
    rows = made(300, 16)
    assert rows_of(ed.near_duplicate_vectors(spark.createDataFrame(rows, ROW))) == brute(rows)


def test_recall_through_trees(spark, monkeypatch):
    monkeypatch.setattr(ed, "LEAF", 40)
    rows = made(4000, 48, 3)
    got, want = rows_of(ed.near_duplicate_vectors(spark.createDataFrame(rows, ROW))), brute(rows)
    assert all(g[0] == w[0] and g[1] <= w[1] for g, w in zip(got, want))
    assert recall(got, want) > 0.97
    one = rows_of(ed.near_duplicate_vectors(spark.createDataFrame(rows, ROW), trees=1))
    assert 0.4 < recall(one, want) < recall(got, want)


def test_several_rounds_reach_leaves(spark, monkeypatch):
    monkeypatch.setattr(ed, "LEAF", 40)
    monkeypatch.setattr(ed, "SAMPLE", 200)
    monkeypatch.setattr(ed, "DEPTH", 2)
    monkeypatch.setattr(ed, "PLANES", 3)
    rows = made(2000, 32, 5)
    got, want = rows_of(ed.near_duplicate_vectors(spark.createDataFrame(rows, ROW))), brute(rows)
    assert recall(got, want) > 0.95 and all(g[1] <= w[1] for g, w in zip(got, want))


@pytest.mark.parametrize("block", [16, 1024])
def test_close_groups_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(ed, "LEAF", 30)
    monkeypatch.setattr(ed, "BLOCK", block)
    rng = np.random.default_rng(2)
    v = rng.standard_normal(24)
    rows = [(i, [float(x) for x in at_cosine(rng, v, 0.985).astype(np.float32)], 7) for i in range(150)]
    rows += [(1000 + i, [1.0] * 24, 7) for i in range(200)] + [(2000 + i, [2.0] * 24, 8) for i in range(3)]
    assert rows_of(ed.near_duplicate_vectors(spark.createDataFrame(rows, ROW))) == brute(rows)


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (None, v, 1), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 3.0], 1), (9, [1.0, float("nan"), 3.0], 1),
        (10, [1.0, float("inf"), 3.0], 1), (11, [2.0, 4.0, 6.0], 1), (12, [1.0, 2.0], 1), (13, [-0.0, 1.0, 0.0], 1), (14, [0.0, 1.0, -0.0], 1), (15, [1e-30, 2e-30, 3e-30], 1), (11, [0.0, 0.0, -1.0], 1),
    ]
    wide = spark.createDataFrame([(*r, b"k", 0, "n") for r in rows], ROW + ", key binary, node int, size string")
    got = rows_of(ed.near_duplicate_vectors(wide))
    assert [r for r in got if r[0] is not None] == [r for r in brute(rows) if r[0] is not None]
    assert (None, 0, None, True) in got and len(got) == len(rows)
    double = spark.createDataFrame([(1, [1e200, 1e200], 1), (2, [1e-200, 1.0000001e-200], 1)], "vec_id long, embedding array<double>, label int")
    assert rows_of(ed.near_duplicate_vectors(double)) == [(1, 1, 1, True), (2, 1, 1, False)]
    assert ed.near_duplicate_vectors(spark.createDataFrame([], ROW)).collect() == []
