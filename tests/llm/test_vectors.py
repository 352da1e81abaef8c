"""Vector links against all cosines."""

import math
import random

import numpy as np
import pytest

import compare
from shopmonth.llm import queries, vectors


def brute(rows, threshold=0.93):
    ok = [r for r in rows if r[2] is not None and r[1] is not None and len(r[1]) and all(
        x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    parent = {id(r): id(r) for r in rows}
    by_id = {id(r): r for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = {id(r): 0 for r in rows}
    for at, a in enumerate(ok):
        for b in ok[at + 1:]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                u, v = (np.array(x[1], dtype=np.float64) for x in (a, b))
                if u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= threshold:
                    links[id(a)] += 1
                    links[id(b)] += 1
                    parent[root(id(b))] = root(id(a))
    lowest = {}
    for r in rows:
        if r[0] is not None:
            lowest[root(id(r))] = min(lowest.get(root(id(r)), r[0]), r[0])
    out = [(r[0], links[k], lowest.get(root(k)), r[0] is not None and r[0] == lowest.get(root(k))) for k, r in by_id.items()]
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("block", [2048, 20])
def test_edges_and_blocks(spark, block):
    rng = np.random.default_rng(3)
    rows = []
    for label in (1, 2):
        for base in rng.standard_normal((12, 16)):
            for k in range(5):
                rows.append((len(rows), (base + rng.standard_normal(16) * 0.12 * k).astype(np.float32).tolist(), label))
    rows += [(500 + k, rows[3][1], 1) for k in range(4)] + [(600, rows[3][1], None), (601, None, 1), (602, [], 1), (603, [0.0] * 16, 1),
             (604, [float("nan")] * 16, 1), (605, [None] * 16, 1), (606, [float("inf")] * 16, 1), (607, [1.0, 2.0], 1), (608, [2.0, 4.0], 1),
             (None, rows[3][1], 1), (3, rows[4][1], 1), (None, None, None), (609, [1e-30] * 16, 2), (610, [1e30] * 16, 2)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    assert result(vectors.near_duplicates(df, block=block)) == brute(
        [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows])


def test_query_on_whole_table(spark):
    sf = f"{compare.TESTDATA}/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in queries.table(spark, sf, "embeddings").collect()]
    got, wanted = result(queries.op5_embedding_near_dedup(spark, sf)), brute(rows)
    assert got == wanted


def test_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((4000, 64))
    b -= (b * a).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.9301 * a + math.sqrt(1 - 0.9301 ** 2) * b
    found = sum(len(vectors.linked_pairs(a[k:k + 500], b[k:k + 500], 0.93, False)[0]) for k in range(0, 4000, 500))
    assert found >= 0.998 * 4000


def test_empty(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_forest():
    rng = random.Random(2)
    links = [(rng.randrange(30), 100 + rng.randrange(30)) for _ in range(200)]
    out = vectors.forest(np.array([a for a, _ in links]), np.array([b for _, b in links]))
    assert len(out) == len({x for l in links for x in l}) - 1
