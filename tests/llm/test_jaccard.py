"""Size-aware Jaccard components against all pairs."""

import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

import compare
from shopmonth.llm import jaccard, queries
from shopmonth.llm.graph import connected_components
from shopmonth.llm.jaccard import Similarity

UPPER = {c: c + 32 for c in range(65, 91)}


def shingles(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(docs, n=3, over=90, under=100):
    sets = [(d, shingles(t, n)) for d, t in docs]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    owners = defaultdict(set)
    for k, (_, s) in enumerate(sets):
        for x in s:
            owners[x].add(k)
    for k, (_, s) in enumerate(sets):
        for other in {o for x in s for o in owners[x] if o > k}:
            both = len(s & sets[other][1])
            if under * both >= over * (len(s) + len(sets[other][1]) - both):
                parent[root(other)] = root(k)
    lowest = defaultdict(list)
    for k, (d, _) in enumerate(sets):
        lowest[root(k)].append(d)
    name = {r: min((d for d in ds if d is not None), default=None) for r, ds in lowest.items()}
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    return sorted([(d, len(s), name[root(k)]) for k, (d, s) in enumerate(sets)], key=key)


def result(df):
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    return sorted([tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()], key=key)


def test_query_equals_all_pairs_on_whole_table(spark):
    sf = f"{compare.TESTDATA}/sf0.01"
    docs = [(r.doc_id, r.text) for r in queries.table(spark, sf, "documents").collect()]
    assert result(queries.op10_jaccard_join(spark, sf)) == brute(docs)


def family(rng, size, copies, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        yield " ".join(words[rng.randrange(2):])


@pytest.mark.parametrize("over,under,n", [(90, 100, 3), (4, 5, 5), (1, 1, 2)])
def test_small_and_large_sets(spark, monkeypatch, over, under, n):
    monkeypatch.setattr(jaccard, "SHORT_LIST", 6)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 2000)
    rng = random.Random(n)
    texts = [t for size in (4, 12, 20, 21, 22, 30, 45, 60, 150) for t in family(rng, size, 14, 3)]
    texts += ["", None, "  \t", "One", "one", "one two", "\x00 a b", "x " * 3000 + "end", "x " * 2999 + "end"] * 2
    docs = list(enumerate(texts)) + [(None, texts[0]), (None, "alone here now indeed yes"), (3, texts[3])]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_shingles int").repartition(3)
    got = result(jaccard.jaccard_components(df, shingle=n, similarity=Similarity(over, under)))
    assert got == brute(docs, n, over, under)


@pytest.mark.parametrize("boundary", [0, 10, 25])
def test_any_boundary_gives_the_same(spark, monkeypatch, boundary):
    monkeypatch.setattr(jaccard, "boundary_by_cost", lambda *_: boundary)
    rng = random.Random(7)
    docs = list(enumerate(t for size in (10, 20, 23, 26, 28) for t in family(rng, size, 12, 2)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(jaccard.jaccard_components(df)) == brute(docs)


def test_empty_table(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_overlap_matches_fractions():
    for over, under in ((90, 100), (4, 5)):
        sim = Similarity(over, under)
        for r in range(1, 60):
            for s in range(sim.smallest(r), sim.largest(r) + 1):
                o = sim.overlap(r, s)
                assert Fraction(o, r + s - o) >= Fraction(over, under) or o > min(r, s)
                assert Fraction(o - 1, r + s - o + 1) < Fraction(over, under)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(6, 30)] + [(1, 1), (None, 2)]
    rng.shuffle(links)
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 5 for k in range(5, 30)}}


def test_joining_links_form_a_forest():
    a = np.arange(100, dtype=np.uint64)
    sets = [a, a[:98], a[2:], np.arange(500, 600, dtype=np.uint64)]
    assert len(jaccard.joining_links([1, 2, 3, 4], [1, 2, 3, 4], sets, 9, 10)) == 2


def test_sketches_never_overstate_the_difference():
    rng = np.random.default_rng(2)
    for r, s in ((3, 3), (200, 260), (300, 5000), (40_000, 70_000)):
        pool = np.unique(rng.integers(0, 2**63, r + s, dtype=np.uint64))
        a, b = rng.choice(pool, r, replace=False), rng.choice(pool, s, replace=False)
        different = len(np.setxor1d(a, b))
        bits = [np.frombuffer(jaccard.parity_sketch(x), np.uint8) for x in (a, b)]
        assert jaccard.differing_bits(*bits) == jaccard.differing_bits(*bits[::-1]) <= different
        assert jaccard.differing_bits(bits[0], bits[0]) == 0


def test_sizes_in_reach_share_a_band(spark):
    for sim in (Similarity(90, 100), Similarity(4, 5), Similarity(1, 1)):
        band = [r.b for r in spark.range(1, 3000).select(sim.band("id").alias("b")).collect()]
        for r in range(1, 2400):
            assert band[min(sim.largest(r), 2999) - 1] - band[r - 1] <= 1
