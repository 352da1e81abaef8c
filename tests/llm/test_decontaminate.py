"""Decontamination against a plain rescan of every window."""

import hashlib
import pickle
import random
import re

import pytest

import compare
from shopmonth.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items, window=13):
    out = []
    for doc_id, text in docs:
        mine, hit, found = words(text), set(), set()
        for item, passage in items:
            theirs = words(passage)
            n = min(window, len(theirs))
            if item is None or not n:
                continue
            wanted = {tuple(theirs[k:k + n]) for k in range(len(theirs) - n + 1)}
            for k in range(len(mine) - n + 1):
                if tuple(mine[k:k + n]) in wanted:
                    hit.update(range(k, k + n))
                    found.add(str(item))
        out.append((doc_id, len(mine), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(mine)))
    return out


def digest(df):
    return [tuple(r) for r in df.orderBy("doc_id").select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]


def test_query_equals_brute_force_on_whole_tables(spark):
    sf = f"{compare.TESTDATA}/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in queries.table(spark, sf, "documents").collect())
    items = [(r.item_id, r.text) for r in queries.table(spark, sf, "benchmark").collect()]
    assert digest(queries.op9_decontamination(spark, sf)) == brute(docs, items)


@pytest.mark.parametrize("limit", [1 << 20, 20])
def test_edges_and_several_indexes(spark, limit):
    rng = random.Random(3)
    vocabulary = ["a", "b", "Cé", "d1", "é"]
    text = lambda n: rng.choice([" ", "\n", ", "]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(1, text(30)), (2, text(3)), (3, ""), (4, None), (5, "zz"), (None, "a"), (1, text(4)), (7, text(13))]
    docs = [(k, text(rng.choice([0, 1, 2, 5, 40, 200]))) for k in range(40)]
    docs += [(100, None), (101, ""), (102, "..."), (103, "x " * 20000 + items[0][1]), (104, items[7][1].upper()), (104, "zz")]
    scanned = decontaminate.scan_documents(
        spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, n_words string"),
        spark.createDataFrame(items, "item_id long, text string"), window=5, max_broadcast_bytes=limit)
    got = sorted((r.doc_id, r.hits.n_words, r.hits.n_hit, sorted(r.hits["items"])) for r in scanned.collect())
    expected = []
    for doc_id, body in docs:
        row = brute([(doc_id, body)], items, 5)[0]
        found = [str(i) for i in {1, 2, 5, 7} if brute([(0, body)], [x for x in items if x[0] == i], 5)[0][3]]
        expected.append((doc_id, row[1], row[2], sorted(found)))
    assert got == sorted(expected)


def test_cut_and_drop(spark):
    docs = spark.createDataFrame([(1, "Vor É one two three nach"), (2, "clean"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "One, TWO three")], "item_id long, text string")
    cut = {r.doc_id: r.text for r in decontaminate.cut_spans(docs, items, 3).collect()}
    assert cut == {1: "Vor É  nach", 2: "clean", 3: None}
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, items, 3).collect()) == [2, 3]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.scan_documents(docs, none).first().hits.n_hit == 0
    assert decontaminate.scan_documents(docs.limit(0), none).count() == 0


def test_index_is_in_proportion_to_its_text():
    rng = random.Random(2)
    items = [(str(k), " ".join(rng.choice(["to", "be", "or", "not", f"w{rng.randrange(10**5)}"]) for _ in range(rng.choice([5, 300]))))
             for k in range(4000)]
    size = sum(len(text) for _, text in items)
    assert len(pickle.dumps(decontaminate.WindowIndex(items, 13))) < 16 * size
