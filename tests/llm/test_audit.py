"""The filter audit against a plain run of every order over every document."""

import random
import re
from collections import Counter
from itertools import permutations

import compare
from shopmonth.llm import audit, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    """Rows of (id, text, part) and (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = []
    for i, text, part in docs:
        text, words = text or "", WORD.findall(text or "")
        fails = {name for name, failed in {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and any(j is not None and j < i and (other or "") == text for j, other, _ in docs)}.items() if failed}
        rows.append((part or "", fails, i in good, i in toxic))
    out, shapley = [], Counter()
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[1]]
                left = [r for r in left if name not in r[1]]
                failing = sum(name in r[1] for r in mine)
                shapley[part, name] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), failing - len(gone),
                            sum(r[1] == {name} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def rows(df):
    return sorted(tuple(r) for r in df.select("part", "filter_order", "step", *audit.COUNTS).collect())


def test_query_equals_brute_force_on_whole_tables(spark):
    sf = f"{compare.TESTDATA}/sf0.001"
    docs = [(r.doc_id, r.text, r.lang) for r in queries.table(spark, sf, "documents").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in queries.table(spark, sf, "labels").collect()]
    assert rows(queries.op12_filter_audit(spark, sf)) == brute(docs, labels)


def test_edges(spark):
    rng = random.Random(1)
    text = lambda n: rng.choice([" ", "\n", "\x0b"]).join(rng.choice(["a", "B", "#", "ÄÖ", "É", "cd", "\xa0"]) for _ in range(n))
    docs = [(k % 30, text(rng.choice([0, 1, 2, 3, 250])), rng.choice(["en", "", None])) for k in range(60)]
    docs += [(100, None, "en"), (101, "", "xx"), (None, "a", "en"), (None, "a", "en"), (102, "a", None), (102, "a", None), (103, "a", "en")]
    docs += [(104, "A " * 100_000, "en"), (105, " ".join(f"w{k}" for k in range(100_000)), "en"), (106, " \t ", "")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(30)] + [(5, 1, 1), (None, 1, 1), (999, 1, 1)]
    table = spark.createDataFrame([(*d, 1, "x", 7) for d in docs], "doc_id long, text string, lang string, A int, cell string, good int")
    marks = spark.createDataFrame([(*row, "x") for row in labels], "doc_id long, quality int, toxic int, part string")
    assert rows(audit.audit(table, marks)) == brute(docs, labels)
    assert rows(audit.audit(table, marks.limit(0))) == brute(docs, [])
    assert rows(audit.audit(table.limit(0), marks)) == []


def test_every_part_has_all_steps_and_zeros(spark):
    table = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(300)), "de")], "doc_id long, text string, lang string")
    found = rows(audit.audit(table, spark.createDataFrame([], "doc_id long, quality int, toxic int")))
    assert len(found) == 600 and {r[3:] for r in found} == {(1, 0, 0, 0, 0, 0, 0)}
