"""Substring dedup against a plain table of all windows."""

import hashlib
import random
import re

import pytest

import compare
from shopmonth.llm import passages, queries
from shopmonth.llm.automaton import SuffixAutomaton

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs):
    texts = [(i, WORD.findall(text or "")) for i, text in docs]
    first = {}
    for i, words in texts:
        for k in range(len(words) - 12) if i is not None else ():
            window = tuple(words[k:k + 13])
            first[window] = min(first.get(window, i), i)
    out = []
    for i, words in texts:
        gone = set()
        for k in range(len(words) - 12) if i is not None else ():
            if first[tuple(words[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in df.collect()), key=str)


def test_query_equals_brute_force_on_whole_tables(spark):
    sf = f"{compare.TESTDATA}/sf0.01"
    docs = [(r.doc_id, r.text) for r in queries.table(spark, sf, "documents").collect()]
    assert sorted((tuple(r) for r in queries.op13_substring_dedup(spark, sf).collect()), key=str) == brute(docs)


@pytest.mark.parametrize("options", [{}, {"hot": 2, "shard_words": 1}, {"hot": 0, "shard_words": 40}])
def test_edges(spark, options):
    rng = random.Random(4)
    vocabulary = ["a", "B", "b", "Cé", "d,", "\xa0", "e." ]
    blanks = [" ", "\n", "\t ", "\x0b"]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, other = say(30), say(13)
    docs = []
    for k in range(60):
        parts = [say(rng.choice([0, 1, 5, 12, 40]))]
        for _ in range(rng.choice([0, 1, 2])):
            a, b = sorted(rng.sample(range(31), 2))
            parts += [rng.choice([passage, passage[a:b], other]), say(rng.choice([0, 3, 20]))]
        docs.append((k % 50, rng.choice(blanks).join(w for p in parts for w in p)))
    docs += [(100, None), (101, ""), (102, " \n"), (None, " ".join(passage)), (None, None), (103, "a " * 5000), (104, "a " * 20),
             (105, " ".join(passage) + " x"), (106, "\t".join(passage)), (106, "\t".join(passage)), (-5, " ".join(other * 3)), (107, " ".join(say(60_000)))]
    table = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in docs], "doc_id long, text string, id int, key string, marks string").repartition(5)
    assert found(passages.without_repeats(table, **options)) == brute(docs)


def test_empty_table(spark):
    assert found(passages.without_repeats(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_automaton_gives_the_smallest_owner_of_each_window():
    rng = random.Random(5)
    for window in (1, 3, 6):
        for _ in range(60):
            texts = [[rng.randrange(3) for _ in range(rng.randrange(1, 30))] for _ in range(8)]
            owners = [rng.randrange(100) for _ in texts]
            automaton = SuffixAutomaton()
            for text, owner in zip(texts, owners):
                automaton.add(text, owner)
            automaton.finish(window)
            stream = [rng.randrange(4) for _ in range(80)]
            for text in [*texts, stream]:
                wanted = []
                for k in range(len(text) - window + 1):
                    holders = [o for t, o in zip(texts, owners) if any(t[j:j + window] == text[k:k + window] for j in range(len(t) - window + 1))]
                    wanted.append(min(holders, default=None))
                assert automaton.window_owners(text, window) == wanted
