"""The character model against a plain implementation, and against the labels."""

import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import compare
from shopmonth.llm import kneser_ney as kn
from shopmonth.llm import queries


def plain_model(texts, order):
    """Probability function of an interpolated modified Kneser-Ney model."""
    levels = [None] * (order + 1)
    levels[order] = Counter()
    for text in texts:
        padded = "\x02" * (order - 1) + "".join("0" if c in "0123456789" else c for c in text) + "\x03"
        levels[order].update(padded[k:k + order] for k in range(len(padded) - order + 1))
    for size in range(order - 1, 0, -1):
        levels[size] = Counter(g[1:] for g in levels[size + 1])
    cuts = [None]
    for size in range(1, order + 1):
        n = [max(1e-9, sum(v == k for v in levels[size].values())) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        cuts.append([max(0.1, min(k - 0.1, k - (k + 1) * y * n[k] / n[k - 1])) for k in (1, 2, 3)])
    contexts = [None] + [defaultdict(list) for _ in range(order)]
    for size in range(1, order + 1):
        for gram, count in levels[size].items():
            contexts[size][gram[:-1]].append(count)

    def probability(gram):
        if not gram:
            return 1 / (len(levels[1]) + 1)
        size, below = len(gram), probability(gram[1:])
        counts = contexts[size].get(gram[:-1])
        if not counts:
            return below
        cut = lambda c: cuts[size][min(c, 3) - 1]
        mine = levels[size].get(gram, 0)
        own = mine - cut(mine) if mine else 0
        return (own + sum(map(cut, counts)) * below) / sum(counts)

    return probability


def plain_perplexity(probability, text, order):
    padded = "\x02" * (order - 1) + "".join("0" if c in "0123456789" else c for c in text) + "\x03"
    logs = [math.log(probability(padded[k:k + order])) for k in range(len(padded) - order + 1)]
    return math.exp(-sum(logs) / len(logs))


TRAIN = ["the cat sat on the mat", "the dog sat", "a cat and a dog 12", "é" * 9, "the hat", "tttt", "äöü x äöü"]
SCORE = ["the cat", "zzz zzz", "", None, "at 47", "dog\x00 mat", "long " * 3000, "é ü", "the cat"]


@pytest.mark.parametrize("order,block", [(3, 1 << 20), (5, 40)])
def test_perplexity_equals_plain_model(spark, order, block):
    trained = spark.createDataFrame([("x", t) for t in TRAIN], "lang string, text string")
    model = kn.kneser_ney(kn.count_ngrams(trained, order), order).cache()
    docs = spark.createDataFrame([(k, "x", t) for k, t in enumerate(SCORE)] + [(99, "none", "the cat")],
                                 "id long, lang string, text string")
    got = {r.id: r.perplexity for r in kn.perplexities(docs, model, order, block).collect()}
    probability = plain_model(TRAIN, order)
    assert got.pop(99) is None and len(got) == len(SCORE)
    for k, text in enumerate(SCORE):
        if not text:
            assert got[k] is None
        else:
            assert got[k] == pytest.approx(plain_perplexity(probability, text.replace("\x00", "�"), order), rel=1e-5)


def test_probabilities_add_up_to_one():
    probability = plain_model(TRAIN, 3)
    letters = sorted({c for t in TRAIN for c in t if c not in "12"} | {"0", "\x03"})
    for context in ("th", "zz", " c", "\x02\x02"):
        assert sum(probability(context + c) for c in letters) + probability(context + "☃") == pytest.approx(1)


def test_decisions_and_clashing_columns(spark):
    docs = [(k, "the cat sat on the mat number %d" % (k % 3), "en") for k in range(60)]
    docs += [(100, "QZ!!## XX ||| %%% ~~~~", "en"), (101, None, "en"), (102, "", "en"), (103, "no model here", "fi"),
             (104, "the cat sat on the mat", None), (105, None, "fi"), (106, "", None), (None, docs[1][1], "en"), (5, docs[5][1], "en")]
    frame = spark.createDataFrame([(*d, 1.0, True) for d in docs], "doc_id long, text string, lang string, perplexity double, keep boolean")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(60)] + [(100, 0, 0), (100, 1, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    judged = kn.judged(frame, labels)
    assert judged.count() == len(docs)
    dropped = {r.id for r in judged.where("NOT keep").collect()}
    assert dropped == {100, 101, 102, 105, 106}
    kept = kn.keep_good(frame, labels)
    assert kept.columns == frame.columns and kept.count() == len(docs) - 5
    assert kn.judged(frame.limit(0), labels).count() == 0
    assert kn.keep_good(frame, labels.limit(0)).count() == len(docs) - 4


@pytest.mark.parametrize("trusted", [1, 2, 3, 5])
def test_few_trusted_documents_still_give_a_threshold(spark, trusted):
    for shift in (0, 50, 99):
        docs = [(shift + k, f"the cat sat on the mat and the dog number {k}", "en") for k in range(trusted)]
        docs += [(900, "QZ!!## XX ||| %%% ~~~~ {{}} $$$ ^^^", "en")]
        frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
        labels = spark.createDataFrame([(d[0], 1, 0) for d in docs[:-1]], "doc_id long, quality int, toxic int")
        judged = kn.judged(frame, labels).collect()
        assert all(r.threshold is not None for r in judged) and [r.keep for r in judged if r.id == 900] == [False]


def test_labels_are_told_apart(spark):
    sf = f"{compare.TESTDATA}/sf0.01"
    judged = queries.op1_quality_classifier(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id")
    good, bad = [judged.where(f"quality = {q} AND toxic = 0").agg(F.avg(F.col("keep").cast("int"))).first()[0] for q in (1, 0)]
    assert good > 0.97 and bad < 0.4


def test_distinct_numbers_every_key():
    keys = np.array([5, 5 + (1 << 19), 5, 7, 5 + (1 << 20), 7, 5 + (1 << 19)], dtype=np.uint64)
    first, inverse = kn.distinct(keys)
    assert (keys[first][inverse] == keys).all() and len(set(keys[first].tolist())) == len(first) == 4


def test_windows_of_padded_texts():
    chars = kn.Characters(pa.array(["ab", None, "c9"]), 3)
    windows, inverse = chars.distinct()
    assert [str(kn.as_strings(windows)[k]) for k in inverse] == [
        "\x02\x02a", "\x02ab", "ab\x03", "\x02\x02\x03", "\x02\x02c", "\x02c0", "c0\x03"]


def test_four_characters_of_context_count(spark):
    trained = spark.createDataFrame([("x", t) for t in ("pabcq", "rabcs")], "lang string, text string")
    model = kn.kneser_ney(kn.count_ngrams(trained))
    docs = spark.createDataFrame([(1, "x", "pabcq"), (2, "x", "pabcs")], "id long, lang string, text string")
    got = {r.id: r.perplexity for r in kn.perplexities(docs, model).collect()}
    assert got[1] < got[2] * 0.99


@pytest.mark.parametrize("letters", [3, 50_000])
def test_needed_grams_of_small_and_large_alphabets(letters):
    rng = np.random.default_rng(5)
    windows = rng.integers(0x20000, 0x20000 + letters, size=(4000, 5)).astype(np.uint32)
    windows = np.concatenate([windows, windows[:50]])
    wanted = {""}
    for row in windows:
        text = "".join(map(chr, row))
        wanted |= {text[k:] for k in range(5)} | {text[k:4] for k in range(4)}
    got = kn.needed_grams(windows).to_pylist()
    assert len(got) == len(wanted) and set(got) == wanted
    assert got == sorted(got, key=lambda g: (len(g), g))


def test_bundles_hold_all_rows_found():
    rows = [(7, "x", "", -1.5, 0.25), (9, "x", "a퟿", None, -0.5), (7, "y", "ab", -2.0, None), (7, "x", "\n,", -3.25, None),
            (9, "\x00", "", 0.0, 0.0), (7, "x", "äöü", -0.125, 1.0)]
    columns = ["of_block", "lang", "gram", "logp", "back"]
    batch = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), (
        pa.int64(), pa.string(), pa.string(), pa.float32(), pa.float32()))], names=columns)
    out = pa.Table.from_batches(list(kn._bundler()([batch.slice(0, 2), batch.slice(0, 0), batch.slice(2)])))
    got = []
    for k in range(out.num_rows):
        one = out.slice(k, 1)
        found = zip(*kn.unbundled(one))
        got += [(one["of_block"][0].as_py(), one["lang"][0].as_py(), g, *(None if math.isnan(v) else float(v) for v in values))
                for g, *values in found]
    assert sorted(got, key=str) == sorted(rows, key=str) and out.num_rows == 4


def test_mirrored_windows_are_told_apart():
    text = "abbac baabc abcba bacab"
    chars = kn.Characters(pa.array([text]), 5)
    windows, inverse = chars.distinct()
    padded = "\x02" * 4 + text + "\x03"
    assert [str(w) for w in kn.as_strings(windows)[inverse]] == [padded[k:k + 5] for k in range(len(text) + 1)]


def test_scoring_takes_little_memory():
    rng = np.random.default_rng(3)
    texts = pa.table({"text": ["".join(map(chr, rng.integers(97, 105, 4000))) for _ in range(500)]})
    grams = [""] + [chr(k) for k in range(97, 105)]
    shard = kn.Shard(grams, np.full(len(grams), -2.0), np.zeros(len(grams)), 5)
    kn._scores(texts, shard, 5)
    tracemalloc.start()
    values = kn._scores(texts, shard, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(values) == 500 and peak < 50 << 20


def test_listed_grams_go_in_small_batches():
    rng = np.random.default_rng(4)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x4E00 + 200, 100_000))) for _ in range(2)]
    batch = pa.RecordBatch.from_pydict({"lang": ["x", "y"], "text": texts})
    out = list(kn._lister(5, kn.BLOCK_BYTES)(iter([batch])))
    assert max(b.nbytes for b in out) < 4 << 20 and max(b.num_rows for b in out) <= kn.LISTED_ROWS
    rows = pa.Table.from_batches(out)
    got = {(lang, gram) for lang, gram in zip(rows["lang"].to_pylist(), rows["gram"].to_pylist())}
    wanted = {(lang, g) for lang, t in zip("xy", texts) for g in kn.needed_grams(kn.Characters(pa.array([t]), 5).distinct()[0]).to_pylist()}
    assert got == wanted | {kn.MARK[:2]} and len(got) == rows.num_rows
    assert set(rows["of_block"].to_pylist()) == {kn.block_id(batch)}
