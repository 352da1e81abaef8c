"""What a Python worker takes: free memory of one operator is not there for the next one."""

import random
import subprocess
import sys
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from shopmonth.llm import jaccard, kneser_ney, piece_bpe, words


def texts(megabytes):
    rng = random.Random(5)
    pool = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    return [" ".join(rng.choices(pool, k=330)) for _ in range(megabytes * 520)]


def most_in_arrays(run, batch):
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in run(iter([batch])))
        return rows, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_shingles_take_little(spark, monkeypatch):
    df = spark.createDataFrame([], "id long, row long, text string, hash long")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: run)
    monkeypatch.setattr(words, "_slice_powers", words._powers(1))
    docs = texts(3)
    ids = pa.array(range(len(docs)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(docs), ids], names=["id", "row", "text", "hash"])
    rows, most = most_in_arrays(jaccard._profiles(df, 5), batch)
    assert rows == len(docs) and most < 40


def test_sets_do_not_depend_on_slices(spark, monkeypatch):
    df = spark.createDataFrame([], "id long, row long, text string, hash long")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: run)
    docs = texts(2) + ["", "one", "x " * 200_000]
    ids = pa.array(range(len(docs)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(docs), ids], names=["id", "row", "text", "hash"])
    profiles = lambda: pa.Table.from_batches(list(jaccard._profiles(df, 5)(iter([batch])))).to_pylist()
    got = profiles()
    monkeypatch.setattr(jaccard, "SET_BYTES", 1 << 22)
    assert got == profiles()


def test_merges_take_little(spark, monkeypatch):
    df = spark.createDataFrame([], "doc_id long, text string")
    path = public_tokenizers.path("piece_bpe_32k.model")
    piece_bpe.vocabulary(path)
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: run)
    docs = texts(1)
    ids = pa.array(range(len(docs)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, pa.array(docs), ids], names=["doc_id", "text", "__key"])
    rows, most = most_in_arrays(piece_bpe.encode(df, path, 0.1, 1, lossless_col="lossless"), batch)
    assert rows == len(docs) and most < 60


def test_listing_takes_little_and_all_grams(monkeypatch):
    letters = np.random.default_rng(3).choice(np.frombuffer(b"abcdefghij ", np.uint8), (8000, 2000))
    docs = [row.tobytes().decode() for row in letters]
    batch = pa.RecordBatch.from_arrays([pa.array(docs), pa.array(["en"] * 7999 + [None])], names=["text", "lang"])
    run = kneser_ney._lister(5, 32 << 20)
    assert most_in_arrays(run, batch)[1] < 100
    grams = lambda: pa.Table.from_batches(list(run(iter([batch])))).to_pylist()
    got = grams()
    monkeypatch.setattr(kneser_ney, "FOLD_ROWS", 1 << 40)
    assert got == grams()


def test_windows_gathered_are_the_different_ones(monkeypatch):
    monkeypatch.setattr(kneser_ney, "FOLD_ROWS", 50)
    rng, gathered, parts = np.random.default_rng(4), kneser_ney.Windows(), []
    for size in (0, 3, 40, 60, 500, 1, 2000):
        parts.append(rng.choice([2, 3, 97, 0x10FFFF, 0xFFFD], (size, 5)).astype(np.uint32))
        gathered.add(parts[-1])
    assert gathered.rows < 2606
    got = gathered.take()
    assert got.dtype == np.uint32 and {*map(tuple, got.tolist())} == {*map(tuple, np.concatenate(parts).tolist())}


def test_workers_of_the_join_load_no_pandas():
    script = "import sys, shopmonth.llm.jaccard; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", script], cwd=words.__file__.rsplit("/shopmonth/", 1)[0]).returncode == 0


@pytest.mark.parametrize("length", [0, 1, 2, 3, 1000, 4096, (2 << 20) + 5])
def test_powers_are_long_enough(length):
    up, down = words.powers(length)
    assert len(up) > length and up[0] == 1 and (up * down == 1).all()


def test_free_memory_goes_back():
    script = """
import re, numpy as np
from shopmonth.llm import words
def held(): return int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) >> 10
np.zeros(30 << 20, np.uint8).fill(1)  # from now on the C library keeps arrays of this size
start, rows = held(), []
for _ in range(40):
    a = np.ones(4 << 20, np.uint8)
    rows.append(np.ones(1000, np.uint8))
    del a
arrays = [np.ones(1 << 20, np.uint8) for _ in range(60)]
kept = [arrays[-1]]
del arrays
words.give_back()
print(held() - start)
"""
    out = subprocess.run([sys.executable, "-c", script], cwd=words.__file__.rsplit("/shopmonth/", 1)[0], capture_output=True, text=True)
    assert int(out.stdout) < 30, out
