"""Token files against the library, and Elias-Fano against plain arrays."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import compare
from shopmonth.llm import queries, tokenfile
from shopmonth.llm.byte_bpe import ByteBpe
from shopmonth.llm.tokenfile import EliasFano

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    return library


def lists(texts, end=None):
    ids, counts = ByteBpe.load(PATH).encode(pa.array(texts, pa.string()), end)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


ALPHABET = list("aZé9½²  \t\n'sdtm!. \u0085\x1c\x00–€ñ") + ["'re", "'ll", " '", "漢", "🙂", " ", "ſ", "Ⅷ"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=14).map("".join), min_size=1, max_size=6))
def test_ids_are_the_library_s(library, texts):
    assert lists(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_strings_are_text_and_nulls_are_empty(library):
    assert lists(["<|endoftext|> x", None, ""], 0) == [library.encode("<|endoftext|> x", add_special_tokens=False).ids + [0], [0], [0]]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=1500), st.integers(0, 10**9))
def test_elias_fano(values, extra):
    values = np.sort(np.array(values))
    coded = EliasFano.of(values, int(values[-1]) + 1 + extra)
    coded = EliasFano.unpack(*coded.pack())
    assert (coded.values() == values).all()
    for index in random.Random(1).sample(range(len(values)), min(5, len(values))):
        assert coded.select(index) == values[index]
        assert (coded.values(index, index + 300) == values[index:index + 300]).all()


def test_space_is_near_minimal():
    values = np.sort(np.random.default_rng(1).integers(0, 10**8, 100_000))
    packed, _ = EliasFano.of(values, 10**8).pack()
    assert len(packed) * 8 / len(values) < np.log2(1000) + 2.3


def test_files(spark, folder, library):
    rows = [(5, "five"), (None, "no id"), (1, None), (3, "three 33"), (3, "again"), (-7, ""), (2**40, "x " * 5000)]
    docs = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, start int").repartition(3)
    manifest = tokenfile.write_tokens(docs, f"file://{folder}/t", PATH, shard_bytes=3000)
    assert manifest.count() > 1
    got = [tuple(r) for r in tokenfile.read_index(manifest, f"file://{folder}/t").orderBy("start").collect()]
    assert [g[0] for g in got] == [None, -7, 1, 3, 3, 5, 2**40]
    stored = [tuple(r) for r in tokenfile.read_documents(tokenfile.read_manifest(spark, f"file://{folder}/t"), f"file://{folder}/t").collect()]
    expected = [(i, library.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows]
    assert sorted(map(str, stored)) == sorted(map(str, expected))
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((str(i), len(x), crc(x)) for i, x in expected) == sorted((str(i), n, c) for i, _, n, c in got)
    assert [g[1] for g in got] == np.cumsum([0] + [g[2] for g in got])[:-1].tolist()
    empty = tokenfile.write_tokens(docs.limit(0), f"file://{folder}/e", PATH)
    assert tokenfile.read_index(empty, f"file://{folder}/e").count() == 0


def test_query(spark, library):
    sf = f"{compare.TESTDATA}/sf0.001"
    docs = sorted((r.doc_id, r.text or "") for r in queries.table(spark, sf, "documents").collect())
    start, expected = 0, []
    for doc_id, text in docs:
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in queries.op6_token_files(spark, sf).collect()) == expected


def test_special_strings_are_their_ids_in_files(spark, folder):
    plain = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>漢", "<|endoftext| >", None, "a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    manifest = tokenfile.write_tokens(docs, f"file://{folder}/s", PATH)
    stored = {r.doc_id: r.token_ids for r in tokenfile.read_documents(manifest, f"file://{folder}/s").collect()}
    assert stored == {k: plain.encode(t or "", add_special_tokens=False).ids + [0] for k, t in enumerate(texts)}
    assert 50256 in stored[0] and 50256 not in stored[3]
