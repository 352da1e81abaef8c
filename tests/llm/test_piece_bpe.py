"""Piece encoding against the library, exact round trips, and dropout."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

import compare
from shopmonth.llm import piece_bpe, queries
from shopmonth.llm.piece_bpe import decode_ids, encode_texts, vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", "a", " ", "   ", "Hello world", "  two  spaces ", "tab\tline\nend", "ünïcödé ﬁ ½ 漢字 🙂", "x" * 500, "ab" * 300,
         "the the the the", "▁ marker ▁▁", "\x00nul", "a" + " " * 70 + "b", "don't stop-me_now 12345", "é" * 90]


def lists(texts, **options):
    ids, offsets = encode_texts(pa.array(texts, pa.string()), vocabulary(PATH), **options)
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]


def back(rows):
    ids = np.array([i for r in rows for i in r], dtype=np.int64)
    content, bounds = decode_ids(ids, np.cumsum([0] + [len(r) for r in rows]), vocabulary(PATH))
    return [content[a:b].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:])]


def documents(spark):
    sf = f"{compare.TESTDATA}/sf0.001"
    return [r.text or "" for r in queries.table(spark, sf, "documents").collect()]


def test_without_dropout_as_the_library(spark):
    texts = [t for t in TEXTS if "▁" not in t] + documents(spark)
    assert lists(texts) == SentencePieceProcessor(model_file=PATH).encode(texts)


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_round_trip(spark, rate):
    texts = TEXTS + documents(spark)[:60]
    rows = lists(texts, rate=rate, seed=3)
    assert back(rows) == texts
    if rate == 1.0:
        assert all(len(r) >= len(t) for r, t in zip(rows, texts))


def test_heap_and_rounds_agree(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("theanioérs▁😀") for _ in range(rng.randrange(1, 40))) for _ in range(8)) for _ in range(40)]
    keys = np.arange(40)
    rounds = lists(texts, rate=0.3, seed=1, keys=keys)
    monkeypatch.setattr(piece_bpe, "LONG", 0)
    assert lists(texts, rate=0.3, seed=1, keys=keys) == rounds


def test_seed_and_document_choose_the_pieces():
    text = "international understanding of segmentation"
    a, b = lists([text, text], rate=0.3, seed=1, keys=np.array([1, 2]))
    assert a != b and [a, b] == lists([text, text], rate=0.3, seed=1, keys=np.array([1, 2]))
    assert lists([text], rate=0.3, seed=2, keys=np.array([1])) != [a]
    assert len({tuple(lists([text], rate=0.3, seed=s)[0]) for s in range(30)}) > 20
    shares = [np.mean([len(lists([text], rate=r, seed=s)[0]) for s in range(20)]) for r in (0, 0.1, 0.5)]
    assert shares == sorted(shares)


def test_frames(spark):
    rows = [(1, None, "x"), (None, "same", None), (None, "same", "y"), (2, "", "z"), (3, "two words", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    out = piece_bpe.decode(piece_bpe.encode(docs, PATH), PATH, text_col="decoded").collect()
    assert len(out) == 5 and all(r.decoded == r.text for r in out)
    assert piece_bpe.encode(docs.limit(0), PATH).count() == 0
    assert all(r.lossless for r in piece_bpe.encode(docs, PATH, 0.3, lossless_col="lossless").collect())


def test_lost_bytes_are_seen():
    texts = pa.array(["abc def", "", "xyz"])
    ids, offsets = encode_texts(texts, vocabulary(PATH))
    assert piece_bpe.gives_back(texts, ids, offsets, vocabulary(PATH)).all()
    assert piece_bpe.gives_back(pa.array(["abc dXf", "", "xyz"]), ids, offsets, vocabulary(PATH)).tolist() == [False, True, True]
    assert piece_bpe.gives_back(pa.array(["abc de", "", "xyz"]), ids, offsets, vocabulary(PATH)).tolist() == [False, True, True]


def test_query_round_trip_on_whole_table(spark):
    sf = f"{compare.TESTDATA}/sf0.01"
    out = queries.op3_sentencepiece(spark, sf)
    assert out.count() == queries.table(spark, sf, "documents").count()
    assert out.where("NOT lossless").count() == 0
