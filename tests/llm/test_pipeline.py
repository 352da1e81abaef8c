"""Every stage of the pipeline on what its predecessor kept, against brute force."""

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

import compare
import corpus_pipeline as pipeline
from shopmonth.llm import kneser_ney
from shopmonth.llm.pii import Pseudonyms
from test_decontaminate import brute as contamination
from test_jaccard import brute as components

SF = f"{compare.TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs.collect())
    for _, function in pipeline.STAGES:
        docs = pipeline.stage(function(spark, docs, SF), "test")
        out.append(docs.collect())
    return out


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_columns(staged):
    columns = staged[0][0].__fields__
    assert all(s[0].__fields__ == columns for s in staged[1:5])
    assert staged[5][0].__fields__[:len(columns)] == columns


def test_quality_keeps_what_is_judged_good(spark, staged):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    judged = kneser_ney.judged(docs, labels)
    assert set(texts(staged[1])) == {r.id for r in judged.where("keep").collect()}
    assert 0.5 < len(staged[1]) / len(staged[0]) < 1


def test_one_of_each_group(staged):
    rows = components(sorted(texts(staged[1]).items()), 5, 4, 5)
    assert set(texts(staged[2])) == {c for d, n, c in rows if n} | {d for d, n, _ in rows if not n}
    assert len(staged[2]) < len(staged[1])


def test_contaminated_go(spark, staged):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judged = contamination(sorted(texts(staged[2]).items()), items)
    assert set(texts(staged[3])) == {r[0] for r in judged if not r[5]}


def test_private_values_are_replaced(staged):
    names, back = Pseudonyms(pipeline.PSEUDONYM_KEY), Pseudonyms(pipeline.PSEUDONYM_KEY, inverse=True)
    before, after = texts(staged[3]), texts(staged[4])
    assert set(before) == set(after)
    assert all(names.replace(before[k])[0] == after[k] and back.replace(after[k])[0] == before[k] for k in before)
    assert all(r.n_chars == len(r.text) for r in staged[4])


def test_ids_decode(staged):
    library = SentencePieceProcessor(model_file=public_tokenizers.path(pipeline.PIECES))
    for row in staged[5]:
        assert row.lossless and row.n_tokens == len(row.token_ids)
        if "▁" not in row.text:
            assert library.decode(row.token_ids) == row.text
    assert texts(staged[5]) == texts(staged[4])


def test_repeated_rows_and_nulls(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text, "a"), (1, text, "a"), (1, text.upper(), "b"), (None, text, "c"), (None, "alone by itself here today", "d"),
            (None, "alone by itself here today", "d"), (2, None, "e"), (3, "", "f"), (4, text + " more", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = pipeline.near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    got = sorted([(r.doc_id, (r.text or "").lower()) for r in kept.collect()], key=str)
    assert got == sorted([(1, text), (None, "alone by itself here today"), (2, ""), (3, "")], key=str)


def test_run_on_empty_documents(spark, folder):
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{SF}/{name}.parquet")
        (table.limit(0) if name == "documents" else table).write.parquet(f"{folder}/{name}.parquet")
    assert pipeline.run(spark, folder).count() == 0
