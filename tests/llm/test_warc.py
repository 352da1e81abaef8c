"""Archives written and read back, and transactions put together."""

import gzip
import hashlib
import io

import pytest

import compare
from shopmonth.llm import queries, warc


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, sf):
    path = f"{compare.TESTDATA}/{sf}"
    df = queries.op8_warc(spark, path)
    assert compare.rows_of_spark(df) == compare.rows_of_sql(compare.duck(path), queries.ORACLES["op8_warc"])


def test_edges(spark, folder):
    same, long_ = "é" * 600, "x" * 300_000
    rows = [(1, "http://a/b?c", same), (2, None, same), (9, "http://a\r\nX: y/", same), (9, "other", same), (None, "n", same),
            (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (7, "u", long_), (8, "u", "a\r\n\r\nWARC/1.1\r\n" * 90)]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, record_type string").repartition(4)
    manifest = warc.write_archives(pages, f"file://{folder}/w")
    captures = warc.assemble(warc.read_records(manifest, f"file://{folder}/w"))
    assert captures.count() == len(rows)
    assert captures.where("response IS NULL OR size(requests) <> 1 OR size(metadata) <> 1").count() == 0
    got = sorted([tuple(r) for r in warc.page_captures(captures).collect()], key=str)
    size = lambda t: len((t or "").encode())
    revisit = {1, 2, None}
    expected = sorted([(p, size(t), hashlib.sha1((t or "").encode()).hexdigest(), "revisit" if p in revisit else "response",
                        9 if p in revisit else None) for p, _, t in rows], key=str)
    assert got == expected
    stored = {r.id: bytes(r.payload).decode() for r in captures.where("response.record_type = 'response'").selectExpr(
        "regexp_extract(decode(metadata[0].payload, 'UTF-8'), '[0-9]+', 0) id", "response.payload payload").collect()}
    assert stored["7"] == long_ and stored["8"].startswith("a\r\n\r\nWARC/1.1")
    empty = warc.write_archives(pages.limit(0), f"file://{folder}/e")
    assert warc.page_captures(warc.assemble(warc.read_records(empty, f"file://{folder}/e"))).count() == 0


def test_parser_takes_plain_gzip_and_cut_files():
    records = warc.page_records(1, 2, "http://h/p", b"body" * 1000, None)
    plain = b"".join(records)
    packed = b"".join(map(gzip.compress, records))
    for data in (plain, packed, gzip.compress(plain)):
        for chunk in (7, 1 << 16):
            kinds = [h["warc-type"][0] for h, _ in warc.parse(io.BytesIO(data), chunk)]
            assert kinds == ["request", "response", "metadata"]
    assert len(list(warc.parse(io.BytesIO(plain[:-40])))) == 2
    assert warc.hex_digest("sha1:" + "A" * 32) == "00" * 20 and warc.hex_digest(None) is None


def test_both_directions_and_orphans(spark):
    row = lambda i, kind, to: (i, kind, "u", to, None, None, b"", 0, "d", b"")
    records = spark.createDataFrame([row("r1", "response", ["q1", "m1"]), row("q1", "request", ["r1"]), row("m1", "metadata", []),
                                     row("q2", "request", ["gone"]), row("r3", "revisit", [])], warc.RECORD)
    got = {r.capture_id: (r.response is not None, len(r.requests or []), len(r.metadata or [])) for r in warc.assemble(records).collect()}
    assert got == {"r1": (True, 1, 1), "gone": (False, 1, 0), "r3": (True, 0, 0)}


def test_repeated_rows_do_not_multiply_revisits(spark, folder):
    rows = [(9, "u", "x" * 2000)] * 2 + [(1, "v", "x" * 2000), (2, "w", "x" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_archives(pages, f"file://{folder}/r")
    got = warc.page_captures(warc.assemble(warc.read_records(manifest, f"file://{folder}/r")))
    assert sorted((r.page_id, r.refers_to) for r in got.where("record_type = 'revisit'").collect()) == [(1, 9), (2, 9)]


def test_query_parses_archives_once(spark, folder):
    plan = queries.op8_warc(spark, f"{compare.TESTDATA}/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan
    rows = [(1, "u", "x" * 2000), (2, "v", "x" * 2000), (3, "w", "short"), (4, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_archives(pages, f"file://{folder}/h")
    whole, heads = warc.read_records(manifest, f"file://{folder}/h"), warc.read_heads(manifest, f"file://{folder}/h")
    assert heads.schema == whole.schema and heads.where("record_type = 'response' AND payload IS NOT NULL").count() == 0
    bare = lambda df: sorted(map(str, df.selectExpr("* EXCEPT (payload)", "IF(record_type = 'response', NULL, payload) payload").collect()))
    assert bare(heads) == bare(whole) and heads.where("record_type <> 'warcinfo'").count() == 12
