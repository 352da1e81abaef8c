"""License scans against a plain window search."""

import random
import re

import pyarrow as pa
import pytest

import compare
from shopmonth.llm import licenses, queries
from shopmonth.llm.licenses import TEMPLATES, Templates


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingles(text):
    w = words(text)
    return [tuple(w[k:k + 5]) for k in range(len(w) - 4)]


def brute(text, templates, containment=0.8):
    """Largest containment of each template in any window of the operator's sizes."""
    mine, out = shingles(text), {}
    for name, body in templates.items():
        theirs = set(shingles(body))
        level = 1 << (len(theirs) - 1).bit_length()
        near = [k for k, s in enumerate(mine) if s in theirs]
        best = max((len({mine[k] for k in near if a <= k < a + level}) for a in near), default=0)
        if best / len(theirs) >= containment:
            out[name] = best / len(theirs)
    return out


def test_query_equals_brute_force_on_whole_table(spark):
    sf = f"{compare.TESTDATA}/sf0.01"
    texts = {r.doc_id: r.text for r in queries.table(spark, sf, "documents").collect()}
    rows = queries.op2_license_scan(spark, sf).collect()
    assert len(rows) == len(texts) and sum(r.n_licenses > 0 for r in rows) > 20
    for row in rows:
        assert sorted(row.licenses) == sorted(brute(texts[row.doc_id], TEMPLATES))


@pytest.mark.parametrize("place", [0, 1, 3, 17, 250])
def test_every_template_is_found_anywhere(place):
    rng = random.Random(place)
    known = Templates(TEMPLATES)
    texts = [" ".join(f"w{rng.randrange(999)}" for _ in range(place)) + " " + body.upper() + " tail é " * 9 for body in TEMPLATES.values()]
    found = known.matches(pa.array([*texts, None, "", "a b", *TEMPLATES.values()]))
    for name, here, alone in zip(TEMPLATES, found, found[len(texts) + 3:]):
        match = next(m for m in here if m["license"] == name)
        assert match["containment"] == 1.0 and name in {m["license"] for m in alone}
    for text, match in zip(texts, found):
        cut = text.encode()[match[0]["first_byte"]:match[0]["end_byte"]].decode()
        assert place == 0 or "w" not in cut.split()[0]
    assert found[len(texts):len(texts) + 3] == [[], [], []]


def test_changed_templates():
    rng = random.Random(4)
    known, hit, expected = Templates(TEMPLATES), 0, 0
    for _ in range(60):
        name = rng.choice(sorted(TEMPLATES))
        body = words(TEMPLATES[name])
        for _ in range(rng.randrange(3)):
            body[rng.randrange(len(body))] = "changed"
        text = " ".join(["before"] * rng.randrange(70) + body + ["after"] * 70)
        wanted = set(brute(text, TEMPLATES))
        got = {m["license"] for m in known.matches(pa.array([text]))[0]}
        assert got >= wanted
        expected, hit = expected + len(wanted), hit + len(got & wanted)
    assert expected > 20 and hit == expected


def test_frame_and_bounds(spark):
    docs = spark.createDataFrame([(1, TEMPLATES["ISC"], "x"), (1, None, "y")], "doc_id long, text string, licenses string")
    assert sorted(len(r.licenses) for r in licenses.scan(docs).collect()) == [0, 1]
    assert licenses.scan(docs.limit(0)).count() == 0
    assert licenses.scan(docs, {}).count() == 2
    with pytest.raises(ValueError):
        Templates({"short": "four words are few"})
    assert licenses.bands_needed(0.364) == 21
