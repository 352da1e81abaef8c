"""URL verdicts against plain rules and a plain PageRank."""

import random
import re
from collections import Counter, defaultdict

import pytest

import compare
from shopmonth.llm import oracles, queries, urls

UPPER = {c: c + 32 for c in range(65, 91)}


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    return host.translate(UPPER), re.split(r"[?#]", rest[len(host):])[0]


def rule(host, path, rules):
    fits = [(len(name), name, kind) for kind, name in rules
            if (host == (d := name.partition("/")[0]) or host.endswith("." + d)) and path.startswith("/" + name.partition("/")[2])]
    return max(fits)[1:] if fits else (None, None)


def out_links(links):
    out = defaultdict(dict)
    for (src, dst), n in links.items():
        out[src][dst] = n
    return out


def trusted(seeds, links, rounds, damping=0.85):
    ranks, out = dict(seeds), out_links(links)
    for _ in range(rounds):
        new = defaultdict(float, seeds)
        for src, rank in ranks.items():
            for dst, n in out[src].items():
                new[dst] += damping * rank * n / sum(out[src].values())
        ranks = dict(new)
    return ranks


def distrusted(seeds, links, rounds, damping=0.85):
    """Chance of a walk of at most ``rounds`` steps to reach a blocked page; each step is taken with ``damping``."""
    out = out_links(links)

    def chance(host, steps):
        bad = seeds.get(host, 0.0)
        if not steps or bad == 1 or host not in out:
            return bad
        total = sum(out[host].values())
        return bad + (1 - bad) * damping * sum(n / total * chance(dst, steps - 1) for dst, n in out[host].items())

    return {host: chance(host, rounds) for host in {*seeds, *out}}


def brute(pages, rules=urls.RULES, threshold=urls.THRESHOLD, rounds=urls.ROUNDS):
    hosts, links, rows = defaultdict(list), Counter(), []
    for page_id, url, html in pages:
        host, path = split(url)
        name, kind = rule(host, path, rules)
        rows.append((page_id, host, path, name, kind))
        if host:
            hosts[host].append(kind)
            for link in re.findall(r"""(?is)\b(?:href|src)\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s"'<>]+)""", html or ""):
                target = split("x:" + link[link.index("//"):])[0]
                if target and target != host:
                    links[host, target] += 1
    share = lambda kind: {h: k.count(kind) / len(k) for h, k in hosts.items() if kind in k}
    trust, distrust = trusted(share("allow"), links, rounds), distrusted(share("block"), links, rounds)
    bad = {h for h, d in distrust.items() if d >= threshold and d > trust.get(h, 0.0)}
    return sorted([(p, h, path, n, k or ("block" if h in bad else "allow")) for p, h, path, n, k in rows], key=str)


def result(df):
    return sorted([tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()], key=str)


def test_query_on_whole_table(spark):
    sf = f"{compare.TESTDATA}/sf0.01"
    pages = [(r.page_id, r.url, r.html) for r in queries.table(spark, sf, "pages").collect()]
    assert result(queries.op4_url_filter(spark, sf)) == brute(pages)


LINK = '<a href="{}">x</a>'
PAGES = [
    (1, "http://bad.net/x", None), (2, "http://friend.com/", LINK.format("http://bad.net/") * 3),
    (3, "http://weak.com/", LINK.format("//bad.net/a") + "".join(LINK.format(f"https://h{k}.com/") for k in range(9))),
    (4, "http://fan.com", LINK.format("http://FRIEND.com:80") + "<img src='http://friend.com/i.png'>"),
    (5, "HTTP://A.Example.NET/en/x?q#f", LINK.format("http://liked.com/")), (6, "http://example.net/de/", ""),
    (7, "http://b.example.com/de/1", ""), (8, "http://b.example.com/en/1", ""), (9, "http://x.org/fr/", ""), (10, "http://x.org/fr", ""),
    (11, None, "x"), (12, "no scheme", "x"), (13, "http://net/", ""), (14, "http://bad.net", ""), (15, "a://b://c/d", ""),
    (16, "http://notexample.com/de/", ""), (17, "x://h\n/p\nq?z", ""), (17, "http://bad.net/x", LINK.format("http://bad.net/self")),
    (None, "http://ÄB.net/?", ""), (18, "http://liked.com/", LINK.format("/relative") + LINK.format("http://bad.net/") + LINK.format("http://fan.com/")),
]


@pytest.mark.parametrize("rounds", [0, 1, 10])
def test_rules_links_and_edges(spark, rounds):
    df = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, verdict string").repartition(3)
    got = result(urls.judged(df, rounds=rounds))
    assert got == brute(PAGES, rounds=rounds)


def test_distrust_goes_against_links_and_trust_along(spark):
    pages = [(1, "http://bad.net/x", LINK.format("http://innocent.com/")), (2, "http://friend.com/", LINK.format("http://bad.net/")),
             (3, "http://fan.com/", LINK.format("http://friend.com/")), (4, "http://innocent.com/", ""), (5, "http://x.org/fr/", LINK.format("http://liked.com/")),
             (6, "http://liked.com/", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    verdict = {p: v for p, *_, v in result(urls.judged(df))}
    assert verdict == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"}


@pytest.mark.parametrize("linkers", [1, 2, 100])
def test_any_number_of_linkers_to_a_blocked_host(spark, linkers):
    bad, other = LINK.format("http://bad.net/"), LINK.format("http://other.com/")
    pages = [(0, "http://bad.net/x", ""), (1, "http://other.com/", bad + other + LINK.format("http://third.com/") * 3)]
    pages += [(10 + k, f"http://farm{k}.com/", bad) for k in range(linkers)]
    pages += [(1000 + k, f"http://mostly{k}.com/", bad * 2 + other) for k in range(linkers)]
    pages += [(2000 + k, f"http://seldom{k}.com/", bad + other * 3) for k in range(linkers)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = result(urls.judged(df))
    assert got == brute(pages)
    assert all(v == ("block" if p == 0 or 10 <= p < 2000 else "allow") for p, *_, v in got)


def test_sql_on_linked_pages(spark):
    """The SQL twin on pages with links, which the given tables lack."""
    import duckdb
    import pandas as pd

    rng = random.Random(3)
    names = [f"h{k}.com" for k in range(30)] + ["a.net", "b.net", "c.org", "d.example.net"]
    pages = [(k, f"http://{rng.choice(names)}{rng.choice(['/fr/', '/en/', '/x'])}",
              "".join(LINK.format(f"http://{rng.choice(names[-6:] if rng.random() < .5 else names)}/") for _ in range(rng.randrange(4))))
             for k in range(150)]
    db = duckdb.connect()
    db.register("pages", pd.DataFrame(pages, columns=["page_id", "url", "html"]))
    sql = db.execute(f"SELECT page_id, host, path, rule, verdict FROM ({oracles.ORACLES['op4_url_filter']})").fetchall()
    got = result(urls.judged(spark.createDataFrame(pages, "page_id long, url string, html string")))
    assert got == sorted(sql, key=str)
    assert {(r, v) for *_, r, v in got} >= {(None, "block"), (None, "allow")}


def test_no_python_in_the_plan(spark):
    plan = urls.judged(spark.createDataFrame(PAGES, "page_id long, url string, html string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty(spark):
    assert urls.judged(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("blanks", [0, 12, 1000, 200_000])
def test_any_number_of_blanks_before_a_link(spark, blanks):
    gap = " \n" * (blanks // 2)
    html = f'<a href{gap}={gap}"{gap}//b.com/x">{gap}<img src={gap}'
    pages = spark.createDataFrame([("a.com", html)], "host string, html string")
    assert [tuple(r) for r in urls.host_links(pages).collect()] == [("a.com", "b.com", 1)]
