"""Url verdicts against every rule and every term tried one by one."""

import random

from quotewire.llm import url_filter as u

KIND = "page_id long, url string, html string, rule int, verdict string, host long"


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut], rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    host, text = low(host), low(url or "")
    fits = [
        (len(r), r, v) for r, v in u.RULES
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])
    ]
    inside = lambda c: c >= "\x80" or c.isalnum()

    def holds(term):
        at = text.find(term)
        while at >= 0:
            end = at + len(term)
            if not (at and inside(text[at - 1])) and not (end < len(text) and inside(text[end])):
                return True
            at = text.find(term, at + 1)
        return False

    strict, soft = sorted(filter(holds, u.STRICT)), sorted(filter(holds, u.SOFT))
    rule, says = max(fits)[1:] if fits else (None, None)
    return host, path, rule, says or ("block" if strict or len(soft) >= u.SOFT_LIMIT else "allow"), strict, soft


def urls():
    rng = random.Random(3)
    hosts = ["example.org", "WWW.Example.ORG", "org", "notexample.org", "a.com", "com", "x.net", "free-bets.net",
             "xcasino.net", "casino.net", "éporn.net", "porn.é.net", "myorg", "example.org:80", "u@example.org", ""]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12?x#y", "/en/2", "/fr/a", "/de/", "/win/free", "/win/win", "/winner",
             "?free=win", "#/es/", "/ES/", "/a://b.org/", "/adult-chat", "/web\ncam/xxx"]
    out = [f"{s}{h}{p}" for s in ("http://", "", "://", "weird:///") for h in hosts for p in paths]
    rng.shuffle(out)
    return [*out, None, "", "   ", "no scheme casino", "http://" + "a." * 50_000 + "org/x", out[0], out[0]]


def test_same_as_one_by_one(spark):
    rows = [(i, url, "h", 1, "v", 2) for i, url in enumerate(urls())]
    rows.append((None, None, None, None, None, None))
    got = u.judge(spark.createDataFrame(rows, KIND).repartition(5))
    assert sorted(got.columns) == sorted(["page_id", "url", "html", "rule", "verdict", "host", "path", "strict_hits", "soft_hits"])
    got = got.select("page_id", "url", "html", "host", "path", "rule", "verdict", "strict_hits", "soft_hits").collect()
    want = [(p, url, html, *brute(url)) for p, url, html, *_ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r["verdict"] for r in got} == {"allow", "block"} and {r["rule"] for r in got} >= {r for r, _ in u.RULES}


def test_parameters_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://a.b/free/win/spam")], "page_id long, url string")
    assert u.judge(df.limit(0)).collect() == []
    assert u.judge(df, strict=[], soft_limit=3).first()["verdict"] == "allow"
    assert u.judge(df, rules=[], strict=[], soft=[]).first()["verdict"] == "allow"
    # Of rules of one text the first counts; the longest of all wins.
    rules = [("b/", "block"), ("b/", "allow"), ("a.b/free", "allow")]
    assert u.judge(df, rules[:2]).first()["verdict"] == "block"
    assert u.judge(df, rules).select("rule", "verdict").first() == ("a.b/free", "allow")


def test_only_the_url_is_read(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    plan = u.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan and "Exchange" not in plan
