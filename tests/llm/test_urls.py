"""URL verdicts against a plain reading of the rules and plain counts of combinations."""

from __future__ import annotations

import random
import re
import time
from itertools import combinations, product

import pytest

from pathgauge.llm import urls

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "HTTP://WWW.Example.COM/en/1?x#y",
    "http://www.example.com/en",
    "http://a.www.example.com/en/",
    "http://example.com/en/?q",
    "http://badexample.com/en/",
    "http://a.net/es/1",
    "http://net/fr/",
    "http://a.net?/es/",
    "http://a.net#/es/",
    "http://a.org/x://b.net/es/",
    "x\n://É.com/\n",
    "http://com",
    "http://com/",
    "a://" + "x/" * 5000,
]


def plain(url, rules=urls.RULES):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


def test_rules(spark):
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)] + [(None, "http://a.net/es/"), (1, "")], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = urls.judge_urls(pages.selectExpr("*", "'h' as host", "1 as tokens"), labels).collect()
    assert len(found) == len(URLS) + 2
    for r in found:
        if r.page_id is not None:
            host, path, rule, verdict = plain(URLS[r.page_id])
            assert (r.host, r.path, r.rule, r.verdict, r.pattern) == (host, path, rule, verdict or "allow", None)
    assert urls.judge_urls(pages.where("false"), labels).collect() == []


def rows():
    source = random.Random(6)
    for k in range(900):
        host = source.choice(["bets", "news", "blog"])
        lang = source.choice(["en", "de"])
        bad = source.random() < (0.95 if host == "bets" and lang == "de" else 0.05)
        yield k, f"https://{host}.site{source.randrange(4)}.org/{lang}/{k}.html?ref={k}", bad


def tokens(url):
    host, path, _, _ = plain(url)
    parts = [re.sub(r"^[0-9]+$", "#", re.sub(r"\.[A-Za-z0-9]+$", "", x)) for x in path.split("/")]
    return {"host:" + x for x in host.split(".")} | {"path:" + x for x in parts if x} | {"query:ref"}


def brute_rules(labelled):
    count, blocked = {}, {}
    for ts, bad in labelled:
        for n in range(1, len(ts) + 1):
            for c in combinations(sorted(ts), n):
                count[c] = count.get(c, 0) + 1
                blocked[c] = blocked.get(c, 0) + bad
    total, share = len(labelled), sum(b for _, b in labelled) / len(labelled)
    least = max(urls.SUPPORT * total, urls.LEAST_URLS)
    rules = {c for c, b in blocked.items() if b >= least and b / count[c] >= urls.CONFIDENCE and b / count[c] / share >= urls.LIFT}
    return {c for c in rules if not any(set(o) < set(c) for o in rules)}


def test_mined_combinations(spark):
    data = list(rows())
    pages = spark.createDataFrame([(k, u) for k, u, _ in data] + [(5000, "http://x.bets.org/de/"), (5001, data[0][1])], "page_id long, url string")
    labels = spark.createDataFrame([(k, int(not bad), 0) for k, _, bad in data if k % 2], "doc_id long, quality int, toxic int")
    expected = brute_rules([(tokens(u), bad) for k, u, bad in data if k % 2])
    assert ("host:bets", "path:de") in expected
    found = {r.page_id: r for r in urls.judge_urls(pages, labels).collect()}
    assert len(found) == len(data) + 2
    for k, u, _ in [*data, (5000, "http://x.bets.org/de/", None)]:
        ts = {t for t in tokens(u) if k != 5000 or t != "query:ref"}
        hit = min((" ".join(c) for c in expected if set(c) <= ts), default=None)
        assert (found[k].pattern, found[k].verdict) == (hit, "block" if hit else "allow")
    assert found[5001].verdict == found[0].verdict


def test_many_shared_tokens(spark):
    """Thirty tokens on the same urls make as many rules, not as many combinations as there are sets of them."""
    many = "/".join(f"s{k}" for k in range(30))
    data = []
    for k in range(1000):
        kind = k % 4
        if kind == 0:  # thirty tokens that block by themselves
            url, bad = f"http://a.org/{many}/{k}", True
        elif kind == 1:  # thirty others that block only with x
            url, bad = f"http://b.org/{many.replace('s', 't')}/{'x' if k % 8 == 1 else 'y'}/{k}", k % 8 == 1
        else:
            url, bad = f"http://c.org/{'x' if k % 8 == 2 else 'z'}/{k}", False
        data.append((k, url, bad))
    pages = spark.createDataFrame([(k, u) for k, u, _ in data] + [(5000, "http://q.org/x/t7"), (5001, "http://q.org/t7/y"), (5002, "http://q.org/s9")], "page_id long, url string")
    labels = spark.createDataFrame([(k, int(not bad), 0) for k, _, bad in data], "doc_id long, quality int, toxic int")
    start = time.monotonic()
    found = {r.page_id: (r.verdict, r.pattern) for r in urls.judge_urls(pages, labels).collect()}
    assert time.monotonic() - start < 60
    for k, u, bad in data:
        assert found[k] == ("block" if bad else "allow", ("host:a" if k % 4 == 0 else "host:b path:x") if bad else None)
    assert found[5000] == ("block", "path:t7 path:x")
    assert found[5001] == ("allow", None) and found[5002] == ("block", "path:s9")


def all_rules(labelled, least, share=0.0):
    """Every minimal rule with its tokens, by trying all combinations."""
    total, bad = len(labelled), sum(b for _, b in labelled)
    needed = max(share * total, least)
    rules = []
    tokens_of = sorted(set().union(*[t for t, _ in labelled]))
    for n in range(1, len(tokens_of) + 1):
        for c in combinations(tokens_of, n):
            if any(set(r) <= set(c) for r in rules):
                continue
            hits = [b for t, b in labelled if set(c) <= t]
            if sum(hits) >= needed and sum(hits) / len(hits) >= urls.CONFIDENCE and sum(hits) / len(hits) * total >= urls.LIFT * bad:
                rules.append(c)
    return set(rules)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rules_equal_all_combinations(spark, seed):
    source = random.Random(seed)
    labelled = []
    for _ in range(120):
        tokens = {t for t in "abcdef" if source.random() < 0.5} | {"u"}
        if "a" in tokens:
            tokens.add("twin")  # always with a
        else:
            tokens.discard("twin")
        labelled.append((tokens, source.random() < (0.9 if {"a", "b"} <= tokens or {"c", "d", "e"} <= tokens else 0.2)))
    frame = spark.createDataFrame([(sorted(t), b) for t, b in labelled], "tokens array<string>, block boolean")
    rules, items = urls.mine_rules(frame, least=8)
    members = {}
    for r in items.collect():
        members.setdefault(r.item, []).append(r.token)
    found = {tuple(sorted(c)) for r in rules.collect() for c in product(*[members[i] for i in r.pattern])}
    assert found == all_rules(labelled, 8)


def test_nothing_proves_nothing(spark):
    frame = spark.createDataFrame([(["a"], True)] * 19, "tokens array<string>, block boolean")
    assert urls.mine_rules(frame)[0].count() == 0
    assert urls.mine_rules(frame.where("false"))[0].count() == 0
    mixed = frame.unionByName(spark.createDataFrame([(["b"], False)] * 30, frame.schema))
    assert urls.mine_rules(mixed)[0].count() == 0
    assert [r.pattern for r in urls.mine_rules(mixed, least=19)[0].collect()] == [["a"]]
