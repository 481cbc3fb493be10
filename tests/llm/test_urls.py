import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from thalweg.llm.queries import URL_RULES
from thalweg.llm.urlcascade import Rule, build_cascade, verdicts

RULES = [Rule(*r) for r in URL_RULES]


def judge(url, rules=RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.key), len(r.host)), default=None)
    return host, path, best.key if best else None, best.verdict if best else "allow"


URLS = [
    None, "", "example.com/en/7", "http://example.com/en/7", "http://EXAMPLE.com/en/", "https://a.b.example.com/en/71?x", "http://com/en/", "http://notcom/en/", "http://x.net/de/8", "http://example.net/de/8#a",
    "http://w.example.net/de/9", "http://x.org/es", "http://x.org/es/", "http://x.org?/es/", "http:///en/", "http://com", "a://b://c.com/en/", "http://.com/en/", "http://com./en/", "http://x.com/en/\n", "http://É.com/en/7", "http://" + "a." * 5000 + "com/en/" + "x" * 50000,
]


def test_verdicts_are_those_of_brute_force(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = {(r.page_id): (r.host, r.path, r.rule, r.verdict) for r in verdicts(pages, RULES).collect()}
    assert got == {i: judge(u) for i, u, _ in rows}


def test_the_longest_rule_wins_whatever_its_labels(spark):
    rules = [Rule("com", "/en/", "block"), Rule("example.com", "/", "allow"), Rule("a.b.c", "", "block"), Rule("c", "/abcdefgh", "allow")]
    urls = ["http://example.com/en/x", "http://a.b.c/abcdefgh", "http://a.b.c/abc", "http://x.c/abcdefghi", "http://x.com/en/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in verdicts(pages, rules).collect()}
    assert got == {i: judge(u, rules) for i, u in enumerate(urls)} and got[0][2] == "example.com/"


@pytest.mark.parametrize("seed", range(6))
def test_random_rules_are_those_of_brute_force(spark, seed):
    r = random.Random(seed)
    host = lambda n: ".".join(r.choice(["a", "bb", "ccc", "com"]) for _ in range(r.randint(1, n)))
    path = lambda n: r.choice(["", "/"]) + "".join(r.choice("ab/") for _ in range(r.randint(0, n)))
    found = {}
    for _ in range(r.randint(1, 40)):
        rule = Rule(host(3), path(4) if r.random() < 0.8 else "", r.choice(["allow", "block", "review"]))
        if rule.path[:1] in ("", "/"):
            found.setdefault(rule.key, rule)
    rules = list(found.values())
    urls = [f"http://{host(5)}{'/' + path(8) if r.random() < 0.9 else ''}" for _ in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    want = {i: judge(u, rules) for i, u in enumerate(urls)}
    # the second bound is so low that every cascade is split by hash of key
    for most in (1 << 20, 16) if seed < 2 else (1 << 20,):
        assert {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in verdicts(pages, rules, max_bytes=most).collect()} == want


def test_no_pages_and_no_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert verdicts(none, RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/en/"), (None, None)], "page_id long, url string")
    assert [r.verdict for r in verdicts(one, []).collect()] == ["allow", "allow"]


def test_a_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    listed = spark.range(0, 20_000, 40).select(F.xxhash64("id").alias("h"))
    cascade = build_cascade(listed, universe)
    assert len(cascade.levels) > 1
    keys = np.array([r.h for r in universe.collect()], np.int64)
    known = {r.h for r in listed.collect()}
    assert cascade.holds(keys).tolist() == [int(k) in known for k in keys]
    assert not build_cascade(listed.limit(0), universe).holds(keys).any()
