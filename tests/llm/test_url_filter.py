"""Url verdicts against brute force; the cascade is exact over its universe."""

import random
import re

import numpy as np
import pytest

from wearline.llm import url_filter
from wearline.llm.url_filter import ALLOW, BLOCK

PAGES = "page_id long, url string, html string, host string, key string, keys string, rule string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(url, rules, sites):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host) :]).group()
    host = host.translate(UPPER)

    def inside(name):
        return bool(host) and (host == name or host.endswith("." + name))

    fit = [(len(h + p), h.count("."), h + p, v) for h, p, v in rules if inside(h) and path.startswith(p)]
    if not fit:
        return host, path, None, BLOCK if any(map(inside, sites)) else ALLOW
    best = max(fit)[:3]
    return host, path, best[2], BLOCK if (*best, BLOCK) in fit else ALLOW


def pages_of(spark, urls):
    rows = [(k // 2, url, "h", "x", "y", "z", "r") for k, url in enumerate(urls)]  # page ids repeat
    return spark.createDataFrame(rows, PAGES).repartition(3)


ODD = [
    None, "", "no scheme", "://", "http://", "http://EXAMPLE.org/es/", "http://example.org/es", "https://a.example.org/en/12?x#y",
    "http://notexample.org/es/", "http://org/", "http://org", "x://y://com/fr/", "http://a.com/fr/b", "http://b.COM/FR/",
    "http://É.com/de/é", "http://com/de/" + "a/" * 5_000, "http://.org/", "http://a..org/", "http://org./", "http://com:80/fr/",
    "http://m.ads-track.example.com/en/1", "http://ads-track.example.com", "http://bads-track.example.com/", "http://a.com/\nfr/",
]


@pytest.mark.parametrize("bits", [url_filter.FILTER_BITS, 0])
def test_rules_of_the_query(spark, bits):
    pages = pages_of(spark, ODD + ODD)
    found = url_filter.judge(pages, url_filter.rule_table(spark), url_filter.site_table(spark), bits)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    wanted = [(k // 2, *brute(u, url_filter.RULES, url_filter.SITES)) for k, u in enumerate(ODD + ODD)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)


def test_long_lists(spark):
    rng = random.Random(7)
    hosts = [".".join(rng.choices("abcde", k=rng.randint(1, 4))) for _ in range(300)]
    paths = ["/" + "".join(rng.choices("ab/", k=rng.randint(0, 6))) for _ in range(300)]
    rules = [(rng.choice(hosts), rng.choice(paths)[: rng.randint(0, 5)], rng.choice((ALLOW, BLOCK))) for _ in range(200)]
    sites = rng.sample(hosts, 30)
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(800)]
    lists = url_filter.rule_table(spark, rules + rules), url_filter.site_table(spark, sites)
    wanted = sorted(((k // 2, *brute(u, rules, sites)) for k, u in enumerate(urls)), key=str)
    for bits in (url_filter.FILTER_BITS, 0):
        found = url_filter.judge(pages_of(spark, urls), *lists, bits).collect()
        assert sorted(map(tuple, found), key=str) == wanted


def test_cascade_is_exact_where_one_filter_is_not(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "_size", lambda keys: 1 << 15)
    listed = [f"listed{k}" for k in range(9_000)]
    others = [f"other{k}" for k in range(20_000)]
    frames = [spark.createDataFrame([(k,) for k in keys], "key string") for keys in (listed, others + listed + others)]
    cascade = url_filter.build_cascades({"block": frames[0]}, frames[1])["block"]
    wrong = taken_for_listed(cascade, others)
    assert wrong > 1_000 and len(cascade.levels) >= 3
    assert cascade.holds(np.array(listed, object)).all()
    assert not cascade.holds(np.array(others, object)).any()


def taken_for_listed(cascade, keys):
    """Keys that the first filter alone takes for listed."""
    return int(cascade.passes(np.array(keys, object), 0).sum())


def test_empty_lists_and_tables(spark):
    rules, sites = url_filter.rule_table(spark), url_filter.site_table(spark)
    pages = pages_of(spark, ODD)
    open_ = url_filter.judge(pages, rules.limit(0), sites.limit(0)).collect()
    assert len(open_) == len(ODD) and {(r["rule"], r["verdict"]) for r in open_} == {(None, ALLOW)}
    assert url_filter.judge(pages.limit(0), rules, sites).isEmpty()
