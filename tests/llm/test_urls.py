from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from sievewell.llm.queries import BLOCKED_HOSTS, URL_RULES
from sievewell.llm.url_cascade import fit_cascade, judge_urls, page_key

UPPER = {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m[1].translate(UPPER), m[2]) if m else ("", "")
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.key), default=None)
    listed = any(host == h or host.endswith("." + h) for h in BLOCKED_HOSTS)
    return host, path, best and best.key, best.verdict if best else "block" if listed else "allow"


def test_rules_and_listed_hosts(spark):
    rng = random.Random(1)
    hosts = ["com", "example.com", "EXAMPLE.com", "www.example.com", "a.www.example.com", "notexample.com", "x.net", "net", "spam-farm.example.org", "b.spam-farm.example.org", "example.org", "com:80", ".com", "a..net", ""]
    paths = ["", "/", "/en", "/en/", "/en/1", "/es/9", "/fr/", "/FR/", "//en/", "/en/?q=/es/", "#x", "?a", "/é"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "a://b://c", "http:/x.com/", "://net/fr/", "http://example.com/\nen/"]
    rng.shuffle(urls)
    pages = spark.createDataFrame([(i, u, "kept") for i, u in enumerate(urls + urls[:9])], "page_id bigint, url string, rule string")
    got = judge_urls(pages, URL_RULES, BLOCKED_HOSTS).select("url", "host", "path", "rule", "verdict").collect()
    assert len(got) == len(urls) + 9
    for r in got:
        assert tuple(r)[1:] == plain(r.url), r.url


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert judge_urls(pages, URL_RULES, BLOCKED_HOSTS).count() == 0


def test_a_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("hash(key) % 7 = 0").union(spark.createDataFrame([("elsewhere",)], "key string"))
    cascade = fit_cascade(universe, listed)
    assert len(cascade.levels) > 2
    wrong = universe.where(cascade.holds(F.col("key")) != (F.expr("hash(key) % 7 = 0")))
    assert wrong.count() == 0


def test_the_first_level_is_sized_by_the_universe(spark):
    universe = spark.range(200_000).select(F.concat(F.lit("k"), F.col("id") % 100_000).alias("key"))
    for share in (10, 1000):
        cascade = fit_cascade(universe, universe.where(f"abs(hash(key)) % {share} = 0"))
        listed = 100_000 / share
        assert universe.where(cascade.holds(F.col("key")) != F.expr(f"abs(hash(key)) % {share} = 0")).count() == 0
        second = 64 * len(cascade.levels[1].words) / 15
        assert second < 1.5 * listed + 64, "the second level holds fewer keys than the list, about"


def test_blocked_pages_in_several_parts(spark):
    urls = [f"http://h{i % 7}.example.net/p/{i}?q" for i in range(600)] + [None, "", "x", "http://" + "y" * 200_000 + ".org/" + "z" * 200_000]
    rows = [(i, u, i, "mine") for i, u in enumerate(urls + urls[:50])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, __keys bigint, __listed string")
    listed = [f"h{i % 7}.example.net/p/{i}" for i in range(0, 600, 3)] + ["y" * 200_000 + ".org/" + "z" * 200_000, "gone.org/", "", None]
    blocked = spark.createDataFrame([(k,) for k in listed * 2], "key string")
    for most in (30, 10_000):
        got = judge_urls(pages, URL_RULES, BLOCKED_HOSTS, blocked_pages=blocked, most_listed=most).collect()
        assert len(got) == len(rows)
        for r in got:
            host, path, rule, verdict = plain(r.url)
            if rule is None and (host + path) in listed and host + path:
                verdict = "block"
            assert (r.host, r.path, r.rule, r.verdict, r["__keys"], r["__listed"]) == (host, path, rule, verdict, r.page_id, "mine")


def test_empty_block_list_and_page_keys(spark):
    pages = spark.createDataFrame([(1, "http://A.Example.org/B?c"), (2, None)], "page_id bigint, url string")
    assert [r[0] for r in pages.orderBy("page_id").select(page_key(F.col("url"))).collect()] == ["a.example.org/B", ""]
    none = spark.createDataFrame([], "key string")
    assert {r.verdict for r in judge_urls(pages, (), (), blocked_pages=none).collect()} == {"allow"}
