import math
import re
from collections import Counter

import pytest

from paylake.llm import urlfilter
from paylake.llm.queries import QUERIES, URL_RULES

SMALL = "/root/testdata/sf0.001"


def brute(url):
    _, found, rest = (url or "").partition("://")
    rest = rest if found else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fitting = []
    for action, rule in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fitting.append((len(rule), rule, action))
    best = max(fitting, default=(0, None, None))
    return host, path, best[1], best[2]


ODD = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com/en/1", "http://example.com", "x://com/",
    "http://a.net/es/1", "http://net/fr/", "http://notnet/fr/", "http://a.net/ES/1", "http://a.com?x://b.net/es/", "a://b://c/d",
    "http://É.com/é", "http://user@host.net:80/fr/a/../b", "http://a.net/es\n/x", "http://casinospam.org/poker/sex", "//x.com/a",
    "http://" + "longhost" * 2000 + ".org/" + "p" * 20_000,
]


def frame(spark, rows):
    return spark.createDataFrame([(i, u, "<html>", "x") for i, u in rows], "page_id long, url string, html string, rule string")


def check(rows, got):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    expected = [(i, *brute(u)[:3]) for i, u in rows]
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(expected, key=key)
    actions = {rule: action for action, rule in URL_RULES}
    assert all(r.verdict == actions[r.rule] for r in got if r.rule)
    assert all(r.verdict == ("block" if r.log_odds >= urlfilter.THRESHOLD else "allow") for r in got if not r.rule)


def test_query_on_unusual_rows(spark, folder):
    rows = [*enumerate(ODD), (5, ODD[5]), (None, ODD[6])]
    got = QUERIES["op5_url_words"](spark, folder(pages=frame(spark, rows))).collect()
    check(rows, got)
    assert {r.page_id: r.verdict for r in got if r.page_id in (0, 1, 2, 17)} == {0: "allow", 1: "allow", 2: "allow", 17: "block"}


def test_query_on_empty_table(spark, folder):
    assert QUERIES["op5_url_words"](spark, folder(pages=frame(spark, []))).collect() == []


def test_query_on_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()]
    check(rows, QUERIES["op5_url_words"](spark, SMALL).collect())


@pytest.mark.parametrize(
    ("run", "words"),
    [("freeonlinecasino", ["free", "online", "casino"]), ("bestgardenflowers", ["best", "garden", "flowers"]), ("a", ["a"])],
)
def test_split(run, words):
    assert list(urlfilter.Splitter().split(run)) == words


def test_split_is_the_cheapest():
    splitter = urlfilter.Splitter()

    def cheapest(run):
        if not run:
            return 0.0
        return min(splitter.cost.get(run[:i], splitter.letter if i == 1 else 1e9) + cheapest(run[i:]) for i in range(1, len(run) + 1))

    for run in ("bestoffers", "xqzthe", "therein"):
        assert sum(splitter.cost.get(w, splitter.letter) for w in splitter.split(run)) == pytest.approx(cheapest(run))


def test_bayes_learns_from_decided_urls(spark):
    rows = [(i, f"http://cheapnews{i}.net/es/offer") for i in range(30)] + [(100 + i, f"http://library{i}.com/books") for i in range(30)]
    rows += [(500, "http://x.org/offer/cheapnews"), (501, "http://y.org/library/books")]
    urls = urlfilter.prepare(frame(spark, rows), URL_RULES)
    odds = {r.page_id: r.log_odds for r in urlfilter.score(urls, urlfilter.fit(urls)).collect()}
    assert odds[500] > urlfilter.THRESHOLD
    assert odds[501] < 0


def test_other_scripts_and_percent_encoding_count():
    splitter = urlfilter.Splitter()
    assert splitter.words("/%D0%BD%D0%BE%D0%B2%D0%BE%D1%81%D1%82%D0%B8/Caf\u00e9-42%20freeonline") == ["\u043d\u043e\u0432\u043e\u0441\u0442\u0438", "caf\u00e9", "#2", "free", "online"]
    assert splitter.words("%zz%") == splitter.words("%ZZ%")


def test_verdicts_against_plain_counting(spark):
    """Multinomial naive Bayes over the words of all URLs that rules decide, by counters."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()]
    splitter = urlfilter.Splitter()
    actions = {rule: action for action, rule in URL_RULES}

    def words(url):
        host, path, _, _ = brute(url)
        return [urlfilter.feature(place, w) for place, text in (("host", host), ("path", path)) for w in splitter.words(text)]

    counts, urls = {"allow": Counter(), "block": Counter()}, Counter()
    for _, url in rows:
        rule = brute(url)[2]
        if rule:
            urls[actions[rule]] += 1
            counts[actions[rule]].update(words(url))
    extra = urlfilter.SEED_SHARE * max(counts["block"].total(), 1 / urlfilter.SEED_SHARE)
    for word in urlfilter.SEED_WORDS:
        for place in ("host", "path"):
            counts["block"][urlfilter.feature(place, word)] += extra

    def log_odds(url):
        found = words(url)
        odds = math.log((urls["block"] + 1) / (urls["allow"] + 1)) if found else 0.0
        for f in found:
            if counts["block"][f] + counts["allow"][f]:
                part = [math.log((counts[c][f] + 0.5) / (counts[c].total() + 0.5 * urlfilter.BUCKETS)) for c in ("block", "allow")]
                odds += part[0] - part[1]
        return odds

    got = {r.page_id: r for r in QUERIES["op5_url_words"](spark, SMALL).collect()}
    for i, url in rows:
        assert got[i].log_odds == pytest.approx(log_odds(url), abs=1e-6)
        if not brute(url)[2]:
            assert got[i].verdict == ("block" if log_odds(url) >= urlfilter.THRESHOLD else "allow")
