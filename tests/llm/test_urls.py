"""URL rules against plain Python, and trees on URLs that can be told apart."""

import random
import re

from pyspark.sql import functions as F

from lexiloom.llm.queries import RULES
from lexiloom.llm.urls import _statistics, judge_urls, labelled_sample, lexical_features, url_parts


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def brute_rule(host, path):
    fits = [(len(h + p), -i, h + p, v) for i, (v, h, p) in enumerate(RULES) if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


URLS = [
    "http://a.example.net/fr/1", "https://EXAMPLE.net/en/2?x=1", "http://example.net", "http://net/", "http://xnet/", "http://b.example.com/de/3#t", "http://example.com/DE/3",
    "http://Ä.Example.ORG/fr/", "http://org/fr/x", "http://example.net/en", "ftp://example.net:80/en/", "http://example.com?x=http://c.net/", "http://a://b.net/", None, "", "no url", "://", "http:///x",
    "http://notexample.net/en/5", "http://a.net/en/5", "http://example.com/de/\n/x", "http://u@example.net/",
]


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "h", 1.0) for i, u in enumerate(urls)], "page_id long, url string, host string, label double")


def test_rules(spark):
    urls = [*URLS, "http://x.net/" + "a" * 100_000]
    pages = frame(spark, urls).union(frame(spark, urls[:3]))
    found = judge_urls(pages, RULES).collect()
    assert len(found) == len(urls) + 3
    for r in found:
        host, path = brute_parts(urls[r.page_id])
        assert (r.host, r.path) == (host, path), urls[r.page_id]
        rule, verdict = brute_rule(host, path)
        assert r.rule == rule
        assert r.verdict == verdict if verdict else r.verdict in ("block", "allow")
    rows = spark.createDataFrame([("A://B",)], "url string")
    assert rows.select(*url_parts(rows.url)).collect()[0][0] == "b"


def test_trees_learn_from_labels(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choices("abcdefgh", k=n))
    good = [f"https://{word(6)}.example.com/{word(4)}/{word(8)}" for _ in range(300)]
    bad = [f"http://{word(3)}-{word(3)}-{rng.randrange(10**6)}.xyz/{rng.randrange(10**9)}?a={rng.randrange(99)}&b={word(9)}&c=1" for _ in range(300)]
    labels = spark.createDataFrame([(u, 0) for u in good[:200]] + [(u, 1) for u in bad[:200]], "url string, label int")
    pages = frame(spark, good + bad)
    found = {r.page_id: r.verdict for r in judge_urls(pages, [], labels).collect()}
    right = sum(found[i] == ("allow" if i < 300 else "block") for i in [*range(200, 300), *range(500, 600)])
    assert right >= 190
    capped = judge_urls(pages, [], labels, most_labelled=50)
    assert capped.count() == 600


def test_no_labels_and_empty_table(spark):
    found = judge_urls(frame(spark, ["http://a.com/", "http://b.com/x"]), RULES).collect()
    assert [(r.verdict, r.score) for r in found] == [("allow", None)] * 2
    assert judge_urls(frame(spark, URLS).limit(0), RULES).count() == 0


def test_features(spark):
    rows = spark.createDataFrame([("http://a-b.co.uk/x/y1?p=1&q=2#z", "a-b.co.uk", "/x/y1"), (None, "", "")], "url string, host string, path string")
    first, second = sorted(lexical_features(rows).collect(), key=lambda r: -r.url_length)
    assert (first.depth, first.labels, first.parameters, first.fragment, first.hyphens, first.suffix, first.site) == (2, 3, 2, 1, 1, "uk", "co.uk")
    assert abs(first.digits - 3 / 31) < 1e-9
    assert (second.entropy, second.parameters, second.url_length) == (0.0, 0.0, 0.0)


def test_copies_of_a_labelled_url_take_one_place(spark):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choices("abcdefgh", k=n))
    good = [f"https://{word(6)}.example.com/{word(4)}/{word(8)}" for _ in range(150)]
    bad = [f"http://{word(3)}-{word(3)}-{rng.randrange(10**6)}.xyz/{rng.randrange(10**9)}?a={rng.randrange(99)}&b={word(9)}&c=1" for _ in range(150)]
    labels = spark.createDataFrame([(u, 0) for u in good[:100]] + [(u, 1) for u in bad[:100]], "url string, label int")
    hot = labels.orderBy(F.xxhash64("url")).first().url
    pages = frame(spark, good + bad + [hot] * 200)
    found = {r.page_id: r for r in judge_urls(pages, [], labels, most_labelled=100).collect()}
    assert all(r.score is not None for r in found.values())
    right = sum(found[i].verdict == ("allow" if i < 150 else "block") for i in [*range(100, 150), *range(250, 300)])
    assert right >= 95


def test_both_labels_are_in_the_sample(spark):
    rows = [(f"http://{i}.net/", 1.0) for i in range(500)] + [("http://a.org/", 0.0)] * 3
    sample = labelled_sample(spark.createDataFrame(rows, "url string, label double"), 10).collect()
    assert sorted(r.label for r in sample) == [0.0] + [1.0] * 9
    assert abs(sum(r.weight for r in sample if r.label) - 500) < 1e-9
    assert labelled_sample(spark.createDataFrame(rows[:500], "url string, label double"), 10) is None


def test_suffix_without_labels_has_no_verdict(spark):
    rows = [("net", "a.net", 1.0)] + [("net", "a.net", None)] * 50 + [("io", "b.io", None)] * 50
    suffixes, _ = _statistics(spark.createDataFrame(rows, "suffix string, site string, label double"), 101)
    assert {r.suffix: r.suffix_blocked for r in suffixes.collect()} == {"net": 2 / 3, "io": 0.5}
