"""URL parts and given rules against plain code; mined rules against counting."""

import random
import re
from itertools import combinations

from oddsline.llm import url_rules as U
from oddsline.llm.queries import URL_RULES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
URLS = [None, "", "no scheme", "http://", "http://Example.ORG/es/1?x=1#f", "ftp://a://b/c", "https://example.org/en/12",
        "https://x.example.org/en/1", "https://notexample.org/es/", "http://org/", "http://org", "http://com/fr/", "http://a.com/de/x",
        "http://a.com?q=/fr/", "http://É.Com/fr/é", "://h/p", "http://u:p@h.com:80/de/", "http://a.net/fr/#?"]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = host.translate(LOWER)
    best = None
    for rule, verdict in URL_RULES:
        domain, _, start = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            if best is None or len(rule) > len(best[0]):
                best = rule, verdict
    return host, path, *(best or (None, "allow"))


def test_given_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string").selectExpr(
        "*", "'c' AS host", "'c' AS rule", "'c' AS _token")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.filtered(pages, labels, URL_RULES).collect()}
    assert got == {i: brute(u) for i, u in enumerate(URLS)}
    assert U.filtered(pages.filter("false"), labels, URL_RULES).count() == 0


def test_mined_rules_against_counting(spark):
    rnd = random.Random(9)
    pages, labels = [], []
    for i in range(400):
        host = rnd.choice(["good", "fine", "spam"]) + rnd.choice([".a", ".b"])
        url = f"http://{host}/{rnd.choice(['x', 'y'])}/{i}" + rnd.choice(["", "?utm=1"])
        bad = "spam" in url and "/x/" in url or rnd.random() < 0.05
        pages.append((i, url))
        labels += [(i, 0 if bad else 1, 0)] if i % 7 else []
    pages = spark.createDataFrame(pages + [(None, "http://n/"), (0, None)], "page_id long, url string")
    labels = spark.createDataFrame(labels + [(None, 0, 0), (9999, None, None)], "doc_id long, quality int, toxic int")
    rows = pages.select("page_id", "url", U.tokens(pages["url"]).alias("t")).collect()
    verdict = {r["doc_id"]: r["quality"] == 0 for r in labels.collect()}
    baskets = [(set(r["t"]), verdict[r["page_id"]]) for r in rows if r["page_id"] in verdict and r["page_id"] is not None]
    want = {}
    items = sorted(set().union(*(b for b, _ in baskets)))
    for n in range(1, 6):
        for combo in combinations(items, n):
            bad = [v for b, v in baskets if set(combo) <= b]
            if sum(bad) and sum(bad) >= 0.05 * len(baskets) and sum(bad) >= 0.6 * len(bad):
                want[combo] = round(sum(bad) / len(bad), 9)
    rules = U.mined(pages, labels, 0.05, 0.6)
    assert {tuple(r["antecedent"]): round(r["confidence"], 9) for r in rules.collect()} == want and want
    found = {r["url"]: r["confidence"] for r in U.matched(pages, rules).collect()}
    for r in rows:
        fit = [c for combo, c in want.items() if set(combo) <= set(r["t"])]
        assert (r["url"] in found) == bool(fit)
        assert not fit or round(found[r["url"]], 9) == max(fit)


def test_labels_are_those_of_the_document_in_the_path(spark):
    urls = ["http://h/en/7817?utm=1", "http://h/12.html#top", "http://h/x/9/", "http://h/", "http://h/a1", "http://h/1/a",
            "http://h/99999999999999999999", None, "http://h/?p=/5"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = [r["n"] for r in df.select("page_id", U.document_number(df["url"]).alias("n")).orderBy("page_id").collect()]
    assert got == [7817, 12, 9, None, None, None, None, None, None]


def test_rules_come_from_few_bad_pages_but_not_by_chance(spark):
    """Twelve bad pages of 3000 are below one per cent of all; three by chance make no rule."""
    pages, labels = [], []
    for i in range(3000):
        host, bad = ("spam", 1) if i < 12 else (("luck", 1) if i < 15 else (f"h{i % 40}", int(i % 4 == 0 and i % 40 < 36)))
        pages.append((90000 - i, f"http://{host}/{i}"))
        labels.append((i, 1 - bad, 0))
    pages = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = {tuple(r["antecedent"]) for r in U.mined(pages, labels).collect()}
    assert ("h:spam",) in rules and ("h:luck",) not in rules
    found = {r["page_id"]: r["verdict"] for r in U.filtered(pages, labels, []).collect()}
    assert all(found[90000 - i] == U.BLOCK for i in range(12)) and found[90000 - 13] == U.ALLOW
