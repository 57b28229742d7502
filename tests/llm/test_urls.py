"""URL rules against a run of every rule on every URL."""

import re

from quarry.llm.urls import Rule, RuleIndex, filter_urls

RULES = [Rule("org/", "allow"), Rule("example.org/es/", "block"), Rule("example.org/en/1", "block"), Rule("com/fr/", "allow"), Rule("com/de/", "block")]
URLS = ["http://a.example.org/es/1?x#y", "https://EXAMPLE.org/en/12", "http://example.org/en/2", "http://badexample.org/es/2", "x://com/fr/",
        "http://shop.com/de/", "http://shop.com/de", "http://shop.com", "no scheme", "", None, "http://", "http://example.org?es/", "a://b://example.org/es/",
        "http://example.org:80/es/", "http://user@example.org/es/", "http://ÄB.org/É/x", "http://x.com/FR/", "http://example.org/es/\n/z", "http://org/",
        "http://example.org/" + "long/" * 20_000, "http://.org/es/"]


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in rules:
        h, p = rule.text.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = max(best or (0, ""), (len(rule.text), rule.verdict, rule.text))
    return host, path, best[2] if best else None, best[1] if best else default


def test_contract_rules(spark):
    rows = [(i, u, "r", "v") for i, u in enumerate(URLS)] + [(None, URLS[0], "r", "v"), (0, URLS[0], "r", "v")]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string, host string").repartition(3)
    got = sorted((tuple(r) for r in filter_urls(df, RULES).collect()), key=str)
    assert got == sorted(((r[0], *brute(r[1], RULES)) for r in rows), key=str)
    assert filter_urls(df.limit(0), RULES).collect() == []
    assert {r.verdict for r in filter_urls(df, [], "block").collect()} == {"block"}


def test_index_uses_the_rarest_token_and_finds_all():
    index = RuleIndex(RULES, {"org": 900, "example": 100, "es": 7, "en": 300, "com": 800, "fr": 90, "de": 50})
    assert {t: sorted(r[1] for r in v) for t, v in index.by_token.items()} == {
        "org": ["org/"], "es": ["example.org/es/"], "example": ["example.org/en/1"], "fr": ["com/fr/"], "de": ["com/de/"]}
    many = [Rule(f"h{i}.net/p{i % 7}/{i}", "block" if i % 2 else "allow") for i in range(300)] + [Rule("/", "block"), Rule("net", "allow")]
    index = RuleIndex(many, {})
    for i in range(0, 400, 7):
        host, path = f"www.h{i}.net", f"/p{i % 7}/{i}5"
        want = [(len(r.text), r.verdict, r.text) for r in many if re.match(r.pattern, host + path)]
        assert index.judge(host, path) == ((max(want)[2], max(want)[1]) if want else (None, None))
