from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from trapiche.llm.url_rules import best_rule, judge_urls, mine_rules, rule, url_parts, url_tokens

RULES = [
    rule("allow", "com/"),
    rule("block", "example.com/en/"),
    rule("allow", "www.example.com/en/"),
    rule("block", "net/es/"),
    rule("block", "net/fr/"),
]
URLS = [
    "http://a.example.com/en/1",
    "https://WWW.Example.com/en/1?x=://b",
    "https://sub.www.example.com/en/",
    "http://example.com/fr/",
    "http://notexample.com/en/",
    "http://a.net/es/9#top",
    "http://net/fr/",
    "http://a.net/ES/",
    "http://a.net",
    "http://a.org/en/1",
    "no scheme",
    "://",
    "x://É.com/ü?q",
    "a\nb://h.com\n/p\nq",
    "",
    None,
]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :].split("?", 1)[0].split("#", 1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    best = None
    for r in RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            if best is None or len(r.text) > len(best.text):
                best = r
    return best


def test_parts_and_rules_equal_plain_code(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    host, path = url_parts(F.col("url"))
    found = df.select("url", host.alias("h"), path.alias("p"), best_rule(host, path, RULES).alias("r"))
    for r in found.collect():
        assert (r["h"], r["p"]) == plain_parts(r["url"])
        expected = plain_rule(r["h"], r["p"])
        assert (r["r"] and r["r"]["rule"]) == (expected and expected.text)


def brute_rules(baskets, support, confidence):
    """Minimal sure combinations by counting every subset."""
    seen, with_verdict = defaultdict(int), defaultdict(int)
    for tokens, verdict in baskets:
        for n in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), n):
                seen[part] += 1
                with_verdict[part, verdict] += 1
    sure = {
        (part, verdict): n / seen[part]
        for (part, verdict), n in with_verdict.items()
        if n >= support * len(baskets) and n / seen[part] >= confidence
    }
    return {
        (part, verdict): c
        for (part, verdict), c in sure.items()
        if not any(
            v == verdict and set(p) < set(part) and sure[p, v] >= c for p, v in sure
        )
    }


@pytest.fixture(scope="module")
def pages(spark):
    urls = []
    for i in range(40):
        urls += [f"http://a{i % 7}.example.com/en/{i}", f"https://www.example.com/en/{i}.html"]
        urls += [f"http://b{i % 5}.net/{'es' if i % 2 else 'fr'}/{i}", f"http://c{i % 3}.com/de/{i}"]
        urls += [f"http://d{i % 4}.org/{'es' if i % 3 else 'de'}/{i}", f"http://b{i % 5}.net/en/{i}"]
    rows = list(enumerate([*urls, *URLS, urls[0], urls[4]]))
    return spark.createDataFrame(rows + [(None, urls[5])], "page_id long, url string").repartition(3)


def test_mined_rules_equal_brute_force(spark):
    baskets = [(["a", "b"], "x")] * 6 + [(["a", "c"], "y")] * 5 + [(["a", "b", "c"], "x")] * 3
    baskets += [(["c"], "x"), (["d"], "y")]
    table = spark.createDataFrame(baskets, "tokens array<string>, verdict string")
    found = {
        (tuple(r["tokens"]), r["verdict"]): r["confidence"]
        for r in mine_rules(table, 0.1, 0.6).collect()
    }
    assert found == pytest.approx(brute_rules(baskets, 0.1, 0.6))


def test_verdicts_equal_brute_force(spark, pages):
    marked = pages.withColumns({c: F.lit("own") for c in ("host", "tokens", "mined", "token")})
    found = judge_urls(marked, RULES, least_support=0.02).collect()
    assert len(found) == pages.count()
    token_rows = pages.select("url", url_tokens(*url_parts(F.col("url"))).alias("tokens")).collect()
    tokens = {r["url"]: r["tokens"] for r in token_rows}
    labelled = []
    for r in found:
        written = plain_rule(*plain_parts(r["url"]))
        if written:
            labelled.append((tokens[r["url"]], written.verdict))
    mined = brute_rules(labelled, 0.02, 0.9)
    unruled = set()
    for r in found:
        host, path = plain_parts(r["url"])
        written = plain_rule(host, path)
        assert (r["host_"], r["path"], r["rule"]) == (host, path, written and written.text)
        hits = [(c, len(p), v) for (p, v), c in mined.items() if set(p) <= set(tokens[r["url"]])]
        expected = written.verdict if written else max(hits)[2] if hits else "allow"
        assert r["verdict"] == expected
        if not written:
            unruled.add(r["verdict"])
    assert unruled == {"allow", "block"}


def test_nothing_labelled_and_empty_table(spark):
    lone = spark.createDataFrame([(1, "http://x.org/a"), (2, None)], "page_id long, url string")
    found = judge_urls(lone, RULES).collect()
    assert {(r["rule"], r["verdict"]) for r in found} == {(None, "allow")}
    assert judge_urls(lone.where("false"), RULES).collect() == []
