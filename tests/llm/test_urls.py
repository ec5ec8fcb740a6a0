import re

from marquee.llm import urls

ODD = [
    (1, "https://spam-farm.example.org/en/12?x=1"), (2, None), (3, "no scheme"), (4, "HTTP://A.Example.ORG/es/x#f"),
    (5, "http://example.org"), (6, "http://example.org/en/1"), (7, "http://notexample.org/en/1"), (8, "ftp://x.com/de/"),
    (9, "http://x.com/fr/?u=http://y"), (10, "http://x.net/wp-login.php"), (11, "http://x.net/a?PHPSESSID=3"),
    (12, "http://x.net/robots.txt"), (13, "http://ads.x.net/robots.txt"), (14, "http://x.net/cgi-bin/a/b.exe"),
    (15, "http://x.net/casino"), (16, "http://x.net/casinos"), (17, "http://x.net/trackback"), (18, "http://x.net/trackback/"),
    (19, ""), (20, "http://x.net/" + "a/" * 20_000 + "casino/"), (1, "https://spam-farm.example.org/en/12?x=1"),
    (21, "http://myspam-farm.net/"), (22, "http://x.net/é?a&affiliate=1&campaign=2"), (23, "http://x.net/\n?sessionid=1"), (None, "http://org/"),
]


def brute(url):
    url = url or ""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
    host, path = (m.group(1).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), m.group(2)) if m else ("", "")
    fits = [s for s in urls.SITES if (host == s.host or host.endswith("." + s.host)) and path.startswith(s.path)]
    small = url.lower() if url.isascii() else "".join(c.lower() if c.isascii() else c for c in url)
    hit = sorted(("allow" if p.startswith("@@") else "block", p) for p in urls.PATTERNS if re.search(urls.compiled(p.removeprefix("@@")), small))
    site = max(fits, key=lambda s: len(s.name), default=None)
    return host, path, site and site.name, hit[0][1] if hit else None, site.verdict if site else hit[0][0] if hit else "allow"


def test_equals_trying_every_rule(spark):
    pages = spark.createDataFrame([(i, u, "c", "t") for i, u in ODD], "page_id long, url string, pattern string, token string")
    got = sorted((tuple(r) for r in urls.judge(pages).select("page_id", "host", "path", "rule", "pattern", "verdict").collect()), key=repr)
    assert got == sorted(((i, *brute(u)) for i, u in ODD), key=repr)
    assert {r[4] for r in got} >= {"||spam-farm.", "||ads.", "^casino^", "@@/robots.txt|", "/trackback|", "^phpsessid^"} - {"||ads."}


def test_patterns_without_a_token_run_on_all(spark):
    pages = spark.createDataFrame([(1, "http://a/xyz1"), (2, "http://a/b")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge(pages, (), ("*xyz", "foo^bar")).collect()}
    assert got == {1: "block", 2: "allow"}


def test_tokens_are_needed_whole():
    assert urls.safe_tokens("||spam-farm.") == ["spam", "farm"]
    assert urls.safe_tokens("casino") == []
    assert urls.safe_tokens("/a*b/cd^|") == ["cd"]
    assert urls.safe_tokens("|http") == [] and urls.safe_tokens("index|") == []


def test_the_rarest_token_is_the_key(spark):
    rules = urls.pattern_table(spark, ("/com/rare/",))
    tokens = spark.createDataFrame([("u1", "com"), ("u2", "com"), ("u1", "rare")], "url string, token string")
    assert urls.token_index(rules, tokens).first().token == "rare"


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
