from slotcast.llm import urls
from slotcast.llm.queries import RULES

URLS = [
    None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "HTTP://A.NET/x?y", "http://net/", "http://internet/", "http://www.Example.net/en/1", "http://example.net/en", "http://example.net/de/1#/en/",
    "http://example.com/de/", "http://notexample.com/de/", "http://m.example.com/de/x/y", "http://example.com/en/", "http://a.org/fr/?q", "http://org/fr/", "http://a.org/fr", "x://y://net/", "http://a.net#/", "http://ä.net/ü",
] + ["http://a.net/" + "x" * 100_000, "http://" + "a." * 50_000 + "net/x", "http://" + "." * 50_000 + "/", "http://" + "." * 9 + "net/"]


def expected(url):
    host, path = urls.split(url)
    best = max(((len(h + p), len(h), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    return (host, path, best[2], best[3]) if best else (host, path, None, "allow")


def table(spark):
    return spark.createDataFrame([(i, u, "h", "p", "r") for i, u in enumerate(URLS)], "page_id long, url string, host string, path string, rule string").repartition(2)


def test_equals_brute_force(spark):
    got = {r["page_id"]: tuple(r)[1:] for r in urls.judged(table(spark), RULES).collect()}
    assert got == {i: expected(u) for i, u in enumerate(URLS)}


def test_equal_digests_are_told_apart(spark):
    got = {r["page_id"]: tuple(r)[1:] for r in urls.judged(table(spark), RULES, digest=lambda b: len(b) % 3).collect()}
    assert got == {i: expected(u) for i, u in enumerate(URLS)}


def test_split():
    assert urls.split("HTTP://A.Ä.Net:80/p?q#f") == ("a.Ä.net:80", "/p") and urls.split("a?b://c/d") == ("c", "/d")


def test_empty_tables(spark):
    assert urls.judged(table(spark).limit(0), RULES).count() == 0
    assert {r["verdict"] for r in urls.judged(table(spark), []).collect()} == {"allow"}
