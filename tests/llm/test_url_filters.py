import random
import re

from tidelog.llm.url_filters import Rule, ShiftAnd, filter_urls


def as_regex(glob):
    parts = re.split(r"(\*\*|\*|\?)", glob)
    return re.compile("".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in parts) + r"\Z", re.S)


def test_automaton_equals_regex():
    rng = random.Random(5)
    some = lambda n, of: "".join(rng.choices(of, k=n))
    globs = [some(rng.randint(0, 12), ["a", "b", "/", ".", "*", "**", "?"]) for _ in range(60)] + ["a" * 70 + "*b"]
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    urls = [some(rng.randint(0, 20), "ab/.") for _ in range(400)] + ["a" * 75 + "b", ""]
    found = ShiftAnd(globs).match([u.encode() for u in urls])
    for k, glob in enumerate(globs):
        pattern = as_regex(glob)
        assert [bool(pattern.match(u)) for u in urls] == found[:, k].tolist(), glob


def test_edges(spark):
    urls = [
        None, "", "no scheme.org/x", "http://", "http://ORG/", "https://a.Example.ORG/es/1?x=/y#z", "http://org",
        "http://xorg/", "http://x.com/de/", "http://x.com/DE/", "http://x.com/fr/", "http://example.org/en/12",
        "http://x.example.org?q", "http://h/p://q", "http://é.org/ü", "http://x.net/" + "a" * 50000,
        "http://t.net/x.example.org/es/",
    ]
    rows = [(i, u, "x") for i, u in enumerate(urls)] + [(4, urls[4], "x")]
    got = filter_urls(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    for i in (0, 1, 2, 3):
        assert by[i] == ("", "", None, "allow")
    assert by[4] == ("org", "/", "org/", "allow")
    assert by[5] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert by[6] == ("org", "", None, "allow") and by[7][2] is None
    assert by[8][2:] == ("com/de/", "block") and by[9][2] is None and by[10][2:] == ("com/fr/", "allow")
    assert by[11][2:] == ("example.org/en/1", "block")
    assert by[12] == ("x.example.org", "", None, "allow")
    assert by[13] == ("h", "/p://q", None, "allow")
    assert by[14] == ("é.org", "/ü", "org/", "allow")
    assert by[16][2] is None
    assert filter_urls(spark.createDataFrame([], "url string")).count() == 0
    none = filter_urls(spark.createDataFrame([("http://a/b",)], "url string"), rules=(), default="block")
    assert none.first()["verdict"] == "block"


def test_longest_rule_wins(spark):
    rules = (Rule("block", "net/"), Rule("allow", "a.net/x/"), Rule("block", "net/x/y"))
    df = spark.createDataFrame([("http://a.net/x/y",), ("http://b.net/x/y",), ("http://b.net/q",)], "url string")
    assert [r["rule"] for r in filter_urls(df, rules).collect()] == ["a.net/x/", "net/x/y", "net/"]
