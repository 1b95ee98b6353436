import pytest

from quarrykit.llm import op2_urls as op

URLS = [
    None, "", "   ", "http://", "?x", "example.net", "https://EXAMPLE.net./a", "http://u:p@blog.tionsh.example.net:8080/fr/825/deep?q=/x#/y", "http://blog.tionsh.example.net/fr/82",
    "http://blog.tionsh.example.net", "http://a.blog.tionsh.example.net/fr", "http://notexample.net", "http://10.0.0.1/x", "http://[::1]:80/x", "//", "http://x..y/", "ftp://cheap-pills.example.com//a",
    "http://www.ththhe.example.com//en//687/", "http://www.ththhe.example.com/EN", "http://h/" + "a/" * 20000, "mailto:x",
]


def read(url):
    """(host parts from the right, path parts), character by character; None without a host."""
    url = (url or "").strip(" \t\r\n")
    head, mark, tail = url.partition("://")
    if mark and head[:1].isalpha() and head.isascii() and all(c.isalnum() or c in "+.-" for c in head):
        url = tail
    for i, c in enumerate(url):
        if c in "?#":
            url = url[:i]
            break
    host, *path = url.split("/")
    host = host[host.rfind("@") + 1 :]
    at = host.rfind(":")
    if at >= 0 and all(c in "0123456789" for c in host[at + 1 :]):
        host = host[:at]
    while host[-1:] == ".":
        host = host[:-1]
    host = host.lower()
    if not host or not host.replace(".", ""):
        return None
    alone = host[0] == "[" or all(c in "0123456789." for c in host)
    return [host] if alone else [x for x in reversed(host.split(".")) if x], [x for x in path if x]


def brute(url, allow, block):
    """Every entry is held against the URL."""
    at = read(url)
    if at is None:
        return "invalid", None, 0
    best = ("default", None, 0)
    for v, entries in (("allow", allow), ("block", block)):
        for e in entries:
            labels, segments = read(e)
            covers = at[0] == labels and at[1][: len(segments)] == segments if segments else at[0][: len(labels)] == labels
            if covers and len(labels) + len(segments) >= best[2]:
                best = (v, e, len(labels) + len(segments))
    return best


@pytest.mark.parametrize("most_nodes", [10**6, 0])
def test_both_ways_give_the_longest_match(spark, most_nodes):
    allow, block = [*op.ALLOW, "both.example", "h/a/a", "[::1]"], [*op.BLOCK, "both.example", "h/a", "10.0.0.1", "x.y"]
    urls = URLS + ["http://both.example/z", "http://both.example/z"]
    pages = spark.createDataFrame([(i, u, "v", 0) for i, u in enumerate(urls)] + [(None, "h", "v", 1)], "page_id long, url string, verdict string, depth int")
    got = op.filter_urls(pages, allow, block, most_nodes=most_nodes).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.verdict, r.entry, r.depth) == brute(r.url, allow, block), r
    assert op.filter_urls(pages.limit(0), allow, block, most_nodes=most_nodes).count() == 0


def test_named_cases():
    t = op.Trie(op.ALLOW, op.BLOCK)
    assert t.match("https://blog.tionsh.example.net/fr/825?x")[0] == "allow"
    assert t.match("https://blog.tionsh.example.net/fr/8")[0] == "block"
    assert t.match("https://blog.tionsh.example.net/en")[0] == "allow"
    assert t.match("https://other.example.net")[0] == "block"
    assert t.match("https://notexample.net") == ("default", None, 0)
    with pytest.raises(ValueError):
        op.Trie(["/x"], [])


def test_spaces_match_the_same_by_join(spark):
    urls = ["http://a.example.com/fr 825", "http://a.example.com/fr/825", "http://a example.com/x", "http://[b.a/x", "http://a.[b/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    allow, block = ["a.example.com/fr/825", "[b.a"], ["example.a.com"]
    got = [sorted(map(tuple, op.filter_urls(pages, allow, block, most_nodes=m).collect())) for m in (100, 0)]
    assert got[0] == got[1] and [r[2] for r in got[0]] == ["default", "allow", "default", "allow", "default"]
