"""URL lookups of any depth, and with user part and port, against brute force without caps."""

import re

import pytest

from lorebase.llm import url_filter

DEEP_HOST, DEEP_PATH = "h.g.f.e.d.c.b.a", "s.example/a/b/c/d/"
LISTED = (f"{DEEP_HOST}.example/", DEEP_PATH, "t.example/1/2/3/4/5/6", "spam-farm.example.com/")
URLS = [
    f"http://{DEEP_HOST}.example/x/y", f"http://www.{DEEP_HOST}.example", "http://g.f.e.d.c.b.a.example/", "http://s.example/a/b/c/d/e/f/g?q", "http://s.example/a/b/c/d/", "http://s.example/a/b/c/d",
    "http://s.example/a/b/c/x/d/", "http://t.example/1/2/3/4/5/6", "http://t.example/1/2/3/4/5/6/7", "http://spam-farm.example.com:8080/", "http://user@spam-farm.example.com/", "http://u:p@x@www.spam-farm.example.com.:80/q",
    "http://spam-farm.example.com:/", "http://spam-farm.example.com:x/", "http://spam-farm.example.com@other.example/", "http://@/", "http://:80/", "http://[::1]:80/", "http://...:1/",
]


def is_listed(url, listed):
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0] or "/"
    site = re.sub(r":[0-9]*\Z", "", host.rpartition("@")[2].lower()).rstrip(".")
    if not site:
        return False
    fits = lambda h, p: (site == h or site.endswith("." + h)) and (path == p or p.endswith("/") and path.startswith(p))
    return any(fits(*re.fullmatch(r"([^/]*)(/.*)", e).groups()) for e in listed)


@pytest.mark.parametrize("listed", [LISTED, LISTED[:1], LISTED[1:2], LISTED[3:], ()])
def test_depth_and_ports(spark, listed):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(pages, url_filter.listed_frame(spark, listed), rules=()).collect()}
    assert {URLS[k]: r["listed"] for k, r in got.items()} == {u: is_listed(u, listed) for u in URLS}
    assert got[9]["host"] == "spam-farm.example.com:8080" and got[10]["host"] == "user@spam-farm.example.com"


def test_escapes(spark):
    listed = spark.createDataFrame([("x.org/a/",), ("spam.example.com/",)], "key string")
    urls = ["http://x.org/%61/b", "http://x.org/%zz/b", "http://spam%2Eexample.com/q", "http://x.org/a+b/", "http://x.org/%61%2Fb", "http://u:p@SPAM.example.com:80/%"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["verdict"], r["path"]) for r in url_filter.filter_urls(pages, listed, rules=()).collect()}
    assert [got[k][0] for k in range(6)] == ["block", "allow", "block", "allow", "block", "block"] and got[0][1] == "/%61/b"


def test_pages_without_a_scheme_are_not_dealt_out(spark, monkeypatch):
    """They have one host and path, all of them; so has a very frequent page."""
    rows = [(k, "no scheme") for k in range(50)] + [(k, "http://spam.org/x") for k in range(50, 80)] + [(90, None), (91, "http://fine.org/x")]
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(4)
    listed = spark.createDataFrame([("spam.org/",)], "key string")
    got = [url_filter.filter_urls(pages, listed)]
    plan = got[0]._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(host" not in plan
    monkeypatch.setattr(url_filter, "MAX_BROADCAST_ROWS", 0)
    got.append(url_filter.filter_urls(pages, listed))
    for out in got:
        assert {r["page_id"]: r["verdict"] for r in out.collect()} == {k: "block" if 50 <= k < 80 else "allow" for k, _ in rows}
