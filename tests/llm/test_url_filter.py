import numpy as np
import pytest

from arriero.llm import url_filter
from tests.llm.helpers import tuples

PAGES = "page_id long, url string, html string, verdict string, key string, listed boolean"


def judge(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), h + p, kind) for kind, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


URLS = ["https://example.org/es/1", "https://EXAMPLE.org/en/1", "http://a.example.org/en/12?x#y", "http://example.org/en/2", "http://x.com/fr/1", "http://x.com/de/1", "http://x.com/other", "http://y.com/a",
        "http://com/de/", "http://notexample.org/es/1", "http://example.org", "http://example.org?q=/es/", "ftp://é.com/de/ä", "no scheme", "", None, "http://", "x://a://b/de/", "http://h.com/d\ne/x", "http://Ä.COM/fr/", "http://x.com/de/1"]


def pages(spark, urls=URLS):
    return spark.createDataFrame([(i, u, "<p>", "x", "y", False) for i, u in enumerate(urls)] + [(None, "http://y.com/b", None, None, None, None)], PAGES)


@pytest.mark.parametrize("most_bytes", [url_filter.MOST_BYTES, -1])
def test_verdicts(spark, most_bytes):
    """The same answers whether the cascade travels to the tasks or meets the rows by shard, in one shard or several."""
    rows = [(i, *judge(u)) for i, u in [*enumerate(URLS), (None, "http://y.com/b")]]
    listed = {h for _, h, _, _, kind in rows if kind == "block"}
    want = sorted([(i, h, p, r, kind or ("block" if h in listed else "allow")) for i, h, p, r, kind in rows], key=str)
    assert tuples(url_filter.judge(pages(spark), shard_keys=3, most_bytes=most_bytes)) == want


def test_empty_table(spark):
    assert url_filter.judge(pages(spark).where("false")).collect() == []


def test_no_rule(spark):
    assert {r.verdict for r in url_filter.judge(pages(spark), rules=()).collect()} == {"allow"}


@pytest.mark.parametrize("share", [0, .001, .2, .9, 1])
def test_the_cascade_is_exact_over_its_universe(share):
    rng = np.random.default_rng(3)
    h1, h2 = rng.integers(-2 ** 63, 2 ** 63 - 1, 20_000), rng.integers(-2 ** 63, 2 ** 63 - 1, 20_000)
    listed = rng.random(20_000) < share
    levels = url_filter.build_levels(h1, h2, listed)
    assert np.array_equal(url_filter.ask_levels(levels, h1, h2), listed)
    if share == .001:
        assert sum(len(f) for _, _, f in levels) < 1200
