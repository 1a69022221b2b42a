import pytest
from brute import as_dicts, rows, url_verdict

from tripmill.llm import url_rules as U
from tripmill.llm import queries


def test_every_page_against_all_rules(spark, sf_dir):
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
           for r in as_dicts(queries.op1_url_filter(spark, sf_dir))}
    want = {p["page_id"]: url_verdict(p["url"], U.HOST_RULES, U.PATTERN_RULES, U.regex_of)
            for p in rows(sf_dir, "pages")}
    assert got == want and {v[3] for v in want.values()} == {"allow", "block"}


ODD = [None, "", "no address", "://", "http://", "HTTP://WWW.Example.COM/EN/x", "http://a.net/es",
       "http://a.net/es/?q=/x", "http://x.net?p=/es/", "http://com/", "http://xcom/", "http://a.com",
       "http://b.org/ads/", "http://b.org/bads/", "http://example.org/ads/about", "ftp://a.b/c#d/e",
       "http://b.org/a/tracker/z.gif", "http://b.org/a/tracker/z.gifs", "http://c.de/" + "a" * 90_000,
       "http://m.casino-win.de/x", "http://notcasino-win.de", "http://b.org/?utm_source=spam",
       "http://b.org/?utm_source=spammy", "x://İ.de/ads/", "http://b.org/\n/ads/"]


def test_odd_addresses(spark):
    data = [(i, u, "x") for i, u in enumerate(ODD)] + [(None, "http://a.com/b", "y")] * 2
    pages = spark.createDataFrame(data, "page_id long, url string, verdict string")
    got = sorted((r["page_id"] is None, r["page_id"], r["host"], r["path"], r["rule"], r["verdict"])
                 for r in as_dicts(U.url_filter(pages)))
    want = sorted((i is None, i, *url_verdict(u, U.HOST_RULES, U.PATTERN_RULES, U.regex_of))
                  for i, u, _ in data)
    assert got == want


def test_empty_table_and_empty_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.url_filter(none).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/ads/")], "page_id long, url string")
    assert as_dicts(U.url_filter(one, (), ()))[0]["verdict"] == "allow"


@pytest.mark.parametrize("rule,tokens", [
    ("/ads/", ["ads"]), ("ads", []), ("||ads.", ["ads"]), ("ads/x-y", ["x"]), ("|http://a", ["http"]),
    ("*ads/pix^", ["pix"]), ("/a*b/", []), ("swf|", [])])
def test_tokens_that_stand_alone(rule, tokens):
    assert U.literal_tokens(rule) == tokens


def test_rules_are_filed_under_their_rarest_token():
    index = U.RuleIndex((), ("/common/rare/", "any"), {"common": 9, "rare": 1})
    assert dict(index.by_token) == {"rare": [0]} and index.anywhere == [1]
    assert index.candidates("http://a/common/") == [1]
