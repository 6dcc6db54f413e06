import re
from urllib.parse import unquote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riverbend.llm import url_filter
from riverbend.llm.url_filter import RULES, SOFT_TERMS, STRICT_TERMS, Rule, Vocabulary

PAGES = "page_id long, url string"


def brute_terms(url):
    """Every term looked for by itself."""
    url = re.sub("[A-Z]", lambda m: m[0].lower(), unquote(url or ""))
    other = "[^a-z0-9\x80-\U0010ffff]"
    found = [t for t in STRICT_TERMS + SOFT_TERMS if re.search(f"(?:\\A|{other}){re.escape(t)}(?:\\Z|{other})", url)]
    return sum(t in STRICT_TERMS for t in found), sum(t in SOFT_TERMS for t in found)


def brute(url, rules=RULES):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    strict, soft = brute_terms(url)
    rule = max(fits, key=lambda r: (len(r.name), len(r.host), r.verdict == "block"), default=None)
    return host, path, rule and rule.name, rule.verdict if rule else "block" if strict or soft > 1 else "allow", strict, soft


URLS = [
    None, "", "://", "no scheme", "http://", "http://a.net", "http://a.net/", "HTTP://X.Example.NET/en/1?q#f", "http://example.net/en", "http://notexample.net/en/",
    "http://org/fr/1", "https://a.b.org/FR/1", "https://a.org?/fr/", "https://example.com/de/x", "https://sub.example.com#/de/", "https://example.com:80/de/",
    "http://cheap-pills.example.com/", "http://cheapest.example.com/", "http://free.free.example.com/free", "http://xfree-bets.com", "http://free-bets.com",
    "http://a.com/p%6frn", "http://a.com/%20porn%20", "http://a.com/porné", "http://éporn.com", "http://a.com/PORN", "a://b://c.net/x", "http://a.com/\nb\r\n?free cheap",
    "http://" + "free." * 3000 + "com/" + "cheap" * 5000, "://net/", "http://.net/", "x.net/://y.org/fr/"]


def rows(found):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.n_strict, r.n_soft) for r in found), key=str)


def test_against_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), PAGES)
    assert rows(url_filter.judge_urls(pages).collect()) == rows([url_row(i, u) for i, u in enumerate(URLS)])


class url_row:
    def __init__(self, page_id, url, rules=RULES):
        self.page_id, (self.host, self.path, self.rule, self.verdict, self.n_strict, self.n_soft) = page_id, brute(url, rules)


def test_whole_table_against_brute_force(spark):
    from riverbend.llm.queries import op11_url_filter
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    assert rows(op11_url_filter(spark, "/root/testdata/sf0.001").collect()) == rows([url_row(p.page_id, p.url) for p in pages])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["porn", "xxx", "x", "xx", "free", "bet", "bets", "-", ".", "/", "%", "é", "A", "FREE", "1", "%2d"]), max_size=12).map("".join))
def test_automaton_against_each_term(url):
    terms = Vocabulary(tuple(sorted(url_filter.VOCABULARY.items())), url_filter.LIMIT)
    assert terms.hits(url)[:2] == brute_terms(url)


def test_one_strict_or_two_different_soft_terms(spark):
    urls = ["http://a.com/xxx", "http://a.com/free/free/FREE", "http://a.com/free/cheap", "http://a.com/freedom-cheaply", "http://a.com/x"]
    found = url_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)), PAGES)).orderBy("page_id").collect()
    assert [r.verdict for r in found] == ["block", "allow", "block", "allow", "allow"]


def test_weights_and_empty_vocabulary(spark):
    pages = spark.createDataFrame([(1, "http://a.com/Oak-elm-fir")], PAGES)
    judge = lambda words, limit: url_filter.judge_urls(pages, (), words, limit).first()
    assert judge({"OAK": 1, "elm": 1, "fir": 1}, 3).verdict == "block"
    assert judge({"oak": 1, "elm": 1, "ash": 1}, 3).verdict == "allow"
    assert judge({"oak-elm": 3}, 3)[-2:] == (1, 0)
    assert judge({}, 1).verdict == "allow"
    with pytest.raises(ValueError):
        judge({"": 1}, 1)


def test_longest_rule_and_ties(spark):
    rules = [Rule("allow", "b.com", "/x"), Rule("block", "a.b.com", "/"), Rule("block", "com", "/x/yy"), Rule("allow", "com", "/x/yy"), Rule("block", "a.b.com", "")]
    urls = ["http://a.b.com/x", "http://a.b.com/x/yy", "http://a.b.com", "http://b.com/x/yy", "http://c.com/x/yy", "http://com/x/"]
    pages = spark.createDataFrame(list(enumerate(urls)), PAGES)
    assert rows(url_filter.judge_urls(pages, rules).collect()) == rows([url_row(i, u, rules) for i, u in enumerate(urls)])


def test_repeated_rows_null_ids_empty_table(spark):
    pages = spark.createDataFrame([(None, "http://a.net/"), (None, "http://a.net/"), (3, None)], PAGES)
    assert rows(url_filter.judge_urls(pages).collect()) == rows([url_row(None, "http://a.net/")] * 2 + [url_row(3, None)])
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_allowed_keeps_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.com/xxx"), (2, "http://a.com/a"), (2, "http://a.com/a"), (3, None)], PAGES)
    pages = pages.selectExpr("page_id", "url", "1 AS host", "2 AS path", "3 AS hits", "4 AS rule", "5 AS verdict", "6 AS weight", "7 AS found")
    assert sorted(url_filter.allowed(pages).collect(), key=str) == sorted(pages.where("page_id > 1").collect(), key=str)
    assert url_filter.judge_urls(pages).where(F.col("verdict") == "block").count() == 1
