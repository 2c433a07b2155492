import os

import duckdb
from pavilion.llm import queries, url_filter

ROWS = [
    (1, None), (2, ""), (3, "no scheme/net"), (4, "http://net/"), (5, "http://NET"), (6, "https://a.b.Example.NET/en/x?y#z"), (7, "https://example.net/de/"),
    (8, "http://example.com/de/"), (9, "http://notexample.com/de/"), (10, "http://x.org/fr/1"), (11, "http://x.org/fr"), (12, "http://spam-farm.io/a"),
    (12, "http://spam-farm.io/a"), (13, "http://spamfarm.io/spam/farm"), (14, "http://a.com/x.exe?y"), (15, "http://a.com/x?q=://b.net/"),
    (16, "http://a.com?utm_medium=cpc&x"), (17, "a://b://c.net/"), (18, "http://org/fr/\nx"), (None, "http://www.ads-track.com/"), (19, "://"),
]


def as_rows(frame, columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)


def test_against_sql(spark, sf_dir):
    columns = ["page_id", "url", "host", "path", "rule", "verdict", "pattern"]
    small = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, token string")
    con = duckdb.connect()
    con.sql("create table pages (page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", ROWS)
    want = con.sql(f"select {', '.join(columns)} from ({queries.oracle_sql()['op3_url_filter']})").fetchall()
    assert as_rows(url_filter.judge(small), columns) == sorted(want, key=str)
    con.sql("drop table pages")
    con.sql(f"create view pages as select * from '{os.path.join(sf_dir, 'pages.parquet')}'")
    want = con.sql(f"select {', '.join(columns)} from ({queries.oracle_sql()['op3_url_filter']})").fetchall()
    assert as_rows(url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet")), columns) == sorted(want, key=str)


def test_rules(spark):
    small = spark.createDataFrame(ROWS, "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(small).collect()}
    assert (got[6].host, got[6].path, got[6].rule, got[6].verdict) == ("a.b.example.net", "/en/x", "example.net/en/", "allow")
    assert (got[7].rule, got[7].verdict) == ("net/", "block") and got[5].rule is None
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("", "", None, "allow")
    assert got[12].verdict == got[14].verdict == got[16].verdict == got[None].verdict == "block" and got[13].verdict == "allow"


def test_rules_are_kept_under_their_rarest_token(spark):
    urls = spark.createDataFrame([(["spam", "http"],), (["spam"],), (["farm", ""],)], "__tokens array<string>")
    rules = (("spam.*farm", ("spam", "farm"), "block"), ("x", (), "allow"), ("new", ("new",), "block"))
    got = {r.pattern: r.token for r in url_filter.rule_index(urls, rules).collect()}
    assert got == {"spam.*farm": "farm", "x": url_filter.ANY, "new": "new"}


def test_allow_goes_first_and_any_token_rules_run(spark):
    rules = (("track", (), "block"), ("track.*/ok", ("ok",), "allow"))
    pages = spark.createDataFrame([(1, "http://track.a/ok"), (2, "http://track.a/no"), (3, None)], "page_id long, url string")
    got = {r.page_id: (r.verdict, r.pattern) for r in url_filter.judge(pages, (), rules).collect()}
    assert got == {1: ("allow", "track.*/ok"), 2: ("block", "track"), 3: ("allow", None)}
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_longer_tokens(spark):
    urls = ["http://a.com/wp-login.php5", "http://a.com/xmlrpc.php7?x", "http://a.com/wp-login.php", "http://a.com/login.php5"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages).collect()}
    assert got == {0: "block", 1: "block", 2: "block", 3: "allow"}
