import duckdb
from compare import difference

from tillview.llm.queries import ORACLE, REGISTRY, URL_RULES
from tillview.llm.url_rules import Rule, build, find, judge, judge_joined

URLS = [
    (1, None, None, None),
    (2, "", None, "allow"),
    (3, "no scheme.org/x", None, "allow"),
    (4, "http://ORG/x", "org/", "allow"),
    (5, "http://a.example.org/es/1", "example.org/es/", "block"),
    (6, "http://example.org/es", "org/", "allow"),
    (7, "https://example.org/en/196?x=/es/", "example.org/en/1", "block"),
    (8, "https://notexample.org/en/1", "org/", "allow"),
    (9, "https://x.com/de/", "com/de/", "block"),
    (10, "https://x.com#/de/", None, "allow"),
    (11, "https://x.com/fr/http://y.org/", "com/fr/", "allow"),
    (12, "https://x.org", None, "allow"),
    (13, "ftp://" + "a." * 5000 + "org/" + "p/" * 5000, "org/", "allow"),
    (13, "https://x.com/de/", "com/de/", "block"),
]


def table(spark):
    rows = [(i, u, "h", "r", "mine", "v", "too") for i, u, _, _ in URLS]
    return spark.createDataFrame(rows, "page_id long, url string, host string, rule string, _found string, verdict string, found string")


def test_edges_in_both_ways(spark):
    pages = table(spark)
    listed = spark.createDataFrame([(r.host, r.path, r.verdict) for r in URL_RULES], "host string, path string, verdict string")
    want = sorted((i, r or "", v or "allow") for i, _, r, v in URLS)
    for judged in (judge(pages, URL_RULES), judge_joined(pages, listed)):
        assert sorted((r.page_id, r.rule or "", r.verdict) for r in judged.collect()) == want
        assert judged.where("host is null or path is null").count() == 0
        assert judged.columns == ["page_id", "url", "_found", "found", "host", "path", "rule", "verdict"]
        assert judged.select("_found", "found").distinct().collect() == [("mine", "too")]


def test_longest_rule_wins_and_block_at_a_tie():
    rules = [Rule("org", "/a/b", "allow"), Rule("x.org", "/", "block"), Rule("org", "/a/bc/d", "block"), Rule("org", "/a/b", "block")]
    trie = build(rules)
    assert find(trie, "x.org", "/a/bc/d") == ("x.org/", "block")
    assert find(trie, "y.org", "/a/bc/de") == ("org/a/bc/d", "block")
    assert find(trie, "y.org", "/a/bx") == ("org/a/b", "block")
    assert find(trie, "y.org", "/a") == (None, None)


def test_empty_tables_and_no_rules(spark):
    pages = table(spark)
    assert judge(pages.where("false"), URL_RULES).count() == 0
    assert judge(pages, []).where("rule is null and verdict = 'allow'").count() == len(URLS)
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert judge_joined(pages, none).where("rule is null").count() == len(URLS)


def test_query_matches_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{small}/pages.parquet'")
    assert difference(REGISTRY["op3_url_filter"](spark, small), con, ORACLE["op3_url_filter"]) == ""
