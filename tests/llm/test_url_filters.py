"""Verdicts on addresses, next to SQL and by hand."""

from graphloom.llm import oracle_sql, queries
from graphloom.llm.url_filters import UrlRule, filter_urls, rules_frame, site_rule
from tests.compare import connect, spark_rows, sql_rows


def judged(spark, urls, rules):
    frame = spark.createDataFrame([(u, "own") for u in urls], "url string, rule string")
    return {r.url: (r.host, r.path, r["rule"], r.verdict) for r in filter_urls(frame, rules_frame(spark, rules)).collect()}


RULES = [site_rule("allow", "com"), site_rule("block", "example.com", "/en/"), site_rule("allow", "www.example.com", "/en/"), site_rule("block", "net", "/e")]


def test_query_gives_the_rows_of_its_sql(spark, folder):
    assert spark_rows(queries()["op1_url_filters"](spark, folder)) == sql_rows(connect(folder), oracle_sql()["op1_url_filters"])


def test_longest_rule_of_host_and_path(spark):
    found = judged(
        spark,
        ["http://EXAMPLE.com/en/1?q#x", "x://a.www.example.com/en/", "http://notexample.com/en/", "http://com/", "http://example.com", "http://a.net/es", "http://net#/e",
         "a://b://c.net/e", "no address", "http://É.COM/A?b", "http://a.com:80/", "http:///x", "", None],
        RULES,
    )
    assert found == {
        "http://EXAMPLE.com/en/1?q#x": ("example.com", "/en/1", "example.com/en/", "block"),
        "x://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://com/": ("com", "/", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://a.net/es": ("a.net", "/es", "net/e", "block"),
        "http://net#/e": ("net", "", None, "allow"),
        "a://b://c.net/e": ("b:", "//c.net/e", None, "allow"),
        "no address": ("", "", None, "allow"),
        "http://É.COM/A?b": ("É.com", "/A", "com/", "allow"),
        "http://a.com:80/": ("a.com:80", "/", None, "allow"),
        "http:///x": ("", "/x", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }


def test_patterns_without_tokens_ties_and_repeated_rows(spark):
    rules = [UrlRule("any/x", "allow", "/x$"), UrlRule("any/x", "block", "/x$"), UrlRule("zzz/x", "block", "/x$", ("h:a",))]
    frame = spark.createDataFrame([("http://a/x",), ("http://a/x",), ("http://b/x",), ("http://b/y",)], "url string")
    rows = sorted((r.host + r.path, r["rule"] or "", r.verdict) for r in filter_urls(frame, rules_frame(spark, rules), otherwise="keep").collect())
    assert rows == [("a/x", "zzz/x", "block")] * 2 + [("b/x", "any/x", "block"), ("b/y", "", "keep")]
    assert filter_urls(frame.limit(0), rules_frame(spark, rules)).collect() == []


def test_plan_has_no_python(spark, folder):
    plan = queries()["op1_url_filters"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_columns_of_any_name(spark):
    for change in (str, str.upper):
        names = [change(n) for n in ("host", "path", "rule", "verdict", "token", "pattern", "best", "long", "count")]
        frame = spark.createDataFrame([("http://example.com/en/x", *range(len(names)))], ["url", *names])
        found = filter_urls(frame, rules_frame(spark, RULES))
        assert sorted(c.lower() for c in found.columns) == sorted(["url", *(n.lower() for n in names)])
        row = found.first()
        assert (row["host"], row["path"], row["verdict"]) == ("example.com", "/en/x", "block")
        assert [row[n] for n in names[4:]] == list(range(4, len(names)))
