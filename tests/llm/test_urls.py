import random

import pytest
from pyspark.sql import types as T

from rosterflow.llm import url_rules
from rosterflow.llm.url_rules import judge_urls

RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"), ("a.com", "/b", "allow"), ("com", "/b/cc", "block"), ("b.a.com", "", "block"), ("EXAMPLE.net", "/Up", "block"),
    ("tie.com", "/x", "allow"), ("tie.com", "/x", "block"), ("net", "/ü/", "block"),
]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plainly(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = ""
    for c in rest:
        if c in "/?#":
            break
        host += c
    path = ""
    for c in rest[len(host) :]:
        if c in "?#":
            break
        path += c
    host = lowered(host)
    best = None
    for rule_host, rule_path, verdict in rules:
        rule_host = lowered(rule_host)
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            found = (len(rule_host) + len(rule_path), len(rule_host), verdict == "block", rule_host + rule_path, verdict)
            best = max(best, found) if best else found
    return host, path, best[3] if best else None, best[4] if best else default


def urls():
    r = random.Random(5)
    made = [None, "", "no scheme", "://", "http://", "http:///es/", "http://org/", "http://org", "x://y://example.org/es/", "http://EXAMPLE.ORG/es/q?a#b",
            "http://www.example.org/ES/", "http://notexample.org/es/", "http://example.org./es/", "http://example.org:80/es/", "http://u@example.org/en/123",
            "http://a.b.a.com/b/cc", "http://a.com/b/cc", "http://c.a.com/b/cc", "http://tie.com/x", "http://www.example.net/Upper", "http://x.net/ü/1",
            "http://\nexample.org/en/1\n", "http://" + "a." * 300_000 + "example.org/es/" + "p" * 500_000, "http://.org/"]
    for _ in range(400):
        host = ".".join(r.choice(["a", "b", "www", "example", "com", "org", "net"]) for _ in range(r.randrange(1, 5)))
        made.append(f"http://{host}" + "".join(r.choice(["/", "es/", "en/1", "fr/", "/de/", "b", "/cc", "?q", "#f"]) for _ in range(r.randrange(5))))
    return made + made[:30]


@pytest.mark.parametrize("broadcast", [True, False])
def test_rules_against_plain_python(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(url_rules, "BROADCAST_RULES", 0)
    made = urls()
    schema = "page_id long, url string, Host string, `a.b ``c``` string, verdict int, _row string"
    frame = spark.createDataFrame([(i if i % 7 else None, u, "h", "x", 1, "r") for i, u in enumerate(made)], schema)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = judge_urls(frame, rules, default="block")
    assert judged.columns == ["page_id", "url", "a.b `c`", "_row", "host", "path", "rule", "verdict"]
    got = sorted([(r["page_id"], r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in judged.collect()], key=repr)
    want = sorted([(i if i % 7 else None, u, *plainly(u, RULES, "block")) for i, u in enumerate(made)], key=repr)
    assert got == want


def test_no_rows_and_no_rules(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    none = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(none, rules).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert tuple(judge_urls(one, rules.limit(0)).first()) == (1, "http://a.org/", "a.org", "/", None, "allow")


@pytest.mark.parametrize("rule", [(None, "/", "block"), ("", "/", "block"), ("a", None, "block"), ("a", "/", "Block"), ("a", "/", None)])
def test_unsound_rules(spark, rule):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("host", "path", "verdict")])
    with pytest.raises(ValueError, match="each rule needs"):
        judge_urls(spark.createDataFrame([("http://a/",)], "url string"), spark.createDataFrame([rule], schema))


def test_nothing_is_paired_or_brought_together(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    frame = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    plan = judge_urls(frame, rules)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and plan.count("Exchange hashpartitioning(_number") >= 1
