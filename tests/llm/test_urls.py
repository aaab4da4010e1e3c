import random
import re

from helpers import clashing, frame, lower, rows_of

from tidemark.llm import urls

SCHEMA = "page_id bigint, url string, html string"
RULES = "host string, path string, verdict string"


def brute(pages, rules, default="allow"):
    out = []
    best_of = {}
    for h, p, v in rules:
        if h:
            k = (lower(h), p or "")
            best_of[k] = max(v, best_of.get(k, v))
    for i, u, *_ in pages:
        rest = (u or "").partition("://")[2] if "://" in (u or "") else ""
        host = lower(re.split(r"[/?#]", rest, maxsplit=1)[0])
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        fit = [(len(h + p), len(h), h + p, v) for (h, p), v in best_of.items() if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
        top = max(fit, default=None)
        out.append((i, host, path, top and top[2], top[3] if top else default))
    return sorted(out, key=repr)


def some_urls(seed=2):
    rng = random.Random(seed)
    hosts = ["example.com", "www.example.com", "WWW.Example.COM", "a.www.example.com", "notexample.com", "com", "net", "x.net", "xn.org", "community", "com.", ".com", "a..b.net", ""]
    paths = ["", "/", "/en", "/en/", "/en/a/b", "/es/x", "/fr/", "/EN/", "/en/?q=/fr/", "?x=/en/", "#/en/", "/es/#://y.com/en/", "/%20 é"]
    out = [(k, f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}", None) for k in range(400)]
    return out + [(900, None, None), (901, "", None), (902, "no scheme/en/", None), (None, "http://x.com/en/", ""), (903, "http://x.com/" + "en/" * 20_000, None), (903, "http://x.com/", None), (903, "http://x.com/", None)]


def test_contract_rules_match_brute_force(spark):
    pages = some_urls()
    df = clashing(frame(spark, pages, SCHEMA), "host", "path", "rule", "verdict", "rev", "key", "piece").repartition(4)
    rules = spark.createDataFrame(list(urls.RULES), RULES)
    assert rows_of(urls.judge_urls(df, rules)) == brute(pages, urls.RULES)


def test_many_nested_rules(spark):
    rng = random.Random(7)
    hosts = ["com", "example.com", "www.example.com", "net", "a..b.net", None, ""]
    paths = ["/", "/e", "/en", "/en/", "/en/a", "/en/a/b", "/es/", "", None, "/é"]
    rules = [(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(60)]
    pages = some_urls(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows_of(urls.judge_urls(frame(spark, pages, SCHEMA), spark.createDataFrame(rules, RULES), default="block"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute(pages, rules, "block")


def test_empty_tables(spark):
    rules = spark.createDataFrame(list(urls.RULES), RULES)
    assert urls.judge_urls(frame(spark, [], SCHEMA), rules).collect() == []
    pages = some_urls()[:30]
    assert rows_of(urls.judge_urls(frame(spark, pages, SCHEMA), rules.limit(0))) == brute(pages, [])


def test_no_python_in_the_plan(spark):
    rules = spark.createDataFrame(list(urls.RULES), RULES)
    plan = urls.judge_urls(frame(spark, some_urls()[:20], SCHEMA), rules)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))
