import itertools
import re

from pyspark.sql import functions as F

from cvelake.llm import url_rules
from cvelake.llm.queries import QUERIES
from helpers_llm import SF

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule_of(host, path):
    fits = []
    for rule in RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(rule)
    return max(fits, key=len, default=None)


URLS = [None, "", "no scheme/x", "http://A.Example.NET/en/1", "http://example.net", "http://notexample.net/en/", "https://x.net?/en/", "a://b://c.net/",
        "http://EXAMPLE.com/de/?x#y", "http://example.com/DE/", "http://É.org/fr/1\n2", "http://net/", "ftp://org/fr", "http://u@x.net:80/", "://example.net/en/#x"]


def test_hosts_and_fixed_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string").withColumn("host", F.lit("mine"))
    rows = url_rules.judge(df, url_rules.mine(df.select("url", F.lit(None).cast("boolean").alias("blocked")))).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        url = URLS[r["row"]["page_id"]]
        host, path = parts(url)
        rule = rule_of(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert r["verdict"] == (RULES[rule] if rule else "allow")


def test_query_judges_every_page(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op2_url_association_rules"](spark, SF).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        host, path = parts(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule_of(host, path))
        assert r["verdict"] in ("allow", "block") and (r["rule"] is None or r["verdict"] == RULES[r["rule"]])


def labelled():
    urls = []
    for i in range(60):
        urls.append((f"http://ads.example.org/win/{i}", True))
        urls.append((f"http://news.example.org/win/{i}.html?ref=x", i % 3 == 0))
        urls.append((f"http://ads.example.com/en/{i}", i % 10 == 0))
        urls.append((f"http://blog.example.com/en/{i}?page=1", False))
    return [*urls, (None, True), ("", False), ("http://ads.example.org/win/1", None)]


def test_mined_rules_match_brute_force(spark):
    df = spark.createDataFrame(labelled(), "url string, blocked boolean")
    tokens = df.select("blocked", url_rules.tokens_of(F.coalesce("url", F.lit(""))).alias("t")).collect()
    baskets = [(set(r["t"]), r["blocked"]) for r in tokens if r["blocked"] is not None and (r["t"] or r["blocked"])]
    sure = {}
    for size in (1, 2, 3, 4, 5, 6):
        names = {c for t, _ in baskets for c in itertools.combinations(sorted(t), size)}
        for c in names:
            uses = sum(t >= set(c) for t, _ in baskets)
            hits = sum(t >= set(c) and b for t, b in baskets)
            if hits >= 0.05 * len(baskets) and hits / uses >= 0.6:
                sure[c] = hits / uses
    kept = {c: v for c, v in sure.items() if not any(sure.get(c[:i] + c[i + 1 :], -1) >= v for i in range(len(c)) if len(c) > 1)}
    mined = url_rules.mine(df, 0.05, 0.6)
    got = {tuple(sorted(r["tokens"])): r["confidence"] for r in mined.collect()}
    assert set(got) == set(kept) and all(abs(got[c] - kept[c]) < 1e-9 for c in kept) and kept
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(labelled())], "page_id long, url string")
    own = {r["page_id"]: set(r["t"]) for r in pages.select("page_id", url_rules.tokens_of(F.coalesce("url", F.lit(""))).alias("t")).collect()}
    for r in url_rules.judge(pages, mined, rules={"nowhere.test/": "allow"}).collect():
        applies = [v for c, v in kept.items() if own[r["row"]["page_id"]] >= set(c)]
        assert r["verdict"] == ("block" if applies else "allow")
        assert r["confidence"] == (max(applies) if applies else None)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "url string, blocked boolean")
    rules = url_rules.mine(none)
    assert rules.count() == 0 and url_rules.judge(none.select("url"), rules).count() == 0
