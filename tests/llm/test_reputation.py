import duckdb
import pandas as pd

from wayflux.llm.queries import URL_RULES, op8_url_filter, oracle_sql
from wayflux.llm.reputation import Reputation, Rule, host_reputation, url_verdicts


def test_all_pages_against_sql(spark, sf_dir):
    duck = duckdb.connect()
    for name in ("pages", "labels"):
        duck.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    wanted = duck.execute(oracle_sql()["op8_url_filter"]).df().sort_values("page_id").reset_index(drop=True)
    got = op8_url_filter(spark, sf_dir).toPandas().sort_values("page_id").reset_index(drop=True)
    exact = ["page_id", "host", "path", "rule", "verdict"]
    assert got[exact].fillna("-").equals(wanted[exact].fillna("-"))
    pd.testing.assert_frame_equal(got[["mean", "lower"]], wanted[["mean", "lower"]], rtol=1e-9)


def pages(spark, urls):
    return spark.createDataFrame([(k, u, "junk") for k, u in enumerate(urls)], "page_id bigint, url string, host string")


def test_rules_and_hosts(spark):
    urls = ["http://A.Example.org/es/1", "https://example.org/en/12?x=/y", "https://notexample.org/es/1", "http://example.org",
            "http://b.com/fr/x#y", "http://com/de/", "http://b.com/de", None, "no scheme", "x://", "http://h?/p://q/r", "a://b://c/d"]
    rows = url_verdicts(pages(spark, urls), spark.createDataFrame([], "page_id bigint, bad int"), URL_RULES).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("notexample.org", "/es/1", "org/", "allow"), ("example.org", "", None, "allow"),
        ("b.com", "/fr/x", "com/fr/", "allow"), ("com", "/de/", "com/de/", "block"), ("b.com", "/de", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("h", "", None, "allow"), ("b:", "//c/d", None, "allow")]


def test_shrinkage(spark):
    urls, bad = [], []
    for site, n, rate in (("bad", 60, 0.95), ("good", 60, 0.05), ("fair", 60, 0.1)):
        for k in range(n):
            bad.append((len(urls), int(k < n * rate)))
            urls.append(f"http://www.{site}.net/{k}")
    for site in ("bad", "good"):  # one page each, without and with an outcome
        urls.append(f"http://new.{site}.net/")
        bad.append((len(urls), 1))
        urls.append(f"http://one.{site}.net/")
    frame = pages(spark, urls)
    outcomes = spark.createDataFrame([*bad, (None, 1), (5, None), (10**6, 1)], "page_id bigint, bad int")
    found = {r.host: r for r in host_reputation(frame, outcomes).collect()}
    assert found["new.bad.net"].mean > 0.6 and found["new.good.net"].mean < 0.3
    assert found["one.bad.net"].mean > found["new.bad.net"].mean
    assert 0.9 < found["www.bad.net"].mean < 0.97
    verdict = {r.host: r.verdict for r in url_verdicts(frame, outcomes).collect()}
    assert verdict["www.bad.net"] == "block" and verdict["one.good.net"] == "allow" and verdict["www.fair.net"] == "allow"
    assert url_verdicts(frame.limit(0), outcomes).count() == 0
    rule = (Rule("allow", "bad.net", "/"),)
    assert {r.verdict for r in url_verdicts(frame, outcomes, rule, Reputation()).where("host = 'www.bad.net'").collect()} == {"allow"}


def test_very_long_addresses(spark):
    host, path = "a." * 20_000 + "example.org", "/es/" + "x" * 100_000
    urls = [f"http://{host}{path}?{'q' * 100_000}", "http://" + "b" * 100_000, "http://c.net/" + "/" * 100_000 + "#" + "z" * 100_000]
    rows = url_verdicts(pages(spark, urls), spark.createDataFrame([], "page_id bigint, bad int"), URL_RULES).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [
        (host, path, "example.org/es/", "block"), ("b" * 100_000, "", None, "allow"), ("c.net", "/" + "/" * 100_000, None, "allow")]
