"""WARC round trips and URL reputation."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tests.oracle_check import compare
from trailmart.llm import url_reputation, warc
from trailmart.llm.queries import URL_RULES
from trailmart.session import fresh_path

PAGES = "page_id bigint, url string, html string"
MESSY = [
    (3, "http://a.example.com/x?y", "<p>same</p>"), (1, "http://b.example.net", "<p>same</p>"),
    (2, None, "<p>same</p>"), (1, "http://b.example.net", "<p>same</p>"), (4, "no scheme", None),
    (5, "HTTP://C.Example.ORG#top", ""), (None, "x://", "<p>same</p>"), (None, None, None),
    (6, "http://d.example.com/de/1", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" + "ü🙂" * 9_000),
    (7, "http://x.co.uk/\r\nInjected: 1", "line\r\n\r\n\r\nline"),
]


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(MESSY, PAGES).repartition(3)
    return df.selectExpr("*", "'mine' AS digest", "'mine' AS host", "'mine' AS payload")


@pytest.mark.parametrize("min_bytes", [0, 5])
@pytest.mark.parametrize("broadcast_payloads", [0, 100])
def test_round_trip(pages, min_bytes, broadcast_payloads, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", broadcast_payloads)
    want = []
    for page_id, _, html in MESSY:
        payload = (html or "").encode()
        same = [p for p, _, h in MESSY if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        revisit = len(payload) >= min_bytes and first != page_id
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind = "revisit" if revisit else "response"
        want.append((page_id, len(payload), digest, kind, first if revisit else None))
    rows = warc.round_trip(pages, min_bytes).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))


def test_an_empty_table_gives_no_captures(pages):
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_captures_are_nested_and_hold_the_payload(spark, pages):
    folder = fresh_path(spark, "warc")
    warc.write_archives(pages, folder)
    rows = warc.captures(warc.read_records(spark, folder)).collect()
    assert len(rows) == len(MESSY)
    by_page = {r["metadata"]["page_id"]: r for r in rows}
    assert bytes(by_page[6]["response"]["payload"]).decode() == MESSY[8][2]
    assert by_page[3]["response"]["record_type"] == "revisit"
    assert by_page[3]["response"]["payload"] is None
    assert by_page[3]["request"]["target_uri"] == "http://a.example.com/x?y"
    assert "injected" not in by_page[7]["response"]["headers"]


def test_records_of_single_gzip_members_and_plain_files(spark, tmp_path):
    record = (
        b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:%d>\r\n"
        b"Content-Length: 26\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody %02d\r\n\r\n\r\n"
    )
    records = [record % (n, n) for n in range(30)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "b.warc").write_bytes(b"".join(records))
    rows = warc.read_records(spark, str(tmp_path)).collect()
    assert sorted(bytes(r["payload"])[:7] for r in rows) == sorted(2 * [b"body %02d" % n for n in range(30)])
    alone = warc.captures(warc.read_records(spark, str(tmp_path)))
    assert alone.filter("request IS NULL AND metadata IS NULL").count() == 60


def test_base32_equals_the_library(spark):
    texts = ["", "a", "ü🙂", "x" * 5_000]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for text, found in rows.select("t", warc.base32_sha1(F.col("t"))).collect():
        assert found == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_host_path_and_rules(spark):
    cases = {
        "http://A.Example.COM/De/x?q#f": ("a.example.com", "/De/x", None),
        "https://example.com/de/": ("example.com", "/de/", "example.com/de/"),
        "https://badexample.com/de/": ("badexample.com", "/de/", None),
        "http://x.example.net/en/1": ("x.example.net", "/en/1", "example.net/en/"),
        "http://x.example.net/e": ("x.example.net", "/e", "net/"),
        "http://x.example.net?a/b": ("x.example.net", "", None),
        "http://org/fr/": ("org", "/fr/", "org/fr/"),
        "no scheme/fr/": ("", "", None),
        "http://": ("", "", None),
        None: ("", "", None),
        "a://ÄB.org/fr/://net/": ("Äb.org", "/fr/://net/", "org/fr/"),
    }
    pages = spark.createDataFrame([(n, url, "") for n, url in enumerate(cases)], PAGES)
    rows = url_reputation.ruled(url_reputation.located(pages), URL_RULES).collect()
    found = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in rows}
    assert [found[n] for n in range(len(cases))] == list(cases.values())


def test_reputation_shrinks_towards_parents(spark):
    outcomes = [("bad.x.com", 1)] * 40 + [("good.x.com", 0)] * 40 + [("new.x.com", None)]
    outcomes += [("one.y.com", 1), ("z.co.uk", 0), ("w.z.co.uk", 1), ("", None)]
    known = spark.createDataFrame(outcomes, "host string, bad int")
    rows = {r["host"]: r for r in url_reputation.reputations(known).collect()}
    assert rows["bad.x.com"]["bound"] > 0.9 and rows["good.x.com"]["mean"] < 0.1
    assert 0.2 < rows["new.x.com"]["mean"] < 0.8
    assert rows["one.y.com"]["bound"] < rows["bad.x.com"]["bound"]
    assert all(math.isfinite(r["bound"]) for r in rows.values())


def test_domains(spark):
    hosts = spark.createDataFrame([(h,) for h in ("a.b.co.uk", "co.uk", "b.com", "com", "")], "host string")
    rows = url_reputation.with_domains(hosts).collect()
    assert [(r["domain"], r["suffix"]) for r in rows] == [
        ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("b.com", "com"), ("com", "com"), ("", ""),
    ]


def test_names_are_cut_from_hosts(spark):
    cases = {
        "user:pass@www.a.example.com:8080": ("example.com", "com"),
        "example.com.": ("example.com", "com"),
        "10.0.0.1": ("10.0.0.1", "[address]"),
        "10.0.0.1:80": ("10.0.0.1", "[address]"),
        "[::1]:443": ("[::1]", "[address]"),
        "www.service.gov.uk": ("service.gov.uk", "gov.uk"),
        "a.b.com.br": ("b.com.br", "com.br"),
        "x.co.example": ("co.example", "example"),
        ":80": ("", ""),
        "...": ("", ""),
    }
    hosts = spark.createDataFrame([(host,) for host in cases], "host string")
    rows = {r["host"]: (r["domain"], r["suffix"]) for r in url_reputation.with_domains(hosts).collect()}
    assert rows == cases
    own = url_reputation.with_domains(hosts, ("b",)).filter("host = 'a.b.com.br'").first()
    assert (own["domain"], own["suffix"]) == ("com.br", "br")


def test_clean_pages_lower_the_bound_of_their_host(spark):
    def of(host, de, en):
        return [f"http://{host}/de/{n}" for n in range(de)] + [f"http://{host}/en/{n}" for n in range(en)]

    urls = [*of("bad.example.com", 60, 5), *of("clean.example.com", 1, 64), *of("new.example.com", 0, 1)]
    urls += ["http://10.0.0.1/en/", "http://other.com/en/"]
    given = spark.createDataFrame([(n, u, None) for n, u in enumerate(urls)], PAGES)
    found = url_reputation.judged(given, URL_RULES).filter("rule IS NULL")
    verdicts = {(r["host"], r["verdict"]) for r in found.collect()}
    assert {("bad.example.com", "block"), ("clean.example.com", "allow")} <= verdicts
    assert len(verdicts) == 5, "one verdict a host"
    strict = url_reputation.judged(given, URL_RULES, least_blocked=0.99).filter("rule IS NULL")
    assert strict.filter("verdict = 'block'").isEmpty()


def test_messy_pages_equal_their_sql(pages):
    import duckdb

    odd = ["http://u@10.0.0.1:80/", "http://10.0.0.1/x", "http://[::1]:8/", "http://a.gov.uk./de/"]
    odd += ["http://example.com/de/1", "http://u:p@example.com:8080/en/"]
    spark = pages.sparkSession
    rows = [(int(n), u, None) for n, u in enumerate(odd, 100)]
    with_odd = pages.select("page_id", "url", "html").union(spark.createDataFrame(rows, PAGES))
    for rows in (pages, with_odd, pages.limit(0)):
        found = url_reputation.judged(rows, URL_RULES)
        connection = duckdb.connect()
        connection.register("given", rows.select("page_id", "url").toArrow())
        connection.execute("CREATE TABLE pages AS SELECT * FROM given")
        sql = connection.sql(url_reputation.oracle(URL_RULES))
        assert compare(found.collect(), found.columns, sql) is None
