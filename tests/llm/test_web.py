"""Archives and URL filters against SQL and plain versions."""

import hashlib

import duckdb
import pandas as pd
import pytest

from shroud.llm import url_filter, warc
from tests.support import duck_rows, spark_rows

LONG = "ä" * 600
PAGES = [
    (1, "http://A.example.net:8080/x?q=1#f", LONG), (2, "https://b.example.net/en/y", LONG), (3, None, None), (4, "nowhere", ""), (5, "http://u@b.org/ a\tb", LONG + "!"), (6, "http://b.org", "short"), (7, "http://b.org", "short"),
    (8, "http://b.org", LONG), (None, "http://b.org", LONG), (9, "http://c.com/z", '<LINK rel="canonical" href="http://bad.net/z?a=1&amp;b=2">'), (10, "http://d.com/q", "<meta http-equiv='Refresh' content='0; url=//c.com/z'>"),
    (11, "http://e.com/a/b", "<link href=c rel=canonical>"), (12, "http://e.com/a/c?", "x"), (13, "http://f.com/k", '<link rel=canonical href="http://www.example.net/en/ok"><link rel="canonical" href="http://bad.net/k">'), (14, "https://bad.net/z?a=1&b=2#top", "p"), (15, "http://x.example.com/de/1", "q"), (16, "HTTP://ORG/fr/", "r"), (4, "nowhere", ""),
]


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, verdict string, key string").repartition(3)


@pytest.mark.parametrize("url,key", [(None, ""), ("x y", "x%20y"), ("http://A.b.C/p?q#f", "c,b,a)/p?q"), ("http://u:p@h.org:80", "org,h:80)/"), ("s://h?x/y", "h)/?x/y"), ("s:///p", ")/p")])
def test_keys(url, key):
    assert warc.capture_key(url) == key


def test_records_read_back():
    member = warc.record(7, "http://x/\r\nEvil: 1", b"pay\r\n\r\nload", hashlib.sha1(b"pay\r\n\r\nload").hexdigest(), None)
    assert warc.read_record(member) == {"payload_bytes": 11, "payload_digest": hashlib.sha1(b"pay\r\n\r\nload").hexdigest(), "record_type": "response", "refers_to": None}
    with pytest.raises(ValueError):
        warc.read_record(warc.record(7, "u", b"other", "0" * 40, None))


@pytest.mark.parametrize("lines", [1, 3, 512])
def test_archive_against_sql(spark, tmp_path, monkeypatch, lines):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    got = warc.archive_and_read(spark, frame(spark), str(tmp_path / "w")).collect()
    rows = [r for r in PAGES if r[0] is not None]
    pages = pd.DataFrame(rows, columns=["page_id", "url", "html"])  # noqa: F841  DuckDB reads it
    want = {tuple(r) for r in duckdb.sql(warc.SQL).fetchall()}
    assert {tuple(r) for r in got if r.page_id is not None} == want
    assert sorted(r.page_id for r in got if r.page_id is not None) == sorted(r[0] for r in rows)
    (no_id,) = [r for r in got if r.page_id is None]
    assert (no_id.record_type, no_id.refers_to, no_id.payload_bytes) == ("response", None, 1200)


def test_many_captures_of_one_url(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    rows = [(i, f"http://h{i % 3}.org/", "" if i % 2 else LONG) for i in range(300)]
    got = warc.archive_and_read(spark, frame(spark, rows), str(tmp_path / "w")).collect()
    assert sorted(r.page_id for r in got) == list(range(300))
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {298}
    files = sorted((r.key, r.page, r.file) for r in spark.read.parquet(str(tmp_path / "w/files")).collect())
    index = warc.Index(str(tmp_path / "w"), files)
    assert list(index.captures("org,h1)/", 5)) == [] and len(list(index.captures("org,h2)/", 5))) == 1 and list(index.captures("zzz", 1)) == []


def test_verdicts_against_sql(spark, tmp_path):
    got = spark_rows(url_filter.judge(frame(spark), url_filter.RULES, str(tmp_path / "f")))
    pages = pd.DataFrame(PAGES, columns=["page_id", "url", "html"]).astype({"page_id": "Int64"})
    connection = duckdb.connect()
    connection.register("pages", pages)
    want = duck_rows(connection, url_filter.SQL)
    assert got == want
    assert got[0] == ["host", "page_id", "path", "rule", "verdict"]
    verdict = {r[1]: r[4] for r in got[1]}
    assert {k: verdict[k] for k in ("9", "10", "13", "14", "12", "3", "16")} == {"9": "block", "10": "block", "13": "allow", "14": "block", "12": "allow", "3": "allow", "16": "allow"}


def test_rules_as_a_table(spark, tmp_path):
    table = spark.createDataFrame(url_filter.RULES, "verdict string, host string, path string")
    got = spark_rows(url_filter.judge(frame(spark), table, str(tmp_path / "a")))
    assert got == spark_rows(url_filter.judge(frame(spark), url_filter.RULES, str(tmp_path / "b")))
    assert got == spark_rows(url_filter.judge(frame(spark), url_filter.RULES * 200, str(tmp_path / "c")))


def test_very_long_pages_and_repeated_ids(spark, tmp_path):
    long = "<p>" + "word " * 400_000 + '<link rel="canonical" href="http://bad.net/z">'
    rows = [(1, "http://c.com/z", long), (1, "http://c.com/z", long), (1, "http://c.com/y", long), (2, "http://d.com/", "x" * 1000)]
    got = [(r.page_id, r.verdict) for r in url_filter.judge(frame(spark, rows), url_filter.RULES, str(tmp_path / "f")).collect()]
    assert sorted(got) == [(1, "block"), (1, "block"), (1, "block"), (2, "allow")]
    read = warc.archive_and_read(spark, frame(spark, [(1, "http://c.com/z", long), (2, "http://c.com/z", long), (3, None, "x" * 1000), (3, None, "x" * 1000)]), str(tmp_path / "w")).collect()
    assert {(r.page_id, r.record_type, r.refers_to) for r in read} == {(1, "revisit", 2), (2, "response", None), (3, "response", None)} and len(read) == 4


def test_redirect_table_and_rules(spark, tmp_path):
    rows = [(1, "http://start.com/a", None), (2, "http://other.com/", None), (3, "http://sub.a.net/p", None), (4, "http://xa.net/p", None)]
    redirects = spark.createDataFrame([("http://start.com/a", "http://mid.com/b"), ("https://mid.com/b#x", "http://evil.net/")], "source string, target string")
    rules = [("block", "evil.net", "/"), ("allow", "a.net", "/p"), ("block", "a.net", "/p")]
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(frame(spark, rows), rules, str(tmp_path / "f"), redirects).collect()}
    assert got == {1: (None, "block"), 2: (None, "allow"), 3: ("a.net/p", "allow"), 4: (None, "allow")}


def test_empty_tables(spark, tmp_path):
    none = frame(spark).limit(0)
    assert warc.archive_and_read(spark, none, str(tmp_path / "w")).collect() == []
    assert url_filter.judge(none, url_filter.RULES, str(tmp_path / "f")).collect() == []


def test_rules_of_equal_length_in_both_forms(spark):
    """A list and a table of rules report the same one: an allow first, then the greater as text."""
    rules = [("block", "a.net", "/x"), ("block", "net", "/xab"), ("allow", "b.net", "/y"), ("block", "net", "/yab")]
    rows = spark.createDataFrame([("a.net", "/xab"), ("b.net", "/yab"), ("c.org", "/")], "host string, path string")
    shown = lambda given: sorted((r.host, r.found and tuple(r.found)) for r in url_filter.with_rules(rows, given).collect())
    for order in (rules, rules[::-1]):
        assert shown(order) == shown(spark.createDataFrame(order, "verdict string, host string, path string")) == [("a.net", ("block", "net/xab")), ("b.net", ("allow", "b.net/y")), ("c.org", None)]
