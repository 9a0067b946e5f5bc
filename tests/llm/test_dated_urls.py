from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import dated_urls as du
from corpusloom.llm.registry import op9_url_filters

CAPTURES = "capture_id bigint, url string, fetched timestamp"
ENTRIES = "list_name string, key string, action string, since timestamp"


@pytest.mark.parametrize("url,keys", [
    ("http://A.b.Example.com/x/y?q", [
        "a.b.example.com", "b.example.com", "example.com", "a.b.example.com/x", "b.example.com/x", "example.com/x",
        "a.b.example.com/x/y", "b.example.com/x/y", "example.com/x/y"]),
    ("http://example.com//X///y/#z", ["example.com", "example.com/X", "example.com/X/y"]),
    ("https://user:pw@example.com:8080", ["example.com"]), ("ftp://localhost/a", ["localhost", "localhost/a"]),
    ("http://example.com./?q=/z", ["example.com"]), ("no url", []), ("", []), (None, []), ("http:///x", []),
])
def test_keys(spark, url, keys):
    frame = spark.createDataFrame([(url,)], "url string").select(du.url_keys(F.col("url")).alias("k"))
    assert frame.first()["k"] == keys


@pytest.mark.parametrize("deepest,keys", [(0, ["x.org"]), (1, ["x.org", "x.org/a"]), (9, ["x.org", "x.org/a", "x.org/a/b"])])
def test_depth(spark, deepest, keys):
    frame = spark.createDataFrame([("http://x.org/a/b",)], "url string")
    assert frame.select(du.url_keys(F.col("url"), deepest)).first()[0] == keys


@pytest.mark.parametrize("key,wanted", [
    ("example.com", "example.com"), ("WWW.Example.COM.", "www.example.com"), ("example.com/a/b", "example.com/a/b"),
    ("example.com//A/", "example.com/A"), ("http://user@Example.com:8080/p/", "example.com/p"), ("*.example.com", "example.com"),
    (".example.com", "example.com"), ("//cdn.x.org/js", "cdn.x.org/js"), (" x.org ", "x.org"), ("[2001:DB8::1]/a", "[2001:db8::1]/a"),
    ("", None), ("/path", None), ("x.org/a?b=1", None), ("x.org#top", None), ("two words.org", None), ("a*b.org", None), (None, None),
])
def test_entry_keys(spark, key, wanted):
    frame = spark.createDataFrame([(key,)], "key string").select(du.entry_key(F.col("key")).alias("k"))
    assert frame.first()["k"] == wanted


def at(text):
    return datetime.fromisoformat(text)


def test_captures_meet_the_entries_of_their_time(spark):
    entries = spark.createDataFrame([
        ("l", "bad.com", "block", at("2024-01-10")), ("l", "bad.com", "remove", at("2024-03-05 12:00:00")),
        ("l", "bad.com", "block", at("2024-05-01")), ("l", "ok.bad.com", "allow", at("2024-01-01")),
        ("m", "bad.com", "block", at("2024-02-01")), ("m", "x.org/p", "block", at("2024-01-01")),
        ("m", "x.org/p", "allow", at("2024-01-01")), (None, "x.org", "block", at("2024-01-01")),
        ("m", None, "block", at("2024-01-01")), ("m", "x.org", None, at("2024-01-01")), ("m", "x.org", "block", None),
    ], ENTRIES)
    rows = [(1, "http://www.bad.com/", "2024-01-09"), (2, "http://www.bad.com/", "2024-01-10"),
            (3, "http://bad.com/", "2024-03-05 11:59:59"), (4, "http://bad.com/", "2024-03-05 12:00:00"),
            (5, "http://bad.com/", "2031-12-01"), (6, "http://a.ok.bad.com/", "2024-06-01"),
            (7, "http://x.org/p/q", "2024-06-01"), (8, "http://x.org/other", "2024-06-01"), (9, None, "2024-06-01"),
            (10, "http://bad.com/", None), (None, "http://bad.com/", "2024-01-20"), (2, "http://www.bad.com/", "2024-01-10")]
    captures = spark.createDataFrame([(i, u, t and at(t)) for i, u, t in rows], CAPTURES).withColumn("key", F.lit("z"))
    got = {tuple(r) for r in du.filter_captures(captures, entries).collect()}
    assert got == {
        (1, 0, None, None), (2, 1, "bad.com", "block"), (3, 2, "bad.com", "block"), (4, 1, "bad.com", "block"),
        (5, 2, "bad.com", "block"), (6, 3, "ok.bad.com", "allow"), (7, 1, "x.org/p", "block"), (8, 0, None, None),
        (9, 0, None, None), (10, 0, None, None), (None, 1, "bad.com", "block")}


def test_entries_on_longer_paths_and_in_other_forms(spark):
    captures = spark.createDataFrame([(1, "http://www.example.com/a/b/c", at("2024-02-01"))], CAPTURES)
    for key in ("example.com/a", "www.example.com/a/b", "WWW.Example.com", "http://example.com/a/b/c/", "*.example.com"):
        entries = spark.createDataFrame([("l", key, "block", at("2024-01-01"))], ENTRIES)
        got = du.filter_captures(captures, entries).first()
        assert (got["n_active"], got["verdict"]) == (1, "block"), key
        assert du.unusable_entries(entries).count() == 0
    entries = spark.createDataFrame([
        ("l", "example.com", "block", at("2024-01-01")), ("l", "EXAMPLE.com", "remove", at("2024-01-20")),
        ("l", "example.com/a/b", "allow", at("2024-01-01")), ("l", "example.com/a/x", "block", at("2024-01-01")),
        ("l", "what?", "block", at("2024-01-01")), ("l", "x.org", None, at("2024-01-01"))], ENTRIES)
    assert tuple(du.filter_captures(captures, entries).first()) == (1, 1, "example.com/a/b", "allow")
    assert sorted(r["key"] for r in du.unusable_entries(entries).collect()) == ["what?", "x.org"]


def test_empty_tables(spark):
    captures = spark.createDataFrame([(1, "http://a.com", at("2024-01-01"))], CAPTURES)
    none = spark.createDataFrame([], ENTRIES)
    assert [tuple(r) for r in du.filter_captures(captures, none).collect()] == [(1, 0, None, None)]
    assert du.filter_captures(captures.limit(0), none).count() == 0


def test_main_path_is_native(spark):
    plan = op9_url_filters(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
