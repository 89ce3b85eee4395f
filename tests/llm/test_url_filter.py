import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.llm import url_filter

LIST = "pattern string, action string, listed_on date, seq long"
CAPTURES = "url string, fetched_at timestamp, kept string"


def day(n):
    return datetime.date(2024, 1, n)


ENTRIES = [
    ("bad.org", "block", day(5), 1),
    ("bad.org", "off", day(10), 2),
    ("BAD.org", "block", day(20), 3),
    ("ok.bad.org", "allow", day(6), 4),
    ("twice.net", "allow", day(3), 5),
    ("twice.net", "block", day(3), 6),
    (None, "block", day(1), 7),
    ("never.net", "block", None, 8),
    ("bad.org", "block", day(5), 1),
]


@pytest.fixture(scope="module")
def entries(spark):
    return spark.createDataFrame(ENTRIES, LIST)


@pytest.mark.parametrize("rows_per_pattern", [None, 1])
def test_intervals(entries, rows_per_pattern):
    """In one window a pattern, and with the entries of a pattern in splits."""
    found = url_filter.validity_intervals(entries, rows_per_pattern).where("pattern = 'bad.org'")
    got = sorted(map(tuple, found.collect()), key=lambda r: r[2])
    assert got == [("bad.org", "block", day(5), day(10)), ("bad.org", "off", day(10), day(20)), ("bad.org", "block", day(20), None)]


@pytest.mark.parametrize(
    "url, on, pattern",
    [
        ("http://bad.org/x", 4, None),
        ("http://bad.org/x", 5, "bad.org"),
        ("https://www.Bad.org:8080/x", 9, "bad.org"),
        ("http://bad.org/x", 10, None),
        ("http://bad.org./x", 25, "bad.org"),
        ("http://ok.bad.org/x", 8, None),
        ("http://ok.bad.org/x", 5, "bad.org"),
        ("http://user@deep.ok.bad.org?q=http://bad.org", 8, None),
        ("http://notbad.org", 6, None),
        ("http://twice.net", 3, "twice.net"),
        ("http://never.net", 30, None),
        ("no url", 6, None),
        (None, 6, None),
        ("http://bad.org", None, None),
    ],
)
def test_captures(spark, entries, url, on, pattern):
    when = None if on is None else datetime.datetime(2024, 1, on, 13, 30)
    row = url_filter.judge(spark.createDataFrame([(url, when, "mine")], CAPTURES), entries).first()
    assert row["blocked"] == (pattern is not None) and row["kept"] == "mine"
    if pattern:
        assert row["pattern"] == pattern and row["action"] == "block"


def test_repeated_rows_empty_tables_and_clashing_names(spark, entries):
    rows = [("http://bad.org/", datetime.datetime(2024, 1, 6), "a")] * 3
    captures = spark.createDataFrame(rows, CAPTURES)
    assert url_filter.judge(captures, entries).where("blocked").count() == 3
    assert url_filter.judge(captures, entries.limit(0)).where("NOT blocked AND pattern IS NULL").count() == 3
    assert url_filter.judge(captures.limit(0), entries).collect() == []
    named = captures.withColumn("pattern", F.lit("own")).withColumn("blocked", F.lit("own"))
    kept = url_filter.drop_blocked(named.unionByName(named.withColumn("url", F.lit("http://fine.org"))), entries)
    assert kept.columns == named.columns and [r["blocked"] for r in kept.collect()] == ["own"] * 3


def test_times_within_a_day(spark):
    at = lambda hour: datetime.datetime(2024, 1, 5, hour)
    entries = spark.createDataFrame(
        [("bad.org", "block", at(18), 1), ("bad.org", "off", at(20), 2), ("bad.org", "block", at(20), 1)],
        "pattern string, action string, listed_on timestamp, seq long",
    )
    captures = spark.createDataFrame([("http://bad.org", at(h), str(h)) for h in (9, 18, 19, 20, 21)], CAPTURES)
    got = {r["kept"]: (r["blocked"], r["listed_on"]) for r in url_filter.judge(captures, entries).collect()}
    assert got == {"9": (False, None), "18": (True, at(18)), "19": (True, at(18)), "20": (False, None), "21": (False, None)}


@pytest.mark.parametrize("rows_per_pattern", [None, 5])
def test_any_list_matches_brute_force(spark, rows_per_pattern):
    """Also with every pattern split over tasks."""
    import random

    rng = random.Random(6)
    start = datetime.datetime(2024, 1, 1)
    when = lambda: start + datetime.timedelta(minutes=rng.randrange(300))
    hosts = ["a.org", "x.a.org", "y.x.a.org", "b.org", "c.net"]
    listed = [(rng.choice(hosts[:4] + ["org"]), rng.choice(["block", "allow", "off"]), when(), i) for i in range(80)]
    fetched = [(f"http://{rng.choice(hosts)}/", when(), str(i)) for i in range(200)]

    def decide(host, at):
        for k in range(len(host.split("."))):
            suffix = ".".join(host.split(".")[k:])
            held = [(t, s, action) for p, action, t, s in listed if p == suffix and t <= at]
            if held and max(held)[2] != "off":
                return suffix, max(held)[2]
        return None, None

    got = url_filter.judge(
        spark.createDataFrame(fetched, CAPTURES), spark.createDataFrame(listed, "pattern string, action string, listed_on timestamp, seq long"), rows_per_pattern
    )
    want = {i: decide(url[7:-1], at) for url, at, i in fetched}
    assert {r["kept"]: (r["pattern"], r["action"]) for r in got.collect()} == want
