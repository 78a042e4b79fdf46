from __future__ import annotations

import datetime as dt
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import brute
from compare import connect, differences
from meterfold.llm import queries, rules, url_lists

NATIVE = ("op9_", "op10_")
FOLDER = os.environ.get("METERFOLD_TEST_DATA", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = connect(FOLDER)
    frame = queries.QUERIES[name](spark, FOLDER)
    assert differences(frame, con, queries.SQL[name]) == []
    plan = frame._jdf.queryExecution().toString()
    if name.startswith(NATIVE):
        assert not [w for w in ("Python", "Arrow", "InPandas", "CartesianProduct") if w in plan]
    con.close()


def test_every_operator_is_registered_once():
    names = list(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries())


def counted(text):
    words = brute.WORDS.findall(text or "")
    threes = {}
    for i in range(len(words) - 2):
        threes.setdefault(tuple(words[i : i + 3]), []).append(i)
    again = {i + k for at in threes.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if brute.WORDS.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again),
    )


def test_base_counts(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice((" ", "\n", "\t \n")).join(rng.choice(["a", "b", "É#", "c|", "\x0b"]) for _ in range(rng.randint(0, 90)))) for i in range(120)]
    rows += [(500, None), (None, "a b"), (501, ""), (502, " \n "), (503, "x y z " * 3000), rows[2], (504, "a a a"), (505, "one two")]
    frame = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, kept boolean")
    found = rules.judged(frame, sample_rows=20).collect()
    known = dict(rows)
    assert len(found) == len(rows)
    for r in found:
        want = counted(known[r["doc_id"]])
        assert tuple(r)[1:6] == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_order_of_rules_changes_no_verdict(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    own = rules.default_rules()
    rows = rules.measured(docs)
    for order in (own, own[::-1]):
        kept = rows.select("doc_id", rules.cascade(order).alias("k")).where("k").count()
        assert kept == rows.where(~(own[0].fails | own[1].fails | own[2].fails | own[3].fails | own[4].fails)).count()
    found = rules.estimated(rules.measured(rules.first_rows(docs, 50)), own)
    assert len(found) == len(own) and [e.worth for e in found] == sorted((e.worth for e in found), reverse=True)
    assert rules.judged(docs.limit(0)).count() == 0


def test_a_costly_rule_comes_after_a_cheap_one_that_rejects_as_much(spark):
    rows = rules.measured(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    short = F.col("n_words") < 100
    letters = F.array_sort(F.transform(F.split("text", ""), lambda x: F.sha2(x, 256)))
    own = [rules.Rule("a", short & (F.size(letters) >= 0) & (F.array_max(letters) != "")), rules.Rule("b", short)]
    for order in (own, own[::-1]):
        found = rules.estimated(rows, order)
        assert [e.rule.name for e in found] == ["b", "a"]
        assert found[0].rejects == found[1].rejects > 0 and found[0].seconds < found[1].seconds


def test_list_entries_as_of_the_fetch(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    rng = random.Random(6)
    names = ["x.org", "a.x.org", "a.x.org/en", "a.x.org/en/news", "org", "y.net", "y.net/de"]
    events = [(rng.choice(names), day(rng.randint(0, 200)), rng.random() < 0.6) for _ in range(60)]
    events += [("y.net", day(50), True), ("y.net", day(50), False), (None, day(1), True), ("z", None, True), ("z", day(1), None)]
    urls = ["http://a.x.org/en/news/1?x=/q", "https://U@A.X.org:80/en#top", "http://y.net", "http://y.net/de/", "ftp://x.org./a", "no url", "", None, "http://org"]
    captures = [(i, rng.choice(urls), day(rng.randint(-10, 260)) if i % 9 else None) for i in range(300)]
    captures += [captures[1], (None, urls[0], day(100))]
    frame = spark.createDataFrame([(*c, 1) for c in captures], "page_id long, url string, fetched date, entry int").repartition(3)
    found = url_lists.as_of(frame, spark.createDataFrame(events, "entry string, at date, listed boolean")).collect()
    covers = {
        urls[0]: {"x.org", "a.x.org", "org", "a.x.org/en", "a.x.org/en/news"}, urls[1]: {"x.org", "a.x.org", "org", "a.x.org/en"},
        urls[2]: {"y.net"}, urls[3]: {"y.net", "y.net/de"}, urls[4]: {"x.org", "org"}, urls[8]: {"org"},
    }

    def active(name, at):
        own = [(d, v) for n, d, v in events if n == name and d is not None and d <= at]
        last = max((d for d, _ in own), default=None)
        return last is not None and all(v for d, v in own if d == last)

    assert len(found) == len(captures)
    for r in found:
        on = sorted(n for n in covers.get(r["url"], ()) if r["fetched"] and active(n, r["fetched"]))
        assert (r["n_active"], r["entry"], r["blocked"]) == (len(on), on[0] if on else None, bool(on)), r
    assert url_lists.as_of(frame.limit(0), spark.createDataFrame(events, "entry string, at date, listed boolean")).count() == 0
    none = spark.createDataFrame([], "entry string, at date, listed boolean")
    assert url_lists.as_of(frame, none).where(F.col("blocked")).count() == 0


def test_deep_entries_and_capitals_in_paths(spark):
    day = dt.date(2024, 3, 1)
    deep = "x.org/" + "/".join(f"p{i}" for i in range(12))
    events = [(n, day, True) for n in ("x.org/a/b/c/d", "x.org/a/b/c/d/e", deep, "Y.net/News/Old", "z.com/only/listed/else/where")]
    urls = {
        "http://x.org/a/b/c/d": 1, "http://x.org/a/b/c/d/e/f?q": 2, "http://x.org/a/b/c": 0, f"http://{deep}/more": 1,
        "http://y.net/News/Old/1": 1, "http://Y.NET/news/old": 1, "http://y.net/NEWS": 0, "http://x.org/A/b/C/d": 1, "http://z.com/": 0,
    }
    captures = spark.createDataFrame([(i, u, day) for i, u in enumerate(urls)], "page_id long, url string, fetched date")
    found = url_lists.as_of(captures, spark.createDataFrame(events, "entry string, at date, listed boolean")).collect()
    assert {r["url"]: r["n_active"] for r in found} == urls
    pages = spark.createDataFrame([(i, f"http://h{i}.org/News/{i}") for i in range(60)], "page_id long, url string")
    deep = pages.union(spark.createDataFrame([(100 + i, f"http://H{i}.org/A/b/C/d/E/{i}") for i in range(60)], pages.schema))
    con = duckdb.connect()
    con.register("pages", deep.toPandas())
    own = url_lists.as_of(url_lists.fetch_days(deep), url_lists.derived_events(deep))
    assert differences(own.withColumn("fetched", F.col("fetched").cast("string")), con, url_lists.SQL) == []
    made = url_lists.derived_events(pages)
    sections = {r["entry"] for r in made.where(F.col("entry").contains("/")).collect()}
    later = pages.withColumn("fetched", F.lit("2025-06-01").cast("date"))
    hits = {r["page_id"]: r["n_active"] for r in url_lists.as_of(later, made).collect()}
    names = {r["entry"] for r in made.collect()}
    assert sections and hits == {i: (f"h{i}.org" in names) + (f"h{i}.org/news" in names) for i in range(60)}
