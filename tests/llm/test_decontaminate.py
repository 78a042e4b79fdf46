from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import brute
from meterfold.llm import decontaminate

ITEMS = "item_id long, text string"


def sample():
    rng = random.Random(6)
    words = ["of", "The", "and", "é1", "x-y", "in", "Z9"]
    items = [(i, " ".join(rng.choice(words) + (str(rng.randint(0, 3)) if rng.random() < 0.4 else "") for _ in range(rng.randint(0, 30)))) for i in range(40)]
    items += [(90, None), (91, ""), (92, "in"), (93, "of and"), (None, items[3][1]), items[5], (12, items[5][1])]
    docs = []
    for i in range(150):
        own = [rng.choice(words) + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            part = (rng.choice(items)[1] or "").split()
            at, low = rng.randint(0, len(own)), rng.randint(0, 4)
            own[at:at] = part[low : low + rng.randint(5, 25)]
        docs.append((i, rng.choice((" ", ", ", "\n")).join(own)))
    return docs + [(None, items[1][1]), (7, None), (8, ""), docs[3]], items


@pytest.mark.parametrize("turn", [200_000, 40])
def test_against_brute_force(spark, turn):
    docs, items = sample()
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n_hit int").repartition(4)
    found = decontaminate.contamination(frame, spark.createDataFrame(items, ITEMS), turn).collect()
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r) for r in found), key=key) == sorted(brute.contamination(docs, items), key=key)


def test_clean_keeps_columns(spark):
    docs, items = sample()
    frame = spark.createDataFrame([(*d, i) for i, d in enumerate(docs)], "doc_id long, text string, spans int")
    kept = decontaminate.clean(frame, spark.createDataFrame(items, ITEMS))
    assert kept.columns == ["doc_id", "text", "spans"]
    bad = {i for i, r in enumerate(brute.contamination(docs, items)) if r[-1]}
    assert bad and {r["spans"] for r in kept.collect()} == set(range(len(docs))) - bad


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    nothing = spark.createDataFrame([], ITEMS)
    row = decontaminate.contamination(docs, nothing).first()
    assert (row["n_words"], row["n_hit"], row["contaminated"]) == (3, 0, False)
    assert decontaminate.contamination(docs.limit(0), spark.createDataFrame([(1, "a")], ITEMS)).count() == 0


def test_spans_and_items(spark):
    docs, items = sample()
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("digest", F.encode(F.coalesce("text", F.lit("")), "utf-8"))
    texts, listed = decontaminate.search(rows, spark.createDataFrame(items, ITEMS))
    assert listed.count() == len(docs)
    found = {bytes(r["digest"]).decode(): ([tuple(s) for s in r["spans"]], r["items"]) for r in texts.collect()}
    want = {}
    for _, text in docs:
        spans, ids = brute.passages(text, items)
        if spans:
            want[text] = (brute.merged(spans), sorted(ids - {None}))
    assert want and found == want


def test_many_windows_share_one_shingle(spark):
    """No list of windows under one shingle: they meet by their words."""
    rng = random.Random(3)
    items = [(i, " ".join([*(f"a{rng.randrange(50)}" for _ in range(5)), "one", "two", "three", *(f"b{rng.randrange(50)}" for _ in range(5))])) for i in range(20_000)]
    docs = [(i, f"x{i} " + items[i % 7][1] + " y one two three") for i in range(300)]
    found = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    ).collect()
    assert {(r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in found} == {(18, 13, 1, True)}


def test_merged():
    assert brute.merged([(5, 7), (0, 2), (1, 3), (3, 4)]) == [(0, 4), (5, 7)]
