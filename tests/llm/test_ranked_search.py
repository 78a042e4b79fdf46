from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

import brute
from compare import connect, differences
from meterfold.llm import queries, ranked_search

FOLDER = "/root/testdata/sf0.001"
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, items, k):
    bags = [(doc, Counter(TERMS.findall(brute.lower(text)))) for doc, text in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    found = []
    for item, text in items:
        asked = Counter(TERMS.findall(brute.lower(text)))
        scores = []
        for (doc, bag), size in zip(bags, sizes):
            if size:
                room = 100 - 25 + (25 * size * n_docs) // n_terms
                score = sum(
                    c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * room))
                    for t, c in asked.items() if t in bag
                )
                if score > 0:
                    scores.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            found.append((item, rank, doc, -score))
    return sorted(found, key=repr)


def found(spark, docs, items, k):
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item int").repartition(3)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in ranked_search.search(frame, asked, k).collect()), key=repr)


def test_query_matches_sql(spark):
    con = connect(FOLDER)
    name = "op12_ranked_lexical_search"
    assert differences(queries.QUERIES[name](spark, FOLDER), con, queries.SQL[name]) == []
    con.close()


@pytest.mark.parametrize("turn_terms", [50_000, 60])
def test_against_all_scores(spark, monkeypatch, turn_terms):
    """Also with many turns of queries. Half of the documents repeat, so scores tie."""
    monkeypatch.setattr(ranked_search, "TURN_TERMS", turn_terms)
    rng = random.Random(8)
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(3000)] + ["É", "é", "x@y", "A-B"]
    docs = [(rng.randint(0, 10**9), " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for _ in range(700)]
    docs += [(d + 1, t.upper()) for d, t in docs[:350]]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))) for i in range(12)]
    assert found(spark, docs, items, 20) == plain(docs, items, 20)
    assert found(spark, docs, items, 3) == plain(docs, items, 3)


def test_odd_rows(spark):
    docs = [(1, "cat dog"), (1, "cat dog"), (1, "bird"), (None, "cat dog"), (2, None), (3, ""), (4, "... ;"), (5, "cat " * 300_000), (6, "cat bird")]
    items = [(1, "Cat"), (1, "CAT bird"), (None, "dog dog unknown"), (2, None), (3, ""), (4, "none of these words")]
    assert found(spark, docs, items, 20) == plain(docs, items, 20)


def test_empty_tables(spark):
    docs, items = [(1, "one two")], [(1, "one")]
    assert found(spark, [], items, 20) == found(spark, docs, [], 20) == found(spark, [], [], 20) == []


def test_segment_bounds(spark, monkeypatch):
    """The search of one segment gives its best documents, whatever score there is to beat."""
    rng = random.Random(1)
    docs = [(i, " ".join(f"w{rng.randint(0, 50)}" for _ in range(30))) for i in range(300)]
    items = [(0, "w1 w2 w3 w3 w60")]
    want = [r[3] for r in sorted(plain(docs, items, 300), key=lambda r: r[1])]
    row = ranked_search.index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).first()
    import numpy as np
    data = {n: np.array(row[n]) if isinstance(row[n], list) and n != "docs" else row[n] for n in row.__fields__}
    (query,) = [next(ranked_search._query_terms(iter([_one(items[0][1])])))]
    names, counts = np.array(query.column("names")[0].as_py()), np.array(query.column("counts")[0].as_py())
    df = [data["sizes"][np.searchsorted(data["names"], n)] if n in data["names"] else 0 for n in names]
    weights = np.array([ranked_search.weight(row["n_docs"], int(d)) for d in df]) * counts
    lists = ranked_search._Lists(data, np.sort(names), row["n_docs"], row["n_terms"])
    for k, least in [(1, 1), (20, 1), (20, want[10]), (300, 1), (5, want[0] + 1)]:
        _, scores = ranked_search.best(lists, names, weights, k, least)
        assert sorted(scores.tolist(), reverse=True)[:k] == [s for s in want[:k] if s >= least]


def _one(text):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([0]), pa.array([text])], names=["item", "text"])
