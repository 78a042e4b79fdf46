from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

import brute
from meterfold.llm import recompression, repeats, suffix_array
from meterfold.llm.text import SPACE_WORDS, blocks

SCHEMA = "doc_id long, text string"


def byte_rows():
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh ü") for _ in range(400))
    rows = []
    for i in range(240):
        k = rng.random()
        if k < 0.2:
            text = "ab" * rng.randint(0, 200)
        elif k < 0.3:
            text = "x" * rng.randint(90, 400)
        elif k < 0.8:
            a = rng.randint(0, 300)
            noise = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 50))) for _ in range(2)]
            text = noise[0] + base[a : a + rng.randint(50, 200)] + noise[1]
            text *= rng.choice((1, 1, 2))
        else:
            text = rng.choice((None, "", "".join(rng.choice("ab") for _ in range(300))))
        rows.append((i if i % 29 else None, text))
    return rows + [rows[5], rows[7], rows[8]]


def word_rows():
    rng = random.Random(4)
    letters = ["a", "b", "c", "dé", "e"]
    base = [rng.choice(letters) for _ in range(150)]
    rows = []
    for i in range(300):
        k = rng.random()
        if k < 0.2:
            words = ["the"] * rng.randint(0, 60)
        elif k < 0.3:
            words = ["x", "y"] * rng.randint(5, 40)
        elif k < 0.8:
            a = rng.randint(0, 120)
            noise = [[rng.choice(letters) for _ in range(rng.randint(0, 12))] for _ in range(2)]
            words = (noise[0] + base[a : a + rng.randint(10, 60)] + noise[1]) * rng.choice((1, 1, 2))
        else:
            words = rng.choice((None, [], [rng.choice("ab") for _ in range(60)]))
        text = None if words is None else rng.choice((" ", "\n", "  ")) + rng.choice((" ", "\t\n")).join(words)
        rows.append((i if i % 29 else None, text))
    return rows + [rows[5], rows[7], rows[8]]


def test_bytes_against_brute_force(spark):
    rows = byte_rows()
    frame = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", start int, key string").repartition(5)
    found = suffix_array.without_repeats(frame).collect()
    want = brute.byte_repeats(rows)
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        else:
            assert tuple(r)[1:5] == want[r["doc_id"]]
    assert sum(w[1] for w in want.values()) > 10_000


def test_words_against_brute_force(spark):
    rows = word_rows()
    found = recompression.without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    want = brute.word_repeats(rows)
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is not None:
            assert tuple(r)[1:4] == want[r["doc_id"]]


@pytest.mark.parametrize("spread", [False, True])
def test_many_texts_with_one_passage(spark, monkeypatch, spread):
    """A passage in all texts: its keys may be dealt out by name without changing anything."""
    monkeypatch.setattr(repeats, "SAMPLE_ONE_IN", 2)
    monkeypatch.setattr(repeats, "SPREAD_SHARE", 1 / 2000 if spread else 1.0)
    rng = random.Random(9)
    shared = " ".join(rng.choice(["of", "the", "and", "in"]) + str(rng.randint(0, 50)) for _ in range(60))
    rows = []
    for i in range(200):
        own = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 30))) for _ in range(2)]
        rows.append((i, f"{own[0]} {shared} {own[1]}"))
    frame = spark.createDataFrame(rows, SCHEMA)
    for operator, want in ((suffix_array, brute.byte_repeats(rows)), (recompression, brute.word_repeats(rows))):
        found = operator.without_repeats(frame, with_text=False).collect()
        assert {r["doc_id"]: tuple(r)[1 : 1 + len(want[0])] for r in found} == want


def test_marks_do_not_depend_on_batches():
    key = np.array([1, 1, 2, 3, 3, 3, 4, 5, 5, 5, 6])
    name = np.array([1, 1, 7, 2, 2, 3, 1, 1, 2, 2, 9])
    doc = np.arange(11)
    columns = {
        "key": key, "name": name, "doc_id": doc, "variant": np.zeros(11, np.int64), "start": np.zeros(11, np.int32), "count": np.ones(11, np.int32),
        "settled": np.zeros(11, bool), "spread": np.zeros(11, bool),
    }
    whole = pa.RecordBatch.from_pydict({n: pa.array(c) for n, c in columns.items()})
    want = {(1, False), (3, True), (4, False), (5, True), (7, True), (8, True), (9, False)}
    for size in (1, 2, 3, 5, 11):
        parts = [whole.slice(i, size) for i in range(0, 11, size)]
        found = [r for b in repeats._ranked(iter(parts)) for r in b.to_pylist()]
        assert {(r["doc_id"], r["open"]) for r in found} == want and len(found) == len(want)


def test_texts_that_share_an_id(spark):
    """Each is a document of its own: nothing goes that is not in another one."""
    first = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, first), (2, first), (2, other), (2, other), (2, None), (3, other), (None, first)]
    frame = spark.createDataFrame(rows, SCHEMA)
    size = len(first)
    found = sorted((r["doc_id"] or 0, r["kept"], r["n_removed"]) for r in suffix_array.without_repeats(frame).collect())
    assert found == sorted([(1, first, 0), (2, "", size), (2, other, 0), (2, other, 0), (2, "", 0), (3, "", size), (0, first, 0)])
    found = sorted((r["doc_id"] or 0, r["kept"], r["n_removed"]) for r in recompression.without_repeats(frame).collect())
    assert found == sorted([(1, first, 0), (2, "", 60), (2, other, 0), (2, other, 0), (2, "", 0), (3, "", 60), (0, first, 0)])
    cut = [(r["doc_id"], r["text"]) for r in recompression.cut_texts(frame).collect()]
    want = [(1, first), (2, ""), (2, other), (2, other), (2, None), (3, ""), (None, first)]
    assert sorted(cut, key=repr) == sorted(want, key=repr)
    # Two texts under one id that share a passage: the one with the smaller digest keeps it.
    twins = spark.createDataFrame([(5, first + " a"), (5, first + " b")], SCHEMA)
    for operator in (suffix_array, recompression):
        assert sorted(r["n_removed"] > 0 for r in operator.without_repeats(twins).collect()) == [False, True]


def test_cut_texts_keeps_columns_and_untouched_texts(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, "a  b\n" + passage, "en"), (2, passage + " tail", "de"), (3, "x  y", None), (None, passage, "fr")]
    found = recompression.cut_texts(spark.createDataFrame(rows, "doc_id long, text string, repeats string"))
    assert found.columns == ["doc_id", "text", "repeats"]
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    assert texts == {1: "a  b\n" + passage, 2: "tail", 3: "x  y", None: passage}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_array.without_repeats(empty).count() == 0
    assert recompression.without_repeats(empty).count() == 0
    assert recompression.cut_texts(empty).count() == 0


def test_blocks_cut_anywhere():
    texts = ["", "ab c", None, "é  x", "", "   ", "last"]
    for limit in (1, 3, 7, 1000):
        words = []
        for block in blocks(pa.array(texts), limit):
            starts, ends, first = block.words(SPACE_WORDS)
            for i in range(len(block)):
                words.append([bytes(block.data[s:e]) for s, e in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])])
        assert words == [(t or "").encode().split() for t in texts]


def test_very_long_text(spark):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randint(0, 10**9)}" for _ in range(450_000))
    copy = text[2_000_000:2_001_000]
    rows = [(1, text), (2, copy)]
    found = {r["doc_id"]: r for r in suffix_array.without_repeats(spark.createDataFrame(rows, SCHEMA), False).collect()}
    assert (found[1]["n_removed"], found[2]["n_removed"]) == (0, 1000)
