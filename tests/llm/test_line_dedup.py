from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import brute
from compare import connect, differences
from meterfold.llm import line_dedup, queries

FOLDER = "/root/testdata/sf0.001"
ENDS = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")


def plain(rows, min_docs=3, min_chars=20):
    """Kept text of every row, by the rule read literally."""
    docs = defaultdict(set)
    key = lambda line: brute.lower(ENDS.sub("", line))
    for doc, text in rows:
        if doc is not None and text is not None:
            for line in text.split("\n"):
                docs[key(line)].add(doc)
    found = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = []
        for line in lines:
            held = docs[key(line)]
            if doc is None or len(key(line)) < min_chars or len(held) < min_docs or doc == max(held):
                left.append(line)
        kept = "\n".join(left)
        found.append((doc, len(lines), len(lines) - len(left), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(found, key=repr)


def found(frame, **options):
    rows = line_dedup.without_common_lines(frame, **options).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_query_matches_sql(spark):
    con = connect(FOLDER)
    assert differences(queries.QUERIES["op11_line_dedup"](spark, FOLDER), con, queries.SQL["op11_line_dedup"]) == []
    con.close()


def test_against_plain_rule(spark):
    rng = random.Random(3)
    pool = [f"{'  ' * rng.randint(0, 1)}Line number {i} of the pool é{'x' * rng.randint(0, 9)}{rng.choice(['', ' ', chr(9), chr(13)])}" for i in range(30)]
    pool += ["", " ", "short", "ÄÖÜ" * 6 + "x", "ÄÖÜ" * 6 + "xy", "\x0b\x0c", "a " * 10]
    rows = []
    for doc in range(80):
        lines = [rng.choice(pool) if rng.random() < 0.5 else f"only in document {doc} once {rng.random()}" for _ in range(rng.randint(0, 9))]
        rows.append((doc, "\n".join(line.upper() if rng.random() < 0.2 else line for line in lines)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame) == plain(rows)
    assert found(frame, min_docs=2, min_chars=1) == plain(rows, 2, 1)


def test_odd_rows(spark):
    """Repeated ids count once and keep their own texts; rows without an id stay whole."""
    line = "a line of more than twenty characters"
    other = "another line of more than twenty characters"
    rows = [
        (1, line, 1), (1, line, 1), (1, f"{line}\n{other}", 2), (2, f"{line.upper()} \n\n{line}", 3),
        (None, f"{line}\n{other}", 4), (None, None, 5), (3, None, 6), (4, "", 7), (5, f"{line}\n{line}\n{other}", 8),
        (6, "\n\n", 9), (7, "y" * 400_000 + "\n" + other, 10),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, gone int")
    assert found(frame) == plain([r[:2] for r in rows])
    texts = {r["doc_id"]: r["kept"] for r in line_dedup.without_common_lines(frame).where("doc_id in (2, 5)").collect()}
    assert texts == {2: "", 5: f"{line}\n{line}"}
    two = spark.createDataFrame([(1, line), (1, line + " "), (2, line)], "doc_id long, text string")
    assert all(r["n_dropped"] == 0 for r in line_dedup.without_common_lines(two).collect())


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.without_common_lines(empty).count() == 0
