from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

import brute
from compare import connect, differences
from meterfold.llm import merkle, queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digest(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """The root, and what stands before and after each node on its way there."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i - i % 16 : i - i % 16 + 16]
            ways[k].append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return nodes[0], ways


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault((row[1] is not None, (row[1] or "").encode()), []).append(row)
    subs = {}
    for name, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        subs[name] = (own, *tree([digest(r) for r in own]))
    names = sorted(subs)
    root, upper = tree([subs[n][1] for n in names])
    found = []
    for k, name in enumerate(names):
        own, subroot, ways = subs[name]
        for row, way in zip(own, ways):
            way = way + upper[k]
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None
            end = digest((*row[:4], brute.lower(row[4]))) if changed else digest(row)
            for before, after in way:
                end = sha(before + end + after)
            proof = sha("".join(b + a for b, a in way))
            found.append((row[0], digest(row), subroot, root, proof, end, end == root))
    return sorted(found, key=repr)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.verified(frame, merkle.every_fifth()).collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_layout_is_recursive(levels):
    """Every node has a place of its own, and an aligned subtree at half height lies together."""
    places = [merkle.slots(d, np.arange(16**d), levels) for d in range(levels)]
    every = np.concatenate(places)
    assert np.array_equal(np.sort(every), np.arange(len(every)))
    half = levels // 2
    if half:
        assert max(p.max() for p in places[:half]) == merkle._tree_size(half) - 1
        size = merkle._tree_size(levels - half)
        first = places[half]
        assert np.array_equal(first, merkle._tree_size(half) + np.arange(16**half) * size)
        for depth in range(half, levels):
            top = np.arange(16**depth) // 16 ** (depth - half)
            assert np.array_equal((places[depth] - merkle._tree_size(half)) // size, top)


def test_query_matches_sql(spark):
    con = connect(FOLDER)
    assert differences(queries.QUERIES["op13_merkle_manifest"](spark, FOLDER), con, queries.SQL["op13_merkle_manifest"]) == []
    con.close()


def test_against_plain_trees(spark):
    """Trees of 1 to 700 leaves in one block, and one of 5000 that takes a second round."""
    rng = random.Random(4)
    rows = []
    for source, size in {"a": 1, "b": 2, "é": 16, "Z": 17, "c": 256, "d": 257, None: 30, "": 1, "hot": 700}.items():
        for _ in range(size):
            rows.append((rng.getrandbits(40) - (1 << 39), source, rng.choice(["en", None, ""]), rng.choice([None, 5]), rng.choice([None, "", "Some TEXT é", "lower"])))
    want = plain(rows)
    assert {w[-1] for w in want} == {True, False}
    assert found(spark, rows) == want
    one = [(i, "only", "en", 1, f"T{i}") for i in range(5000)]
    assert found(spark, one) == plain(one)


def test_odd_rows(spark):
    """Repeated rows are leaves of their own; ids with two texts stand in digest order."""
    rows = [(1, "s", None, None, None)] * 3 + [(1, "s", "en", 3, "B"), (None, "s", "en", 3, "C"), (None, None, None, None, None)]
    rows += [(2, "s", "en", 3, "A"), (2, "s", "en", 3, "A"), (7, "t", "en", 900_000, "Xy" * 450_000)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows[:1]) == plain(rows[:1])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.verified(empty).count() == 0 and merkle.verified(empty).columns[0] == "doc_id"
