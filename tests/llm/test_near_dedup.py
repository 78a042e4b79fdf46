from __future__ import annotations

import random
from itertools import combinations

import pytest
import xxhash

import brute
from meterfold.llm import simhash
from meterfold.llm.components import components


def test_covering_masks_leave_no_pair_out():
    masks = simhash.covering_masks(list(range(64)), 2)
    assert len(masks) == 7 and all(m.bit_count() >= 32 for m in masks)
    for a, b in combinations(range(64), 2):
        assert any(not (m >> a & 1) and not (m >> b & 1) for m in masks)
    free = [b for b in range(64) if not masks[0] >> b & 1]
    for a, b in combinations(free, 2):
        assert any(not (m >> a & 1) and not (m >> b & 1) for m in simhash.covering_masks(free, 2))


@pytest.mark.parametrize("text", ["a", "One two", "x y z", "A B C d e f g " * 9, "\x0b é\tÉ\nß ", "", "  \n", None])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute.simhash(text, xxhash.xxh64_intdigest)


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bucket", [4096, 8])
def test_links_against_all_pairs(spark, monkeypatch, bucket):
    """With tiny buckets the second set of masks does the work."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        center = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            prints.add(center)
            center ^= 1 << rng.randrange(64) if rng.random() < 0.5 else (1 << rng.randrange(64)) | (1 << rng.randrange(64))
    near = [(a, b) for a, b in combinations(sorted(prints), 2) if (a ^ b).bit_count() <= 2]
    frame = spark.createDataFrame([(_signed(p),) for p in prints], "fp long")
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(frame).collect()]
    assert near and all((a ^ b).bit_count() for a, b in found)
    assert brute.roots(prints, found) == brute.roots(prints, near)


def test_near_duplicates(spark):
    text = " ".join(f"word{i}" for i in range(400))
    rows = [
        (7, text, 1), (3, text + " more", 2), (5, text, 3), (5, text, 3), (None, text, 4), (9, "other words here", 5),
        (11, "", 6), (10, None, 7), (12, " \n", 8),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    found = simhash.near_duplicates(frame).collect()
    assert len(found) == len(rows)
    groups = {r["doc_id"]: r["component_id"] for r in found}
    assert groups[7] == groups[5] == groups[None] and groups[9] == 9
    assert groups[11] == groups[10] == groups[12] == 10
    assert {r["fingerprint"] for r in found if r["doc_id"] in (10, 11, 12)} == {"0" * 16}
    assert all(int(r["fingerprint"], 16) == brute.simhash(dict((a, b) for a, b, _ in rows)[r["doc_id"]], xxhash.xxh64_intdigest) for r in found)
    kept = simhash.one_of_each(frame)
    assert kept.columns == ["doc_id", "text", "fp"]
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == sorted({g for d, g in groups.items() if d is not None}) + [None]


def test_texts_that_share_an_id(spark):
    """Each stays unless a near copy of it does."""
    first, other = (" ".join(f"{w}{i}" for i in range(100)) for w in "vw")
    rows = [(1, first), (2, first), (2, other), (2, other), (3, other), (4, first + " x")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["doc_id"] < 4) == [(1, first), (2, other)]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(-50, 400), rng.randint(-50, 400)) for _ in range(250)]
    edges += [(1000 + i, 1001 + i) for i in range(70)] + [(5000, 5000 + i) for i in range(1, 300)] + [(3, 3)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = [(a, b) for a, b in edges if a != b]
    assert found == brute.roots({n for e in linked for n in e}, linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.one_of_each(empty).count() == 0
