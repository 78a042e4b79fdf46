from __future__ import annotations

import inspect
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from meterfold.llm import packing
from meterfold.llm.queries import tokenizer_file
from meterfold.llm.text import blocks

ODD = [
    "á b", "ΣΑΣ ΟΔΟΣ. x", "İstanbul ǅ ﬁ", "don't we'll x's 's 'S", "a_b 12,3 ½ ²", "<|startoftext|> a<|endoftext|>b <|STARTOFTEXT|>",
    " x y z", "tab\tx\x0by\r\nz\x1c\x85", "", " ", "  ", " \n ", "日本語 テスト🙂👍🏽 👩‍👩‍👧", "́abc ́", "ȩ́",
    "﻿x ​ \x00 y", "x" * 5000, "ÀB" * 40,
    "Word, ÉTÉ. straße!! über*** ÿŸ ×÷ a-b $%| x'y ªº µ <|x|> \xad",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_file())


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_encoder_gives_the_ids_of_the_tokenizer(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "KEPT_PARTS", 16)
    encoder = packing.Encoder(tokenizer_file())
    rng = random.Random(1)
    texts = ODD + [" ".join(rng.choice(ODD) for _ in range(6)) for _ in range(60)]
    for some in [[t] for t in texts * 2] + [texts, texts[:30] * 3]:
        (block,) = blocks(pa.array(some))
        ids, bounds = encoder.ids(block)
        for text, low, high in zip(some, bounds, bounds[1:]):
            assert ids[low:high].tobytes() == ids_of(tokenizer, text), repr(text)


def check_plan(counts, capacity=2048, **settings):
    bins, used = packing.plan(counts, capacity, **settings), Counter()
    for lengths, many in bins:
        assert sum(lengths) <= capacity
        for n in lengths:
            used[n] += many
    assert used == Counter({n: c for n, c in counts.items() if c})
    total = sum(m for _, m in bins)
    assert packing.lower_bound(counts, capacity) <= total <= sum(m for _, m in packing.best_fit(counts, capacity))
    return total


def test_plan_reaches_the_bound_on_many_documents():
    rng = random.Random(2)
    counts = Counter(min(2048, max(1, int(rng.expovariate(1 / 600)))) for _ in range(20_000))
    assert check_plan(counts) == packing.lower_bound(counts, 2048)


def test_plan_beats_best_fit():
    counts = {44: 1, 24: 2, 15: 1, 12: 3, 22: 3, 21: 1, 17: 1, 8: 3, 6: 1, 19: 2, 2: 1, 36: 1}
    assert check_plan(counts, 61) == packing.lower_bound(counts, 61)


def brute_bins(sizes, capacity):
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in sorted({b: k for k, b in enumerate(bins)}.values()):
            if bins[k] + sizes[i] <= capacity:
                place(i + 1, bins[:k] + [bins[k] + sizes[i]] + bins[k + 1 :])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


def test_plan_against_all_packings():
    rng = random.Random(3)
    for _ in range(60):
        sizes = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True)
        assert check_plan(Counter(sizes), 20) == brute_bins(sizes, 20), sizes


def test_plan_of_nothing_and_of_full_bins():
    assert packing.plan({}) == []
    assert check_plan({2048: 5}) == 5


def test_pack(spark, tokenizer):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["of", "the", "tokens", "é"]) for _ in range(rng.choice((0, 5, 40, 900, 5000))))) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [(200, None), (None, "x"), rows[3], (3, "other text")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, length int").repartition(3)
    found = packing.pack(frame, tokenizer_file()).collect()
    places, pieces = defaultdict(list), Counter()
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    want = Counter()
    for doc, text in rows:
        ids = ids_of(tokenizer, text) + b"\0\0\0\0"
        for n, at in enumerate(range(0, len(ids), 8192)):
            part = ids[at : at + 8192]
            want[doc, n, at // 4, len(part) // 4, zlib.crc32(part)] += 1
    assert pieces == want
    assert len(places) == sum(m for _, m in packing.plan(Counter(r["length"] for r in found)))


def test_numbering_is_spread(spark):
    rows = spark.range(500).selectExpr("id doc_id", "0 piece", "id % 3 length", "id ids_crc32")
    found = packing.numbered(rows, 500, per_bucket=40).collect()
    for n in range(3):
        own = sorted(r["k"] for r in found if r["length"] == n)
        assert own == list(range(len(own)))


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer_file()).count() == 0


def test_search_is_not_cut_short():
    """The search of a plan and of a job may take 20,000 fillings unless told otherwise."""
    for job in (packing.plan, packing.pack):
        assert inspect.signature(job).parameters["nodes"].default == 20_000


def test_bounds_and_search_of_hard_lengths():
    """Many documents of few lengths: a proven bound where best fit is right, fewer bins where it is not."""
    rng = random.Random(1)
    assert check_plan({700: 10_000} | Counter(rng.randint(90, 400) for _ in range(8_000))) == 5_000
    counts = Counter(rng.randint(300, 1000) for _ in range(30_000))
    best_fit = sum(m for _, m in packing.best_fit(counts, 2048))
    assert check_plan(counts, work=1_000_000) < 0.98 * best_fit


def test_fillings_are_complete_and_undominated():
    rng = random.Random(6)
    for _ in range(200):
        left = Counter(rng.randint(1, 12) for _ in range(rng.randint(1, 7)))
        room = rng.randint(1, 20)
        every = {()}
        for n, c in left.items():
            every |= {tuple(sorted((*f, *[n] * k), reverse=True)) for f in every for k in range(1, c + 1)}
        every = {f for f in every if sum(f) <= room}

        def beaten(f):
            subsets = {()}
            for n in f:
                subsets |= {(*s, n) for s in subsets}
            free = [n for n, c in left.items() if c > f.count(n)]
            return any(
                (sum(s) < n or len(s) > 1 and sum(s) == n) and sum(f) - sum(s) + n <= room for s in subsets for n in free
            )

        found = list(packing._fillings(left, room, room, [10**6]))
        assert len(found) == len(set(found))
        assert set(found) == {f for f in every if not beaten(f)}


def _uneven(seed=5):
    rng = random.Random(seed)
    return {n: rng.randrange(1, 9) for n in range(300, 1001)}


def test_search_holds_few_levels():
    tracemalloc.start()
    try:
        packing.plan(_uneven(), 2048, nodes=600)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 35e6


@pytest.mark.parametrize("held", [1, 3])
def test_levels_made_again_give_the_same_plan(monkeypatch, held):
    rng = random.Random(11)
    cases = [({rng.randrange(10, 60): rng.randrange(1, 4) for _ in range(14)}, 100) for _ in range(40)]
    cases.append((_uneven(), 2048))

    def plans(levels):
        monkeypatch.setattr(packing, "HELD_LEVELS", levels)
        return [packing.plan(counts, room, 400, 60_000) for counts, room in cases]

    assert plans(held) == plans(10**6)
