"""Positions and what is built on them, with one group holding most rows."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterfold.operators import hierarchy, ordering


@pytest.fixture(scope="module")
def members(spark):
    """Group 0 holds two thirds of the members."""
    rows = spark.range(0, 3000, 1, 8).select(
        F.col("id").alias("m"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 11).otherwise(0).alias("g"),
    )
    return rows


def _groups(members):
    groups = defaultdict(list)
    for r in members.collect():
        groups[r.g].append(r.m)
    return {g: sorted(m) for g, m in groups.items()}


def test_positions_match_brute_force(members):
    got = ordering.positions(
        members, ["m"], ordering.id_block("m", 128), keys=["g"], total="size", running={"so_far": "m"}
    ).collect()
    groups = _groups(members)
    assert len(got) == 3000
    for r in got:
        ordered = groups[r.g]
        place = ordered.index(r.m) + 1
        assert (r.position, r.size) == (place, len(ordered))
        assert r.so_far == sum(ordered[:place])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    ids=st.sets(st.integers(-500, 500), min_size=1, max_size=60),
    width=st.integers(1, 300),
)
def test_positions_do_not_depend_on_the_bucket(spark, ids, width):
    rows = spark.createDataFrame([(i,) for i in ids], "m BIGINT")
    placed = ordering.positions(rows, ["m"], ordering.id_block("m", width))
    assert [(r.m, r.position) for r in placed.orderBy("m").collect()] == [
        (m, i) for i, m in enumerate(sorted(ids), 1)
    ]


def test_positions_keep_null_keys(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g STRING, m BIGINT")
    placed = ordering.positions(rows, ["m"], ordering.id_block("m", 2), keys=["g"])
    assert sorted((r.m, r.position) for r in placed.collect()) == [(1, 1), (2, 2), (3, 1)]


@pytest.mark.parametrize("parents", [1, 7, 5000])
def test_balanced_parents(members, parents):
    got = hierarchy.balanced_parents(members, ["g"], "m", parents, partitions=30).collect()
    assert len(got) == 3000
    for g, ordered in _groups(members).items():
        numbers = [r.parent_no for r in sorted((r for r in got if r.g == g), key=lambda r: r.m)]
        base, longer = divmod(len(ordered), parents)
        want = [p + 1 for p in range(min(parents, len(ordered))) for _ in range(base + (p < longer))]
        assert numbers == want


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_sorted_positions(spark, members, partitions):
    """Also with null keys, ties, and two ids far from all others."""
    far = [(2**63 - 1, 0), (-(2**63), 0), (5, None), (7, None), (None, None), (9, 1), (9, 1)]
    rows = members.union(spark.createDataFrame(far, "m long, g long"))
    got = ordering.sorted_positions(rows, ["m"], keys=["g"], total="size", partitions=partitions).collect()
    groups = defaultdict(list)
    for r in rows.collect():
        groups[r.g].append((r.m is not None, r.m or 0))
    assert len(got) == 3007
    for g, ordered in groups.items():
        ordered.sort()
        own = sorted((r for r in got if r.g == g), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(1, len(ordered) + 1))
        assert [(r.m is not None, r.m or 0) for r in own] == ordered
        assert {r.size for r in own} == {len(ordered)}
    assert ordering.sorted_positions(rows.where("false"), ["m"]).count() == 0


def test_sorted_ranges_are_even_with_outliers(spark, monkeypatch):
    ids = spark.range(40_000).select("id").union(spark.sql("SELECT 9223372036854775807L UNION ALL SELECT -9223372036854775808L"))
    stored = []
    keep = ordering.scratch.stored
    monkeypatch.setattr(ordering.scratch, "stored", lambda rows, label: stored.append(keep(rows, label)) or stored[-1])
    assert ordering.sorted_positions(ids, ["id"], partitions=16).count() == 40_002
    sizes = [r["count"] for r in stored[0].groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * 40_002 / 16


def test_sequence_keys(members):
    got = hierarchy.sequence_keys(members, ["g"], "m", [F.lit("P"), F.col("g").cast("string")], partitions=50)
    groups = _groups(members)
    for r in got.collect():
        assert r.member_key == f"P-{r.g}-{groups[r.g].index(r.m) + 1:05d}"


def test_member_lists_are_whole_and_bounded(members):
    got = hierarchy.member_lists(members, ["g"], "m", block=250).collect()
    assert max(len(r.members) for r in got) <= 250
    seen = Counter(m for r in got for m in r.members)
    assert len(seen) == 3000 and set(seen.values()) == {1}
    for r in got:
        assert list(r.members) == sorted(r.members) and r.n_members == len(r.members)


def test_level_counts_and_control_totals(spark, members):
    counts = hierarchy.level_counts({"groups": (members, "g"), "members": (members, "m")}).first()
    assert (counts.groups, counts.members) == (11, 3000)
    rows = spark.createDataFrame([("a", 2, "xy"), ("b", 3, "xy")], "k STRING, n INT, t STRING")
    checked = hierarchy.control_totals(rows, ["k"], F.sum("n"), F.sum(F.length("t")))
    assert {r.k: r.ok for r in checked.collect()} == {"a": True, "b": False}
    hierarchy.require_totals(checked.where(F.col("k") == "a"))
    with pytest.raises(ValueError, match="control totals"):
        hierarchy.require_totals(checked)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ids=st.sets(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=50), blocks=st.integers(1, 64))
def test_spread_blocks_are_few_and_ordered(spark, ids, blocks):
    rows = spark.createDataFrame([(i,) for i in ids], "m BIGINT")
    cut = rows.select("m", ordering.spread_blocks(rows, "m", blocks).alias("b")).orderBy("m").collect()
    buckets = [r.b for r in cut]
    assert buckets == sorted(buckets) and 0 <= buckets[0] and buckets[-1] < blocks


def test_spread_blocks_are_even_with_an_outlier(spark):
    ids = spark.range(20_000).select("id").union(spark.sql("SELECT 9223372036854775807L UNION ALL SELECT -9223372036854775808L"))
    sizes = ids.groupBy(ordering.spread_blocks(ids, "id", 16).alias("b")).count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) <= 2 * 20_002 / 16


def test_id_blocks_of_large_ids(spark):
    ids = [2**62 + i for i in range(2000)] + [-(2**63), -501, -500, -1, 0, 499, 500, 2**63 - 1]
    rows = spark.createDataFrame([(i,) for i in ids], "m BIGINT")
    assert {r.m: r.b for r in rows.select("m", ordering.id_block("m", 500).alias("b")).collect()} == {i: i // 500 for i in ids}


def test_text_ids_are_cut_by_a_prefix(members):
    named = members.select("g", F.format_string("M-%05d", "m").alias("name"), "m")
    prefix = F.substring("name", 1, 5)
    got = hierarchy.balanced_parents(named, ["g"], "name", 7)
    plain = hierarchy.balanced_parents(named, ["g"], "m", 7)
    assert got.exceptAll(plain.select(*got.columns)).isEmpty() and got.count() == 3000
    keyed = hierarchy.sequence_keys(named, ["g"], "name", [F.lit("P")])
    assert keyed.exceptAll(
        hierarchy.sequence_keys(named, ["g"], "m", [F.lit("P")]).select(*keyed.columns)
    ).isEmpty()
    lists = hierarchy.member_lists(named, ["g"], "name", block=prefix).collect()
    assert sum(len(r.members) for r in lists) == 3000 and max(len(r.members) for r in lists) <= 100


def test_roots_of_deep_trees(spark):
    """A chain of a thousand, a star, repeated links, and nodes named in any order."""
    links = [(i, i + 1) for i in range(1000)] + [(2000 + i, 5000) for i in range(50)] + [(5000, 5001), (3, 4), (7000, None)]
    frame = spark.createDataFrame(links, "c long, p long")
    found = {r.c: (r.root, r.depth) for r in hierarchy.roots(frame, "c", "p").collect()}
    want = {i: (1000, 1000 - i) for i in range(1000)} | {2000 + i: (5001, 2) for i in range(50)} | {5000: (5001, 1)}
    assert found == want
    assert hierarchy.roots(frame.where("false"), "c", "p").count() == 0


def test_wrong_hierarchies_raise(spark):
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.roots(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1)], "child long, parent long"))
    with pytest.raises(Exception, match="two parents: 1"):
        hierarchy.roots(spark.createDataFrame([(1, 2), (1, 3)], "child long, parent long"))
