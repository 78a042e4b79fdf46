"""Building and checking the hierarchy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.functions import text
from meterfold.operators import ordering

LIST_BLOCK = 10_000


def level_counts(levels: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row: number of distinct ids in each level."""
    (first, (rows, column)), *others = levels.items()
    result = rows.agg(F.count_distinct(column).alias(first))
    for name, (rows, column) in others:
        counted = rows.agg(F.count_distinct(column).alias("v")).scalar()
        result = result.withColumn(name, counted)
    return result


def control_totals(
    rows: DataFrame, keys: Sequence[str], declared: Column, actual: Column
) -> DataFrame:
    """Declared and summed totals side by side, with a verdict."""
    sums = rows.groupBy(*keys).agg(declared.alias("declared"), actual.alias("actual"))
    return sums.withColumn("ok", F.col("declared").eqNullSafe(F.col("actual")))


def require_totals(checked: DataFrame) -> None:
    """Raise when a control total is off; the error names the number and the first five."""
    wrong = checked.where(~F.col("ok"))
    shown = wrong.take(5)
    if shown:
        raise ValueError(
            f"control totals differ in {wrong.count()} groups, such as {[r.asDict() for r in shown]}"
        )


def balanced_parents(
    members: DataFrame,
    group: Sequence[str],
    member: str,
    parents: int,
    parent: str = "parent_no",
    partitions: int | None = None,
) -> DataFrame:
    """Spread the members of each group over ``parents`` parents in id order.

    Every parent gets n div k members and the first n mod k one more. The place
    of a member comes from :func:`ordering.sorted_positions`: ids of any type that
    sorts, and a group with a third of all members lies in many ranges.
    """
    placed = ordering.sorted_positions(
        members, [member], keys=group, position="_place", total="_size", partitions=partitions
    )
    base = F.floor(F.col("_size") / F.lit(parents))
    longer = F.col("_size") - base * F.lit(parents)
    cut = longer * (base + 1)
    in_longer = F.ceil(F.col("_place") / (base + 1))
    in_shorter = longer + F.ceil((F.col("_place") - cut) / F.nullif(base, F.lit(0)))
    number = F.when(F.col("_place") <= cut, in_longer).otherwise(in_shorter)
    return placed.withColumn(parent, number.cast("int")).drop("_place", "_size")


def sequence_keys(
    members: DataFrame,
    group: Sequence[str],
    member: str,
    parts: Sequence[Column],
    key: str = "member_key",
    width: int = 5,
    partitions: int | None = None,
) -> DataFrame:
    """Number the members of each group and build ``PFX-CODE-MTR-00001`` keys."""
    placed = ordering.sorted_positions(
        members, [member], keys=group, position="_place", partitions=partitions
    )
    return placed.withColumn(
        key, text.sequence_key(list(parts), F.col("_place"), width)
    ).drop("_place")


def roots(links: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """``child``, ``root`` and ``depth`` of every node that has a parent, however deep it lies.

    Pointer doubling: every node points to an ancestor and knows how far off it is; a round
    replaces the pointer by that of the ancestor, so distances double and a chain of
    a thousand takes ten rounds. A node whose pointer has no parent is done and leaves
    the rounds. Repeated links are one; a null parent is none. A child with two
    parents, or a cycle, raises an error.
    """
    two = F.raise_error(F.concat(F.lit("two parents: "), F.col(child).cast("string"))).cast("string").isNull()
    held = links.where(F.col(child).isNotNull() & F.col(parent).isNotNull()).groupBy(child).agg(
        F.min(parent).alias("root"), F.max(parent).alias("_other")
    )
    single = F.when(F.col("root") == F.col("_other"), F.lit(True)).otherwise(two)
    waiting = scratch.stored(
        held.where(single).select(F.col(child).alias("child"), "root", F.lit(1).cast("bigint").alias("depth")), "pointers"
    )
    nodes, reach, done = waiting.count(), 1, waiting.where("false")
    while not waiting.isEmpty():
        if reach > nodes:
            raise ValueError(f"the hierarchy has a cycle, through {waiting.first()['child']}")
        step = waiting.unionByName(done).select(
            F.col("child").alias("_at"), F.col("root").alias("_up"), F.col("depth").alias("_more")
        )
        moved = waiting.join(step, F.col("root") == F.col("_at"), "left").select(
            "child",
            F.coalesce("_up", "root").alias("root"),
            (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"),
            F.col("_at").isNull().alias("_done"),
        )
        moved = scratch.stored(moved, "pointers")
        done = done.unionByName(moved.where("_done").drop("_done"))
        waiting = moved.where("not _done").drop("_done")
        reach *= 2
    return done.withColumnRenamed("child", child)


def member_lists(
    members: DataFrame, group: Sequence[str], member: str, block: int | Column = LIST_BLOCK
) -> DataFrame:
    """Members of each group as sorted lists, one list per block of ids.

    A group larger than a block gives several rows, told apart by ``block``, so
    a list has at most ``block`` entries and every member is in exactly one. For
    ids that are not whole numbers ``block`` is the column to cut by.
    """
    cut = ordering.id_block(member, block) if isinstance(block, int) else block
    placed = members.withColumn("block", cut)
    return placed.groupBy(*group, "block").agg(
        F.array_sort(F.collect_list(member)).alias("members"),
        F.count(F.lit(1)).alias("n_members"),
    )
