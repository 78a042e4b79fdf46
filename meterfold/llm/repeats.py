"""Which stretches of a text also start earlier, for windows of a fixed length.

Shared by the two substring operators. They differ in their unit (bytes or words) and in
how they give each window an anchor; both hand over runs of windows that share one:

* ``key`` names the anchor. Equal windows have equal keys.
* ``name`` names all units the run covers, so equal (``key``, ``name``) are equal runs.
* ``start`` and ``count`` are its first window and how many windows it has.

A document is a ``doc_id`` and its text: where an id comes with several texts, ``variant`` is a digest
of the text, else 0. Spark sorts the runs by (key, name, document, start). A run that equals an earlier
one repeats whole. Where different runs share a key, as at the ends of a repeated
passage, their windows are named one by one and sorted again. A key on its own is unique:
none of its windows can occur elsewhere.

Nothing holds a group: the sorted rows are read as a stream that remembers one row. Equal
runs of one batch are settled before the shuffle, and only the first of them is
compared. Keys that many texts share with different names are found on a sample of the
documents; their runs are dealt out by name, each taken to share its key. What the
sample misses costs balance, never a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.llm.text import Block, blocks, mix

#: One document in so many is looked at for keys to spread, and a key that has this
#: share of the sampled runs is one. There are at most as many as the share allows.
SAMPLE_ONE_IN, SPREAD_SHARE = 64, 1 / 20_000

DOC = ("doc_id", "variant")
RUNS = "key bigint, name bigint, doc_id bigint, variant bigint, start int, count int, settled boolean, spread boolean"
MARKS = "doc_id bigint, variant bigint, start int, count int, open boolean"
#: What a first refinement may leave with its rows for a second one without the texts.
DETAILS = ("core", "left", "right", "shift")
_DETAILS = "".join(f", {n} bigint" for n in DETAILS)
_NO_KEYS = np.zeros(0, np.uint64)

#: Runs of a block: key, name, number of the text in the block, first window, windows.
Runs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _documents(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(n).to_numpy(zero_copy_only=False) for n in DOC)


def _emit(docs: tuple[np.ndarray, np.ndarray], parts: list[Runs], hot: np.ndarray = _NO_KEYS) -> pa.RecordBatch:
    """Rows of a batch; a run that equals an earlier one of the batch is settled here."""
    key, name, row, start, count, *more = (np.concatenate(p) for p in zip(*parts))
    doc, variant = docs[0][row], docs[1][row]
    order = np.lexsort((start, variant, doc, name, key))
    key, name, start, count = key[order], name[order], start[order], count[order]
    doc, variant = doc[order], variant[order]
    more = [m[order] for m in more]
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
    lead = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))
    settled = (doc != doc[lead]) | (variant != variant[lead]) | (start != start[lead])
    spread = np.isin(key, hot) if len(hot) else np.zeros(len(key), dtype=bool)
    # A settled run only passes through the sort: it goes anywhere.
    place = mix(doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start.astype(np.uint64))
    key = np.where(settled, place, key)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key.view(np.int64)), pa.array(name.view(np.int64)), pa.array(doc), pa.array(variant),
            pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(settled), pa.array(spread),
            *(pa.array(m.view(np.int64)) for m in more),
        ],
        names=["key", "name", *DOC, "start", "count", "settled", "spread", *DETAILS[: len(more)]],
    )


def _all_runs(runs_of: Callable[[Block], Runs], hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, parts, held = _documents(batch), [], 0
            for block in blocks(batch.column("text")):
                key, name, row, start, count = runs_of(block)
                parts.append((key, name, row + block.first, start, count))
                held += len(key)
                if held > 500_000:
                    yield _emit(docs, parts, hot)
                    parts, held = [], 0
            if parts:
                yield _emit(docs, parts, hot)

    return run


def each_window(row: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows of runs one by one: their texts and starts."""
    inside = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(row, count), np.repeat(start, count) + inside


def _refined(parts_of: Callable[[Block, np.ndarray, np.ndarray, np.ndarray], Runs]):
    """Smaller runs of the open ones that ``open`` lists per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, parts, held = _documents(batch), [], 0
            lists = batch.column("open")
            bounds, flat = lists.offsets.to_numpy(), lists.values
            starts, counts = (flat.field(n).to_numpy().astype(np.int64) for n in ("start", "count"))
            for block in blocks(batch.column("text")):
                own = bounds[block.first : block.first + len(block) + 1]
                row = np.repeat(np.arange(len(block)), np.diff(own))
                key, name, row, *rest = parts_of(block, row, starts[own[0] : own[-1]], counts[own[0] : own[-1]])
                parts.append((key, name, row + block.first, *rest))
                held += len(key)
                if held > 500_000:
                    yield _emit(docs, parts)
                    parts, held = [], 0
            if parts:
                yield _emit(docs, parts)

    return run


def _split(windows_of: Callable[..., tuple[np.ndarray, ...]]):
    """Single windows of refined runs, from the details they carry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = (batch.column(n).to_numpy() for n in ("start", "count", *DETAILS))
                key, name, row, start = windows_of(*columns)
                yield _emit(_documents(batch), [(key, name, row, start, np.ones(len(row), np.int64))])

    return run


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of sorted runs: those that repeat, and those whose windows stay open.

    Of each pair (key, name) the first run is the earliest. It is open if its key has
    another name, or is one of those that are spread.
    """
    last = None  # key, name, doc, variant, start of the first run of the current pair
    pending = None  # that run's mark, while no other name of its key was seen
    shared = False  # whether the current key has several names

    def marks(batch, at, opened):
        own = batch.select([n for n in (*DOC, "start", "count", *DETAILS) if n in batch.schema.names]).take(pa.array(at))
        columns = [*own.columns[:4], pa.array(opened, pa.bool_()), *own.columns[4:]]
        return pa.RecordBatch.from_arrays(columns, names=[*DOC, "start", "count", "open", *own.schema.names[4:]])

    for batch in batches:
        settled = batch.column("settled").to_numpy(zero_copy_only=False)
        (doc, variant), start = _documents(batch), batch.column("start").to_numpy()
        if settled.any():
            yield marks(batch, np.flatnonzero(settled), np.zeros(settled.sum(), bool))
        live = np.flatnonzero(~settled)
        if not len(live):
            continue
        key, name = batch.column("key").to_numpy()[live], batch.column("name").to_numpy()[live]
        spread = batch.column("spread").to_numpy(zero_copy_only=False)[live]
        doc, variant, start = doc[live], variant[live], start[live]
        n = len(key)
        new_key, new_name = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        new_key[1:] = key[1:] != key[:-1]
        new_name[1:] = new_key[1:] | (name[1:] != name[:-1])
        if last is not None:
            new_key[0] = key[0] != last[0]
            new_name[0] = new_key[0] or name[0] != last[1]
        lead = np.maximum.accumulate(np.where(new_name, np.arange(n), -1))
        inside = lead >= 0
        lead_doc, lead_variant, lead_start = doc[lead], variant[lead], start[lead]
        if not inside.all():
            lead_doc[~inside], lead_variant[~inside], lead_start[~inside] = last[2:]
        repeats = (doc != lead_doc) | (variant != lead_variant) | (start != lead_start)
        # Names of each key in this batch; the first key may go on from the one before.
        group = np.cumsum(new_key) - int(new_key[0])
        names = np.bincount(group, weights=new_name, minlength=group[-1] + 1)
        several = names > 1
        several[group[spread]] = True
        if not new_key[0]:
            several[0] |= shared or names[0] > 0
            if pending is not None and several[0]:
                yield pending
                pending = None
        else:
            pending = None
        out = repeats | (new_name & several[group])
        if out.any():
            yield marks(batch, live[out], ~repeats[out])
        final = group[-1]
        if not several[final] and (new_key[0] or final > 0):
            at = int(np.flatnonzero(new_key)[-1])
            pending = marks(batch, live[at : at + 1], [True])
        shared = bool(several[final])
        last = tuple(int(c[-1]) for c in (key, name, lead_doc, lead_variant, lead_start))


def _sorted_marks(runs: DataFrame) -> DataFrame:
    details = _DETAILS if DETAILS[0] in runs.columns else ""
    return (
        runs.repartition("key", F.when(F.col("spread"), F.col("name")))
        .sortWithinPartitions("key", "name", *DOC, "start")
        .mapInArrow(_ranked, MARKS + details)
    )


def _keys_to_spread(rows: DataFrame, runs_of: Callable[[Block], Runs]) -> np.ndarray:
    """Keys with a large share of the runs of a sample; no more than 1 / SPREAD_SHARE of them."""
    some = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_ONE_IN)) == 0)
    runs = some.mapInArrow(_all_runs(runs_of, np.zeros(0, np.uint64)), RUNS).where("not settled")
    counts = runs.groupBy("key").agg(F.count("*").alias("n")).where("n > 4")
    total = F.sum("n").over(Window.partitionBy())
    frequent = counts.orderBy(F.desc("n"), "key").limit(int(1 / SPREAD_SHARE)).withColumn("total", total)
    found = [r["key"] for r in frequent.where(F.col("n") >= F.col("total") * SPREAD_SHARE).collect()]
    return np.array(found, dtype=np.int64).view(np.uint64)


def with_variants(rows: DataFrame) -> DataFrame:
    """Add ``variant``: a digest of the text where its ``doc_id`` has several texts, else 0."""
    digest = F.xxhash64("text")
    several = rows.groupBy("doc_id").agg(F.min(digest).alias("low"), F.max(digest).alias("high")).where("low <> high")
    several = scratch.stored(several.select(F.col("doc_id").alias("several_id")), "several-texts")
    variant = F.when(F.col("several_id").isNotNull(), digest).otherwise(F.lit(0).cast("bigint"))
    joined = rows.join(several, F.col("doc_id") == F.col("several_id"), "left")
    return joined.withColumn("variant", variant).drop("several_id")


def repeated(
    rows: DataFrame,
    runs_of: Callable[[Block], Runs],
    parts_of: Callable[[Block, np.ndarray, np.ndarray, np.ndarray], Runs],
    windows_of: Callable[..., tuple[np.ndarray, ...]] | None = None,
) -> DataFrame:
    """``doc_id``, ``variant`` and ``repeats``, a list of (``start``, ``count``) of windows that start earlier.

    ``rows`` has ``doc_id``, ``variant`` and ``text``. Documents without such windows are not in the
    result. A row without a ``doc_id`` takes no part. Rows with one ``doc_id`` and text are
    one document; texts that share a ``doc_id`` stand in the order of their digests.
    ``parts_of`` refines open runs to single windows, or to smaller runs
    with details from which ``windows_of`` makes the single windows of those still open.
    """
    rows = rows.where("doc_id is not null and text is not null").select(*DOC, "text")
    hot = _keys_to_spread(rows, runs_of)
    marks = scratch.stored(_sorted_marks(rows.mapInArrow(_all_runs(runs_of, hot), RUNS)), "marks")
    still = marks.where("open").groupBy(*DOC).agg(F.collect_set(F.struct("start", "count")).alias("open"))
    parts = rows.join(still, [*DOC]).select(*DOC, "text", "open").mapInArrow(
        _refined(parts_of), RUNS + (_DETAILS if windows_of else "")
    )
    closed = [marks, scratch.stored(_sorted_marks(parts), "marks")]
    if windows_of:
        last = _sorted_marks(closed[1].where("open").mapInArrow(_split(windows_of), RUNS))
        closed.append(scratch.stored(last, "marks"))
    found = None
    for part in closed:
        part = part.where("not open").select(*DOC, "start", "count")
        found = part if found is None else found.union(part)
    return found.groupBy(*DOC).agg(F.collect_set(F.struct("start", "count")).alias("repeats"))


def covered(size: int, starts: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """Marks for the units inside any of these windows; those past the end are ignored."""
    change = np.zeros(size + 1, dtype=np.int64)
    low = np.minimum(starts.astype(np.int64), size)
    np.add.at(change, low, 1)
    np.add.at(change, np.minimum(low + counts + width - 1, size), -1)
    return np.cumsum(change[:-1]) > 0


def lists(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """The starts and counts of each row of ``repeats``, None for a null."""
    bounds = column.offsets.to_numpy()
    starts, counts = column.values.field("start").to_numpy(), column.values.field("count").to_numpy()
    missing = column.is_null().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield None if missing[i] else (starts[bounds[i] : bounds[i + 1]], counts[bounds[i] : bounds[i + 1]])
