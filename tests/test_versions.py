"""Committed batches: once, whole, and unchanged under an open reader."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from meterfold.sources import history, messages, versions


def _lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def _read(spark, path, **options):
    return sorted(r["value"] for r in versions.read(spark, path, **options).collect())


def _messages(spark, topic, n):
    rows = spark.range(n).select(F.lit(topic).alias("topic"), F.col("id").cast("string").alias("key"), F.lit('{"a":1}').alias("value"))
    return rows.repartition(3)


def test_a_repeated_batch_counts_once(spark, tmp_path):
    target = messages.Target(path=str(tmp_path / "log"))
    for batch in ("a", "b", "a", "b"):
        messages.publish(_messages(spark, batch, 50), target, batch=batch)
    found = messages.read_committed(spark, target.path).groupBy("topic").count().collect()
    assert {r["topic"]: r["count"] for r in found} == {"a": 50, "b": 50}
    assert versions.versions(spark, target.path) == [1, 2]


def test_a_batch_that_fails_half_way_is_not_read(spark, tmp_path):
    """Some tasks have written when the job dies; its repetition is read once."""
    path = str(tmp_path / "log")
    target = messages.Target(path=path)
    messages.publish(_messages(spark, "good", 20), target, batch="1")

    broken = _messages(spark, "bad", 40).withColumn(
        "value", F.when(F.col("key") == "39", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("value"))
    )
    with pytest.raises(Exception, match="lost"):
        messages.publish(broken, target, batch="2")
    # Written whole, but the driver is lost before the commit.
    versions.write(messages.envelope_lines(_messages(spark, "bad", 40)), path, "2")
    assert messages.read_committed(spark, path).count() == 20
    messages.publish(_messages(spark, "bad", 40), target, batch="2")
    messages.publish(_messages(spark, "bad", 40), target, batch="2")
    found = messages.read_committed(spark, path).groupBy("topic", "key").count().collect()
    assert len(found) == 60 and {r["count"] for r in found} == {1}


def test_one_of_two_writers_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    base = versions.manifest(spark, path)
    assert base == versions.Manifest() and versions.read(spark, path).count() == 0
    one, two = (versions.write(_lines(spark, v), path, v) for v in ("x", "y"))
    versions.commit(spark, path, base, one[0], written=one[1])
    with pytest.raises(versions.Conflict):
        versions.commit(spark, path, base, two[0], written=two[1])
    assert _read(spark, path) == ["x"]
    assert versions.append(_lines(spark, "y"), path, "y") and not versions.append(_lines(spark, "z"), path, "y")
    assert _read(spark, path) == ["x", "y"] and _read(spark, path, version=1) == ["x"]


def test_append_goes_on_from_the_newer_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write = versions.write

    def slow(rows, *args):
        found = write(rows, *args)
        monkeypatch.setattr(versions, "write", write)
        versions.append(_lines(spark, "other"), path, "other")
        return found

    monkeypatch.setattr(versions, "write", slow)
    assert versions.append(_lines(spark, "own"), path, "own")
    assert _read(spark, path) == ["other", "own"]


def test_verified_finds_damage(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(100).select(F.col("id").cast("string").alias("value"), (F.col("id") % 3).alias("part"))
    versions.append(rows, path, "whole", by="part")
    versions.append(_lines(spark, "é", "", "x y"), path, "small")
    assert all(r["ok"] for r in versions.verified(spark, path).collect())
    (segment,) = [s for s in versions.manifest(spark, path).segments if s.batch == "small"]
    part = next(f for f in os.listdir(segment.path) if f.startswith("part-") and os.path.getsize(f"{segment.path}/{f}"))
    with open(f"{segment.path}/{part}", "a") as file:
        file.write("more\n")
    os.remove(f"{segment.path}/.{part}.crc")
    assert {r["batch"]: r["ok"] for r in versions.verified(spark, path).collect()} == {"whole": True, "small": False}


def _log_lines(spark, days, per_day, shift=0):
    rows = []
    for d in range(days):
        for w in range(per_day):
            start = f"2026-05-{d + 1:02d}T{w:02d}:00:00"
            rows += [(f'{{"kind":"district","district":"D{k}","window_start":"{start}","total_meters":{k + shift}}}',) for k in range(3)]
            rows.append((f'{{"kind":"cycle","cycle_start":"{start}","cycle_id":{w}}}',))
    return spark.createDataFrame(rows + [("no window here",), ("",)], "value string")


def test_flat_log_is_trimmed_under_an_open_reader(spark, tmp_path):
    flat, path = str(tmp_path / "history.jsonl"), str(tmp_path / "log")
    lines = [r["value"] for r in _log_lines(spark, 6, 10).collect()]
    with open(flat, "w") as file:
        file.write("\n".join(lines) + "\n")
    assert history.adopt_flat(spark, flat, path) and not history.adopt_flat(spark, flat, path)
    opened = history.committed_lines(spark, path)
    assert sorted(r["value"] for r in opened.collect()) == sorted(lines)
    files = {s.path for s in versions.manifest(spark, path).segments}

    history.trim_committed(spark, path, 14)  # all of day 6, the last 4 windows of day 5
    kept = [r["value"] for r in history.committed_lines(spark, path).collect()]
    want = [v for v in lines if '"2026-05-06T' in v or any(f'"2026-05-05T0{h}:' in v for h in "6789")]
    assert sorted(kept) == sorted([*want, "no window here", ""])
    after = versions.manifest(spark, path)
    assert sum(s.path in files for s in after.segments) == 2  # day 6 and the lines without a window
    assert history.trim_committed(spark, path, 14) == after.version
    assert sorted(r["value"] for r in opened.collect()) == sorted(lines)
    assert history.trim_committed(spark, path, 1000) == history.trim_committed(spark, path, 0) == after.version

    gone = versions.vacuum(spark, path, keep=1)
    assert len(gone) == 5 and not any(os.path.exists(g) for g in gone)
    assert len(history.committed_lines(spark, path).collect()) == len(kept)
    with pytest.raises(ValueError):
        history.trim_committed(spark, path, -1)
    with pytest.raises(ValueError):
        versions.vacuum(spark, path, keep=0)


def test_windows_spread_over_days_are_counted_once_each(spark, tmp_path):
    """Two batches share their days: a window in both counts as one."""
    path = str(tmp_path / "log")
    for shift in (0, 5):
        flat = str(tmp_path / f"flat-{shift}")
        _log_lines(spark, 3, 4, shift).write.text(flat)
        history.adopt_flat(spark, flat, path)
    history.trim_committed(spark, path, 5)
    rows = history.parse_lines(history.committed_lines(spark, path)).where("kind = 'district'")
    assert rows.count() == 5 * 3 * 2
    assert rows.agg(F.min("window_start")).first()[0] == "2026-05-02T03:00:00"
