"""A log that is appended to: every whole line once, across batches and restarts."""

from __future__ import annotations

import random

import pytest

from meterfold.sources import growing
from meterfold.streaming import cascade


def _lines_of(reader, start, end):
    found = []
    for split in reader.partitions(start, end):
        for batch in reader.read(split):
            found += [(r["position"], r["value"]) for r in batch.to_pylist()]
    return found


@pytest.mark.parametrize("split", [1, 2, 7, 64, 10**6])
def test_splits_own_the_lines_that_start_in_them(tmp_path, split):
    rng = random.Random(split)
    lines = ["x" * rng.choice((0, 1, 3, 10, 200)) + rng.choice(("", "é")) for _ in range(60)]
    path = tmp_path / "log"
    path.write_bytes("".join(f"{v}\n" for v in lines).encode() + b"not whole")
    reader = growing.LogReader(str(path), split)
    end = reader.latestOffset()
    found = _lines_of(reader, reader.initialOffset(), end)
    assert [v for _, v in found] == lines
    data = path.read_bytes()
    assert all(data[p:].startswith(f"{v}\n".encode()) for p, v in found)
    with path.open("ab") as file:
        file.write(b" yet\nnext\n")
    assert [v for _, v in _lines_of(reader, end, reader.latestOffset())] == ["not whole yet", "next"]


def test_no_line_end_yet(tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "_LOOK_BACK", 4)
    path = tmp_path / "log"
    path.write_bytes(b"")
    reader = growing.LogReader(str(path), 100)
    assert reader.latestOffset() == {str(path): 0}
    path.write_bytes(b"a long beginning")
    assert reader.latestOffset() == {str(path): 0}
    path.write_bytes(b"\na long beginning")
    assert reader.latestOffset() == {str(path): 1}
    path.write_bytes(b"a long beginning\n")
    assert reader.latestOffset() == {str(path): 17}


def test_a_shorter_file_is_an_error(tmp_path):
    path = tmp_path / "log"
    path.write_bytes(b"one\ntwo\n")
    reader = growing.LogReader(str(path), 100)
    held = reader.latestOffset()
    path.write_bytes(b"one\n")
    with pytest.raises(ValueError, match="shorter"):
        reader.partitions(held, reader.latestOffset())


def test_stream_over_appends_and_a_restart(spark, tmp_path):
    folder, out, state = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    (folder / "_hidden").write_bytes(b"never\n")
    want = []
    for turn in range(3):
        for name in ("a.jsonl", "b.jsonl", "c.jsonl")[: turn + 1]:
            lines = [f"{name} {turn} {i}" for i in range(40)]
            want += lines
            with (folder / name).open("a") as file:
                file.write("".join(f"{v}\n" for v in lines))
        with (folder / "a.jsonl").open("a") as file:
            file.write(f"half {turn}")
        cascade.run_to_files(growing.stream_lines(spark, str(folder), 256), out, state)
        with (folder / "a.jsonl").open("a") as file:
            file.write(" rest\n")
        assert sorted(r["value"] for r in spark.read.parquet(out).collect()) == sorted(want)
        want.append(f"half {turn} rest")
    found = spark.read.parquet(out)
    assert found.dropDuplicates(["file", "position"]).count() == found.count()


def test_envelopes(spark, tmp_path):
    path = tmp_path / "log"
    path.write_text('{"topic":"t","key":"k","value":{"a":1}}\n\n')
    cascade.run_to_files(growing.stream_envelopes(spark, f"file://{path}"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("t", "k", '{"a":1}')]


def test_tasks_do_not_multiply_with_the_splits(tmp_path, monkeypatch):
    """Tasks follow the bytes, not the splits; each byte belongs to one of them."""
    for name, lines in (("a", 5000), ("b", 3), ("c", 9000)):
        (tmp_path / name).write_bytes(b"".join(b"%d\n" % i for i in range(lines)))
    reader = growing.LogReader(str(tmp_path), 16)
    end = reader.latestOffset()
    shares = reader.partitions({}, end)
    assert len(shares) <= growing.TASKS + 1
    for name, high in end.items():
        runs = [r for s in shares for r in s.runs if r.name == name]
        assert [r.low for r in runs] == [0, *(r.high for r in runs[:-1])] and runs[-1].high == high
        assert [r.whole for r in runs] == [True] + [False] * (len(runs) - 1)
    found = _lines_of(reader, {}, end)
    assert len(found) == 14003
    monkeypatch.setattr(growing, "TASK_BYTES", 100)
    assert all(sum(r.high - r.low for r in s.runs) < 100 + 16 for s in reader.partitions({}, end))
    assert _lines_of(reader, {}, end) == found
    assert len(growing.LogReader(str(tmp_path), 10**6).partitions({}, end)) <= 3
