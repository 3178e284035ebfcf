"""Dumps read in splits, in batch and as a stream."""

import random

import pytest

from postmill.sources import dumps
from postmill.sources.collections import with_ids


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    spark.dataSource.register(dumps.DumpSource)


def load(spark, path, split_bytes):
    reader = spark.read.format(dumps.NAME).option("path", str(path)).option("splitBytes", split_bytes)
    return [tuple(r) for r in reader.load().orderBy("path", "position").collect()]


def test_positions_do_not_depend_on_splits(spark, tmp_path):
    rng = random.Random(5)
    wanted = []
    for name in ("a.json", "b/c.json", "empty.json"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        lines = [] if name == "empty.json" else ["ä" * rng.choice([0, 1, 5, 200, 3000]) + str(n) for n in range(200)]
        ends = [rng.choice(["\n", "\r\n"]) for _ in lines]
        if ends:
            ends[-1] = ""
        raw = "".join(line + end for line, end in zip(lines, ends, strict=True)).encode()
        path.write_bytes(raw)
        at = 0
        for line, end in zip(lines, ends, strict=True):
            wanted.append((str(path), at, line))
            at += len((line + end).encode())
    (tmp_path / "_SUCCESS").write_text("x")
    (tmp_path / ".part.crc").write_text("x")
    for split_bytes in (1 << 30, 50_000, 997):
        assert load(spark, tmp_path, split_bytes) == sorted(wanted)
    assert load(spark, tmp_path / "a.json", 10_000) == [w for w in sorted(wanted) if w[0].endswith("a.json")]
    assert load(spark, tmp_path / "nothing", 10) == []


def test_lines_longer_than_a_split_and_a_read(tmp_path, monkeypatch):
    monkeypatch.setattr(dumps, "READ_BYTES", 16)
    path = tmp_path / "a"
    lines = ["x" * 100, "", "y" * 17, "z", "w" * 40]
    path.write_text("\n".join(lines) + "\n")
    for split_bytes in (1, 7, 33, 1000):
        rows = [r for s in dumps.splits({str(path): (0, path.stat().st_size)}, split_bytes) for b in dumps.read_split(s) for r in b.to_pylist()]
        assert [r["doc"] for r in rows] == lines and [r["position"] for r in rows] == [0, 101, 102, 120, 122]


def test_a_stream_goes_on_in_grown_files(spark, tmp_path):
    landing, target, checkpoint = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    landing.mkdir()

    def run():
        stream = spark.readStream.format(dumps.NAME).option("path", str(landing)).option("splitBytes", 8).load()
        query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(once=True).start(target)
        query.awaitTermination()
        return sorted((r.doc, r.position) for r in spark.read.parquet(target).collect())

    (landing / "a").write_text("one\ntwo\nthr")
    assert run() == [("one", 0), ("two", 4)]
    with open(landing / "a", "a") as file:
        file.write("ee\nfour\n")
    (landing / "b").write_text("x\n")
    assert run() == [("four", 14), ("one", 0), ("three", 8), ("two", 4), ("x", 0)]
    assert len(run()) == 5


def test_order_holds_after_a_shuffle(spark, tmp_path):
    (tmp_path / "a").write_text("\n".join(f'{{"_id":"d{n}"}}' for n in range(500)))
    lines = dumps.with_positions(spark.read.format(dumps.NAME).option("path", str(tmp_path)).option("splitBytes", 300).load())
    again = with_ids(lines.repartition(7)).orderBy("scan").collect()
    assert [r._id for r in again] == [f"d{n}" for n in range(500)]
