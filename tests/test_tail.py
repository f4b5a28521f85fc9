"""Streams over growing files and topic folders."""

import json
import os

import pytest
from pyspark.sql import functions as F

from merchlens.sources import tail
from merchlens.streaming import topic_folder


def run(lines, checkpoint, out):
    """One run of a stream into a table, until all that is there has been read."""
    writer = lines.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint))
    writer.trigger(availableNow=True).start().awaitTermination()


def values(spark, out):
    return sorted(r["value"] for r in spark.read.parquet(str(out)).collect())


def append(path, data):
    with open(path, "ab") as file:
        file.write(data)


def test_appended_lines_come_once(spark, tmp_path):
    logs, out, at = tmp_path / "logs", tmp_path / "out", tmp_path / "at"
    logs.mkdir()
    append(logs / "a.log", b"one\ntwo\nthr")
    append(logs / ".hidden", b"no\n")
    (logs / "_tmp").mkdir()
    append(logs / "_tmp" / "x", b"no\n")
    run(tail.tail_lines(spark, str(logs)), at, out)
    assert values(spark, out) == ["one", "two"]
    append(logs / "a.log", b"ee\r\nfour\n\xff\n")
    (logs / "sub").mkdir()
    append(logs / "sub" / "b.log", b"\nother\n")
    run(tail.tail_lines(spark, str(logs)), at, out)  # a new query from the checkpoint
    run(tail.tail_lines(spark, str(logs)), at, out)
    assert values(spark, out) == sorted(["one", "two", "three", "four", "�", "", "other"])
    append(logs / "a.log", b"half")
    run(tail.tail_lines(spark, str(logs)), at, out)
    append(logs / "a.log", b" a line\n")
    run(tail.tail_lines(spark, str(logs)), at, out)
    assert len(values(spark, out)) == 8 and "half a line" in values(spark, out)


def test_start_offsets(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    append(logs / "a", b"a0\na1\n")
    append(logs / "b", b"b0\nb1\n")
    starts = {"earliest": "earliest", "latest": "latest", "stated": json.dumps({"a": 3})}
    for name, start in starts.items():
        run(tail.tail_lines(spark, str(logs), start), tmp_path / f"at-{name}", tmp_path / name)
    append(logs / "b", b"b2\n")
    append(logs / "c", b"c0\n")
    for name, start in starts.items():
        run(tail.tail_lines(spark, str(logs), start), tmp_path / f"at-{name}", tmp_path / name)
    assert values(spark, tmp_path / "earliest") == ["a0", "a1", "b0", "b1", "b2", "c0"]
    assert values(spark, tmp_path / "latest") == ["b2", "c0"]
    assert values(spark, tmp_path / "stated") == ["a1", "b0", "b1", "b2", "c0"]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 10**6])
def test_ranges_split_between_lines(tmp_path, size):
    """Whatever the ranges, they give every line once and its place."""
    texts = ["", "a", "bc", "", "x" * 200_000, "é" * 30, "last"]
    data = "".join(t + "\n" for t in texts).encode()
    (tmp_path / "f").write_bytes(data + b"unfinished")
    reader = tail.LogTailReader({"path": f"file://{tmp_path}", "rangebytes": str(max(size, len(data) // 3000))})
    end = reader.latestOffset()
    assert end == {"f": len(data)}
    rows = [r for p in reader.partitions({}, end) for b in reader.read(p) for r in b.to_pylist()]
    rows.sort(key=lambda r: r["offset"])
    assert [r["value"] for r in rows] == texts
    for r in rows:
        assert data[r["offset"] :].startswith(r["value"].encode() + b"\n")


def test_long_unfinished_line_and_cut_file(tmp_path):
    (tmp_path / "f").write_bytes(b"ab\n" + b"y" * 200_000)
    reader = tail.LogTailReader({"path": str(tmp_path)})
    assert reader.latestOffset() == {"f": 3}
    assert [(p.start, p.end) for p in reader.partitions({"f": 50}, {"f": 3})] == [(0, 3)]
    assert reader.partitions({"f": 3}, {"f": 3}) == []
    assert tail.LogTailReader({"path": str(tmp_path / "none")}).latestOffset() == {}


PAYLOADS = [f"{u}|{p}|{s}|{1000 + p}" for p in range(40) for u, s in ((p % 5, 3.0), (7, 1.0))]


def test_topic_keeps_a_users_order(spark, tmp_path):
    logs, topic = tmp_path / "logs", str(tmp_path / "topic")
    logs.mkdir()
    for part, begin in (("a", 0), ("b", 50)):
        append(logs / part, "".join(x + "\n" for x in PAYLOADS[begin : begin + 50]).encode())
        lines = tail.tail_lines(spark, str(logs))
        topic_folder.write_topic_folder(lines, topic, str(tmp_path / "at"), True, 4).awaitTermination()
    found = {}
    for where, _, names in sorted(os.walk(topic)):
        for name in sorted(n for n in names if n.startswith("part-")):
            for line in open(os.path.join(where, name)).read().splitlines():
                found.setdefault(line.split("|")[0], []).append((where.rpartition("=")[2], line))
    for user, lines in found.items():
        assert [x for _, x in lines] == [x for x in PAYLOADS if x.split("|")[0] == user]
        assert len({p for p, _ in lines}) == 1
    run(topic_folder.read_topic_folder(spark, topic), tmp_path / "at2", tmp_path / "out")
    assert values(spark, tmp_path / "out") == sorted(PAYLOADS)


def test_failed_batch_is_not_seen(spark, tmp_path):
    topic = str(tmp_path / "topic")
    good = spark.createDataFrame([("1|1|1.0|5",), ("no user",)], "value string")
    assert topic_folder.write_batch(good, topic, 0, 2)
    assert not topic_folder.write_batch(good, topic, 0, 2)  # again after the marker: nothing
    fails = F.udf(lambda v: 1 // 0 if v == "3" else v)
    bad = spark.createDataFrame([(str(k),) for k in range(8)], "value string").repartition(4)
    with pytest.raises(Exception):
        topic_folder.write_batch(bad.withColumn("value", fails("value")), topic, 1, 2)
    assert {n.split("/")[0] for n in tail.files_below(topic, topic_folder.MARKER)} == {"batch_id=000000000000"}
    assert topic_folder.write_batch(bad, topic, 1, 2)
    run(topic_folder.read_topic_folder(spark, topic), tmp_path / "at", tmp_path / "out")
    assert values(spark, tmp_path / "out") == sorted(["1|1|1.0|5", "no user", *map(str, range(8))])
