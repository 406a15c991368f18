"""Versions with two writers and torn writes, and counters that survive a query that dies after its commit."""

from datetime import datetime, timedelta

import pytest

from grovespark.sources import versions
from grovespark.streaming import jobs


def test_two_writers_and_a_torn_write(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "nodes")
    assert versions.latest_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, path)
    frame = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    versions.commit_version(frame(1), path, 0)
    pinned = versions.read_version(spark, path)
    # both look at the log before either commits: the second finds its number taken when it renames
    seen = versions.versions(spark, path)
    answers = iter([seen])
    real = versions.versions
    versions.commit_version(frame(1, 2), path, 1)
    monkeypatch.setattr(versions, "versions", lambda *a: next(answers, None) or real(*a))
    with pytest.raises(versions.VersionTaken):
        versions.commit_version(frame(7), path, 1)
    monkeypatch.undo()
    assert sorted(r.id for r in versions.read_version(spark, path).collect()) == [1, 2] and [r.id for r in pinned.collect()] == [1]
    assert versions.unnamed_data(spark, path) == []
    # a writer that dies after its data and before its entry
    frame(9).write.parquet(f"{path}/data/torn")
    (tmp_path / "nodes/log/.torn").write_text("{")
    assert versions.latest_version(spark, path) == 1 and versions.unnamed_data(spark, path) == ["torn"]
    versions.commit_version(frame(), path, 2)
    assert versions.read_version(spark, path).count() == 0 and versions.read_version(spark, path, 1).count() == 2
    with pytest.raises(versions.VersionTaken):
        versions.commit_version(frame(3), path, 2)


def test_counters_after_a_query_that_died(spark, tmp_path, monkeypatch):
    t0, src = datetime(2024, 1, 1), tmp_path / "in"
    kind = "task string, ts timestamp, tier string"
    add = lambda rows: spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").json(str(src))
    counters, checkpoint = str(tmp_path / "counters"), str(tmp_path / "cp")

    def run():
        moves = jobs.rating_moves(spark.readStream.schema(kind).json(str(src)), "task", "ts", "tier")
        jobs.fold_counters(moves, counters, checkpoint, "tier", availableNow=True).awaitTermination()

    add([("a", t0, "HIGH"), ("b", t0, "LOW"), ("c", t0, "LOW")])
    run()
    add([("a", t0 + timedelta(minutes=1), "LOW"), ("d", t0, "HIGH")])
    commit = versions.commit_version

    def dies(*args):
        commit(*args)
        raise RuntimeError("the driver is lost after its commit")

    monkeypatch.setattr(versions, "commit_version", dies)
    with pytest.raises(Exception, match="lost after its commit"):
        run()
    monkeypatch.undo()
    run()
    add([("b", t0 + timedelta(minutes=2), "HIGH")])
    run()
    got = {r.tier: r.n for r in versions.read_version(spark, counters).collect()}
    assert got == {"HIGH": 2, "LOW": 2}


def test_flush_function_gets_each_batch_once(spark, tmp_path):
    src, seen = tmp_path / "in", []
    for k in range(3):
        spark.createDataFrame([(k,)], "v int").coalesce(1).write.mode("append").json(str(src))
    stream = spark.readStream.schema("v int").option("maxFilesPerTrigger", 1).json(str(src))
    jobs.flush_each(stream, lambda batch, n: seen.append((n, [r.v for r in batch.collect()])), str(tmp_path / "cp"), availableNow=True).awaitTermination()
    assert [n for n, _ in seen] == [0, 1, 2] and sorted(v for _, vs in seen for v in vs) == [0, 1, 2]
