import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from grovespark.functions import rules
from grovespark.operators import lexicon, reports
from grovespark.sources import nodes_io as io
from grovespark.streaming import jobs

T0 = datetime(2024, 1, 1)


def test_manifest_and_published(spark, tmp_path):
    node = {"id": "a", "name": "A", "node_type": "domain", "children_ids": ["a/b"]}
    leaf = {"name": "B", "node_type": "atomic", "parent_id": "a", "completion": {"preconditions": "dry"}}
    (tmp_path / "m.json").write_text(json.dumps({"version": 1, "node_count": 2, "nodes": {"a": node, "a/b": leaf}}, indent=1))
    (tmp_path / "bare.json").write_text(json.dumps({"a": node}))
    rows = io.read_manifest(spark, str(tmp_path / "m.json"))
    assert {r.id for r in rows.collect()} == {"a", "a/b"}
    assert [r.name for r in io.read_manifest(spark, str(tmp_path / "bare.json")).collect()] == ["A"]
    out = io.to_published(rows)
    assert {(r.id, r.depth, r.is_leaf, r.preconditions) for r in out.collect()} == {("a", 1, False, ""), ("a/b", 2, True, "dry")}
    back = {r.id: r for r in io.from_published(out).collect()}
    assert back["a"].completion is None and back["a/b"].completion.preconditions == "dry" and back["a"].parent_id is None


def test_lines_seeds_and_versions(spark, tmp_path):
    assert io.read_jsonl(spark, str(tmp_path / "none"), "id string").count() == 0
    log = str(tmp_path / "log")
    df = spark.createDataFrame([("a",), ("b",)], "id string")
    io.append_jsonl(df, log)
    io.append_jsonl(df, log)
    assert io.read_jsonl(spark, log, "id string").count() == 4
    (tmp_path / "s.tsv").write_text("code\ttitle\n 11-1011 \tChief\n\tnone\n5312\tX\n")
    assert [(r.code, r.major_group) for r in io.read_tsv_seed(spark, str(tmp_path / "s.tsv"), "code").collect()] == [("11-1011", "11"), ("5312", "53")]
    assert io.commit_snapshot(df, str(tmp_path / "v"), 1).count() == 2
    with pytest.raises(Exception, match="(?i)exist"):
        io.commit_snapshot(df, str(tmp_path / "v"), 1)


def test_upsert(spark):
    nodes = spark.createDataFrame([("a", None, "old")], "id string, parent_id string, name string")
    changes = spark.createDataFrame([("a", None, "new", 2), ("a", None, "mid", 1), ("a/b", "a", "b", 3), ("z/y", "z", "y", 4)], "id string, parent_id string, name string, o int")
    done, rejected = io.upsert_nodes(nodes, changes, "o")
    assert {(r.id, r.name) for r in done.collect()} == {("a", "new"), ("a/b", "b")} and [r.id for r in rejected.collect()] == ["z/y"]


def test_yaml_tree(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "x.yaml").write_text("id: a\nname: A\n")
    (tmp_path / "y.yaml").write_text("name: [\n")
    assert {(r.id, r.corrupt) for r in io.read_yaml_tree(spark, str(tmp_path)).collect()} == {("a", False), (None, True)}


def events(spark, tmp_path, rows, schema):
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).write.mode("append").json(path)
    return spark.readStream.schema(schema).json(path)


def drain(spark, df, name, mode):
    df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).collect()


def test_stream_judge(spark, tmp_path):
    s = events(spark, tmp_path, [("wash dishes", ""), ("calibrate arm", "")], "name string, description string")
    judged = F.coalesce(F.concat(F.lit("robot_internal:"), rules.match_rules(F.lower("name"), ["calibrate"])), F.lit("ok"))
    jobs.judge(s, judged, str(tmp_path / "ok"), str(tmp_path / "no"), str(tmp_path / "cp"), availableNow=True).awaitTermination()
    assert [r.name for r in spark.read.parquet(str(tmp_path / "ok")).collect()] == ["wash dishes"]
    assert [r.verdict for r in spark.read.parquet(str(tmp_path / "no")).collect()] == ["robot_internal:calibrate"]


def test_stream_windows_and_latest(spark, tmp_path):
    rows = [(1, T0, "a", 1), (1, T0 + timedelta(minutes=5), "b", 2), (1, T0 + timedelta(hours=2), "a", 3), (2, T0, "c", 4), (2, T0, "c", 4)]
    s = events(spark, tmp_path, rows, "u int, ts timestamp, tier string, e int")
    assert {(r.u, r.tier) for r in drain(spark, jobs.latest(s, "u", "ts", "tier"), "m_latest", "complete")} == {(1, "a"), (2, "c")}
    assert {(r.tier, r.n) for r in drain(spark, jobs.counts(s, "tier"), "m_counts", "complete")} == {("a", 2), ("b", 1), ("c", 2)}
    assert len(drain(spark, jobs.first_wins(s, "e", "ts"), "m_first", "append")) == 4
    assert {(r.u, r.n) for r in drain(spark, jobs.sessions(s, "u", "ts"), "m_sessions", "append")} >= {(1, 2), (2, 2)}
    assert {(r.tier, r.n) for r in drain(spark, jobs.rate(s, "ts", "tier"), "m_rate", "update")} == {("a", 1), ("b", 1), ("c", 2)}


def test_stream_cutoff(spark, tmp_path):
    s = events(spark, tmp_path, [("p", i, bad) for i, bad in enumerate([False, True, True, False, True, False])], "p string, i int, bad boolean")
    assert sorted(r.i for r in drain(spark, jobs.reject_cutoff(s, "p", "i", "bad"), "m_cut", "append")) == [0, 3]


def test_lexicon_and_reports(spark):
    names = spark.createDataFrame([("1", "pick_up cup"), ("2", "pick"), ("3", None), ("4", "picking")], "id string, name string")
    phrases = spark.createDataFrame([("pick",), ("pick up",)], "phrase string")
    assert {(r.id, r.phrase) for r in lexicon.prefix_match(names, phrases, 2).collect()} == {("1", "pick up"), ("2", "pick")}
    e = spark.createDataFrame([(T0,), (T0,), (T0 + timedelta(days=1),)], "ts timestamp")
    assert [r.done for r in reports.progress(e, "ts").orderBy("minute").collect()] == [2, 3]


def test_stream_rating_moves(spark, tmp_path):
    schema = "u int, ts timestamp, tier string"
    for n, rows in enumerate([[(1, T0, "a"), (2, T0, "a")], [(1, T0 + timedelta(minutes=5), "b"), (2, T0 - timedelta(minutes=5), "c")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "in" / f"n={n}"))
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").json(str(tmp_path / "in"))
    moves = {}
    for r in drain(spark, jobs.rating_moves(s, "u", "ts", "tier"), "m_moves", "append"):
        moves[r.tier] = moves.get(r.tier, 0) + r.delta
    # user 2's later arrival is the older rating; in whichever order the files come, the counters end alike
    assert {k: v for k, v in moves.items() if v} == {"a": 1, "b": 1}
