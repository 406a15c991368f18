import json
import random

import pytest

from grovespark.sources import nodes_io as io
from grovespark.sources.manifest import manifest_entries

FIELDS = ["name", "node_type", "description", "parent_id", "children_ids", "sources", "tags"]


def plain(path):
    whole = json.loads(path.read_text("utf-8-sig"))
    nodes = whole["nodes"] if isinstance(whole.get("nodes"), dict) else whole
    return {k: [(v or {}).get(f) for f in FIELDS] + [((v or {}).get("completion") or {}).get("preconditions")] for k, v in nodes.items()}


def read(spark, path):
    rows = io.read_manifest(spark, str(path)).collect()
    out = {r.id: [r[f] for f in FIELDS] + [r.completion.preconditions if r.completion else None] for r in rows}
    assert len(out) == len(rows)
    return out


def manifest(n, seed):
    rng = random.Random(seed)
    rough = ['a "quoted" } brace', "{", "}", '\\', '\\"}', '"nodes": {', "é } ü\n", "", "[{}]", '{"nodes": {']
    nodes = {}
    for i in range(n):
        node = {f: rng.choice(rough + [None]) for f in FIELDS[:4]} | {f: rng.choices(rough, k=rng.randint(0, 3)) for f in FIELDS[4:]}
        if rng.random() < 0.5:
            node["completion"] = {"preconditions": rng.choice(rough), "invariants": None}
        nodes[rng.choice(rough) + str(i)] = node if rng.random() < 0.95 else None
    return nodes


@pytest.mark.parametrize("form", ["bare", "inner", "between", "compact"])
def test_split_manifest_equals_a_plain_parser(spark, tmp_path, form):
    nodes = manifest(400, form)
    head = {"title": 'a } " {"nodes": {', "meta": {"nodes": {"x": {"name": "not a node"}}}, "list": [{"nodes": 1}, {}]}
    whole = {"bare": nodes, "inner": {"version": 1, "nodes": nodes}, "between": head | {"nodes": nodes, "after": {"b": {"name": "no"}}}, "compact": {"nodes": nodes}}[form]
    path = tmp_path / "m.json"
    path.write_text(json.dumps(whole, indent=None if form == "compact" else 1, separators=(",", ":") if form == "compact" else None, ensure_ascii=False), "utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        # many blocks, with cuts in strings, escapes and between the pieces of an entry
        spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
        assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 20
        got = read(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == plain(path)


def test_edges_of_manifests(spark, tmp_path):
    texts = {"empty": "", "none": "{}", "none_inner": '{"nodes": {}}\n', "blank": " \n", "nulls": '{"a": null, "b": null}', "list": '{"nodes": [{"name": "x"}], "a": {"name": "y"}}', "mark": "﻿" + '{"a": {"name": "A"}}', "unclosed": '{"a": {"name": "A"}\n'}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, "utf-8")
    ids = lambda name: sorted(read(spark, tmp_path / name))
    assert [ids(n) for n in ("empty", "none", "none_inner", "blank")] == [[], [], [], []]
    assert ids("nulls") == ["a", "b"] and ids("mark") == ids("unclosed") == ["a"]
    with pytest.raises(Exception, match="no node"):
        ids("list")
    both = tmp_path / "both"
    both.mkdir()
    for i in (1, 2):
        (both / f"{i}.json").write_text(json.dumps({f"n{i}": {"name": "x" * 3}, f"long{i}": {"description": "} " * 200_000}}))
    assert ids("both") == ["long1", "long2", "n1", "n2"]
    for text, what in (('{"a": {"name": "A', "string"), ('{"a": {"name": "A"}, "b": {"c": {"d": 1', "object")):
        (tmp_path / "cut").write_text(text)
        with pytest.raises(ValueError, match=what):
            manifest_entries(spark, str(tmp_path / "cut"))
