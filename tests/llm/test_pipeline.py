import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline

WORDS = [a + b + c for a in ("sto", "ver", "lan", "mid", "hor") for b in ("ne", "ta", "ri", "mo") for c in ("s", "n", "ling", "ter", "den", "ber")]


def corpus():
    """Clean texts, toxic ones, one without letters, repeated lines and near copies."""
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    docs, toxic, expected = {}, set(), {}
    for k in range(60):
        docs[k] = expected[k] = say(60) + "."
    for k in range(100, 140):
        docs[k] = f"{say(10)} idiot {say(10)}"
        toxic.add(k)
    docs[201] = "12345 67890"
    docs[202], expected[202] = docs[0] + "\n" + "a line of its own: " + say(20), "a line of its own: "
    expected[202] = docs[202].split("\n")[1]
    words = (say(200)).split()
    docs[203] = expected[203] = " ".join(words)
    words[77] = "changed"
    docs[204] = "\n".join([" ".join(words[:100]), " ".join(words[100:])])  # another line layout: no line is a near copy
    return docs, toxic, expected


def test_stages_drop_what_they_should_and_keep_the_rest(spark, tmp_path):
    docs, toxic, expected = corpus()
    rows = [(k, t, "en", "s", len(t)) for k, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, int(k in toxic)) for k in docs if k < 200], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "line_dedup", "near_dedup", "packing"]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {k: len(tok.encode(t, add_special_tokens=False).ids) + 1 for k, t in expected.items()}
    got = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_stages_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_on_rough_rows(spark, tmp_path):
    """Null texts and keys, repeated rows, ties, a very long text and columns with working names; what each stage says of them."""
    docs, toxic, expected = corpus()
    long = " ".join(WORDS[(k * k + k // 7) % len(WORDS)] + "s" * (k % 3) for k in range(20_000))
    rows = [(k, t) for k, t in docs.items()] + [(0, docs[0]), (1, docs[1]), (300, docs[3]), (301, None), (302, ""), (303, long), (None, "ver" + docs[5]), (None, None), (None, docs[110])]
    names = "id key n part hashes norm fp tx".split()
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in names)
    spark.createDataFrame([(k, t, "en", None, len(t or ""), *range(len(names))) for k, t in rows], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, int(k in toxic)) for k in docs if k < 200] + [(None, 1, 1), (0, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    d, out = str(tmp_path), spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = out.columns
        out = corpus_pipeline.materialize(stage(spark, out, d))
        assert out.columns == before
        kept[name] = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    # toxic texts go, whatever their key; null and empty texts are clean, but have no language
    assert kept["toxicity"] == sorted(((k, t) for k, t in rows if k not in toxic and t != docs[110]), key=str)
    lettered = [(k, t) for k, t in rows if k not in toxic and t != docs[110] and t and k != 201]
    assert kept["language_id"] == sorted(lettered, key=str)
    # repeated rows keep the same lines, the later of two equal texts is left empty, a null key is left alone
    said = {300: "", 202: expected[202]}
    assert kept["line_dedup"] == sorted(((k, said.get(k, t)) for k, t in lettered), key=str)
    left = [(k, said.get(k, t)) for k, t in dict(lettered).items() if k is not None and k != 204]
    assert kept["near_dedup"] == sorted([*left, (None, "ver" + docs[5])], key=str)
    packed = corpus_pipeline.STAGES[-1][1](spark, out, d).collect()
    assert {r.doc_id for r in packed} == {k for k, _ in kept["near_dedup"]} and all(r.start == 4096 * r.piece for r in packed)
