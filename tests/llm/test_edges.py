"""Empty tables through every stage, and very long texts through every operator on documents."""

import random

import numpy as np

import corpus_pipeline
from docmill.llm import exact_dedup, katz, mixing, near_copies, packing, quality, secrets, simhash, token_files
from docmill.llm.common import Workspace
from docmill.llm.encoding import WordEncoder, vocabulary_path


def test_stages_over_an_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0, name
        if name != "packing":
            assert out.columns == docs.columns


def test_stages_over_nulls_ties_and_clashing_columns(spark, tmp_path):
    rng = random.Random(81)
    text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(120))
    rows = [(1, text, "en", "s"), (1, text, "en", "s"), (2, text, None, None), (None, text, "en", None), (None, None, None, None), (3, "", "en", "s"), (4, " \n\t", "en", "s")]
    names = ["tokens", "rate", "copies", "digest", "node", "root", "row", "n", "pair", "kept", "_id"]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in names)
    docs = spark.createDataFrame([(*r, *names) for r in rows], schema)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    left = {name: stage(spark, docs, str(tmp_path)) for name, stage in corpus_pipeline.STAGES[:-1]}
    for name, out in left.items():
        assert out.columns == docs.columns, name
    assert sorted(r.text for r in left["exact_dedup"].collect() if r.text and r.text.strip()) == [text]
    assert [r.doc_id for r in left["near_dedup"].collect() if r.text == text] == [1]
    assert packing.pack_documents(spark, docs).count() >= len(rows)


def test_very_long_texts(spark):
    rng = random.Random(82)
    words = ["".join(rng.choices("abcdefghéß", k=rng.randint(1, 9))) for _ in range(5000)]
    long = "\n".join(" ".join(rng.choices(words, k=20)) for _ in range(12_000))  # some 1.4 MB
    one = "é" * 300_000  # one word
    rows = [(10, long, "en", "s"), (20, one, "en", "s"), (30, long + " more", "en", "s"), (41, "short text", "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    by = lambda df, c: {r.doc_id: r[c] for r in df.collect()}
    assert set(by(exact_dedup.exact_dedup(spark, docs), "group_size").values()) == {1}
    assert by(simhash.near_groups(spark, docs), "component_id") == {10: 10, 20: 20, 30: 10, 41: 41}
    assert by(near_copies.near_groups(spark, docs), "component_id") == {10: 10, 20: 20, 30: 10, 41: 41}
    assert by(quality.quality_verdicts(spark, docs), "n_words") == {10: 240_000, 20: 1, 30: 240_001, 41: 2}
    assert by(secrets.secret_spans(docs), "n_cut") == {10: 0, 20: 0, 30: 0, 41: 0}
    assert by(katz.katz_scores(spark, docs, chunk_tokens=50_000, buckets=3), "n_tokens") == {10: 240_001, 20: 2, 30: 240_002, 41: 3}
    own = WordEncoder(vocabulary_path())
    sizes = {d: len(own.encode(t.encode())) // 4 + 1 for d, t, *_ in rows}
    assert own.tokenizer.encode(long[:20_000], add_special_tokens=False).ids == np.frombuffer(own.encode(long[:20_000].encode()), "<u4").tolist()
    manifest, dictionary = token_files.write_token_files(spark, docs, Workspace(spark, "test").path)
    assert by(token_files.read_token_files(spark, manifest, dictionary), "n_tokens") == sizes
    assert by(packing.pack_documents(spark, docs), "doc_tokens") == sizes
    labels = spark.createDataFrame([(10, 1, 0), (20, 0, 0)], "doc_id long, quality int, toxic int")
    assert by(mixing.mixing_rates(spark, docs, labels, mixing.QUERY_WEIGHTS), "tokens") == {10: 240_000, 20: 1, 30: 240_001, 41: 2}
