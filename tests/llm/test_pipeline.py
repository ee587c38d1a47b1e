"""The corpus pipeline against brute force, and the registered queries' shapes."""

import collections
import hashlib
import os
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from zonage.llm import bpe, queries

from .test_operators import components, lower, norm_words

SF = "/root/testdata/sf0.001"


def test_pipeline_matches_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [norm_words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    good = {r.doc_id for r in queries.QUERIES["op8_quality"](spark, SF).collect() if r.predicted == 1}
    left = {i: t for i, t in docs.items() if i in good}
    last = {}
    for i, t in left.items():
        last[lower(t)] = max(i, last.get(lower(t), -1))
    left = {i: t for i, t in left.items() if last[lower(t)] == i}
    comps = components(list(left.items()))
    left = {i: t for i, t in left.items() if comps[i][1] == i}
    wins = {tuple(w[k:k + 10]) for w in items if w for k in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in wins}

    def leaked(t):
        w = norm_words(t)
        return any(tuple(w[k:k + n]) in wins for n in sizes for k in range(len(w) - n + 1))

    left = {i: t for i, t in left.items() if not leaked(t)}
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: (r.n_tokens, bytes(r.ids), r.text_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert 0 < len(left) < len(docs)
    want = {}
    for i, t in left.items():
        ids = library.encode_ordinary(t)
        want[i] = (len(ids), np.array(ids, "<u4").tobytes(), hashlib.sha256(t.encode()).hexdigest())
    assert got == want


def test_stages_on_nulls_clashing_columns_and_an_empty_table(spark, tmpdir_fresh):
    schema = "doc_id bigint, text string, lang string, _id string, _text string, _gone string, _digest string, score int"
    rows = [(1, None, "en", "a", None, "g", "d", 1), (2, "", None, None, "t", None, None, 2), (None, "one two", "x", "b", "t", "g", "d", 3),
            (4, "one two three", "x", "b", "t", "g", "d", 3), (4, "one two three", "x", "b", "t", "g", "d", 3)]
    spark.createDataFrame([(k, 1) for k in (1, 2)], "doc_id bigint, quality int").write.parquet(os.path.join(tmpdir_fresh, "labels.parquet"))
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id bigint, text string") \
        .write.parquet(os.path.join(tmpdir_fresh, "benchmark.parquet"))
    spark.createDataFrame(rows, schema).write.parquet(os.path.join(tmpdir_fresh, "documents.parquet"))
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, tmpdir_fresh)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns, name
            n = out.count()
            assert n <= docs.count()


def test_every_operator_is_registered_once():
    numbers = collections.Counter(m[1] for k in entry.queries() if (m := re.match(r"op(\d+)_", k)))
    assert numbers == {str(n): 1 for n in range(1, 14)}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "jaccard_join", "decontaminate", "byte_bpe"]
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in entry.queries()


COLUMNS = {
    "op2_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op3_lm_score": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op4_jaccard_join": "doc_id n_shingles component_id",
    "op5_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op6_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op7_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op8_quality": "doc_id held_out score predicted",
    "op9_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op10_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op11_toxicity": "doc_id held_out score predicted",
}


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_query_has_a_row_per_document_and_its_columns(spark, key):
    got = queries.QUERIES[key](spark, SF)
    assert got.columns == COLUMNS[key].split()
    rows = got.collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(ids)


def test_held_out_quality(spark):
    """On labels never learnt from, the classifier is right nearly always."""
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op8_quality"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in rows) / len(rows) > 0.97


def test_held_out_language_model(spark):
    """Classes beat the unigram base on texts never learnt from."""
    rows = [r for r in queries.QUERIES["op3_lm_score"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    n = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / n > sum(r.base_score for r in rows) / n + 0.05


def test_rows_without_an_id_are_held_out(spark, tmpdir_fresh):
    rows = [(i, f"text number {i} of some words") for i in range(20)] + [(None, "a text without an id")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(os.path.join(tmpdir_fresh, "documents.parquet"))
    spark.createDataFrame([(i, i % 2, i % 3 % 2) for i in range(20)], "doc_id bigint, quality int, toxic int") \
        .write.parquet(os.path.join(tmpdir_fresh, "labels.parquet"))
    for key in ("op3_lm_score", "op8_quality", "op11_toxicity"):
        found = {r.doc_id: r.held_out for r in queries.QUERIES[key](spark, tmpdir_fresh).collect()}
        assert found[None] is True and set(found.values()) == {True, False}, key
