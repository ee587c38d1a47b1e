"""Toxicity: windows against brute force, held-out labels, misspellings, edge cases."""

import math
import random

import numpy as np
import pytest

from zonage.llm import queries, toxicity

from .test_operators import frame


@pytest.fixture(scope="module")
def model():
    return toxicity.Model(0.25, np.random.default_rng(1).normal(size=toxicity.ROWS))


def test_scores_are_of_the_most_toxic_window(model):
    r = random.Random(4)
    for n in (0, 1, 5, 16, 17, 40, 300):
        words = [r.choice(["a", "ab", "été", "longer-word", "x" * 50, "No!"]) for _ in range(n)]
        text = " ".join(words).encode()
        rows, at = toxicity.features(text)
        logits = [model.margin + (model.weight[rows[at[s]:at[min(s + toxicity.WINDOW, len(at) - 1)]]].mean() if len(rows) else 0)
                  for s in toxicity.window_starts(len(at) - 1)]
        assert math.isclose(model.log_odds(text), max(logits), abs_tol=1e-9)


def test_windows_cover_every_word():
    for n in range(1, 100):
        starts = toxicity.window_starts(n)
        assert {k for s in starts for k in range(s, min(n, s + toxicity.WINDOW))} == set(range(n))


def test_sections_do_not_change_a_score(model, monkeypatch):
    r = random.Random(6)
    text = " ".join("".join(r.choice("abcdeé") for _ in range(r.randrange(1, 9))) for _ in range(400)).encode()
    whole = model.log_odds(text)
    monkeypatch.setattr(toxicity, "SECTION", 64)
    assert b"".join(toxicity.sections(text)) == text
    assert math.isclose(model.log_odds(text), whole, abs_tol=1e-9)


def texts(seed, n):
    r = random.Random(seed)
    syllables = "ba do ke mi ru sal ten vor lin gas".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randrange(1, 4)))
    out = []
    for k in range(n):
        words = [word() for _ in range(r.randrange(5, 400))]
        if k % 4 == 0:
            for _ in range(2):
                words[r.randrange(len(words))] = r.choice(["wretched", "blockhead", "scoundrel"])
        out.append((k, " ".join(words), int(k % 4 == 0)))
    return out


def test_learns_words_and_their_misspellings():
    m = toxicity.fit([(t.encode(), y) for _, t, y in texts(1, 500)])
    held = texts(2, 200)
    assert sum((m.score(t.encode()) >= 0.5) == y for _, t, y in held) >= 196
    clean = "bado keru salten vorlin gasba mido".split()
    plain = m.log_odds(" ".join(clean * 2).encode())
    assert plain < 0
    misspelt = [m.log_odds(" ".join(clean + [bad] + clean).encode()) for bad in ("wretchedd", "wretchd", "blokhead", "Scoundrell")]
    assert min(misspelt) > plain + 2 and sum(x > 0 for x in misspelt) >= 3


def test_training_and_scores_of_frames(spark):
    rows = [(i, t) for i, t, _ in texts(3, 120)]
    docs = frame(spark, rows + [(None, None), (900, None), (901, ""), (902, "..."), (903, "é" * 400_000), (3, "other text")])
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in texts(3, 120)] + [(900, None, "x"), (901, 1, "x"), (None, 1, "x")],
                                   "doc_id bigint, toxic int, _id string")
    m = toxicity.train(docs, labels)
    got = toxicity.scores(docs, m)
    assert got.columns == ["doc_id", "score"]
    found = got.collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in docs.collect())
    assert all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (None, 900, 901, 902)}) == 1
    assert toxicity.scores(docs.limit(0), m).collect() == []


def test_labels_of_one_class_or_none(spark):
    docs = frame(spark, [(1, "one two"), (2, "three"), (3, None)])
    labels = lambda rows: spark.createDataFrame(rows, "doc_id bigint, toxic int")
    assert toxicity.train(docs, labels([])).score(b"one") == 0.5
    assert toxicity.train(docs, labels([(1, 0), (2, 0)])).score(b"one") == pytest.approx(0.5 / 3)


def test_held_out_labels(spark):
    """On labels never learnt from: most toxic texts found, clean ones left alone."""
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op11_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    toxic = [r for r in rows if labels[r.doc_id]]
    clean = [r for r in rows if not labels[r.doc_id]]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.8
    assert sum(r.predicted for r in clean) / len(clean) < 0.02
