from __future__ import annotations

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import language_model, quality, queries, toxicity

from tests.llm.cases import AWKWARD, awkward

SF_DIR = "/root/testdata/sf0.01"


# Some 300 labels are learned from here, 40 of them toxic in four languages: hence the lower bound.
@pytest.mark.parametrize(
    "name, label, modulus, held, least",
    [("op1_toxicity", "toxic", 4, 2, 0.9), ("op6_quality", "quality", 5, 0, 0.97)],
)
def test_held_out_accuracy(spark, name, label, modulus, held, least):
    got = queries.QUERIES[name](spark, SF_DIR).toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % modulus == held for i in got.doc_id]).all()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
    unseen = got[got.held_out].merge(labels, on="doc_id")
    assert len(got) == 1000 and (unseen.predicted == unseen[label]).mean() >= least


def labels_for(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT")


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
def test_awkward_rows_are_scored(spark, score):
    some = labels_for(spark, [(1, 1, 0), (2, 0, 1), (2, 1, None), (None, 1, 1), (3, None, None), (77, 0, 1), (6, 0, 1), (8, 1, 0)])
    got = score(awkward(spark), some).collect()
    assert len(got) == len(AWKWARD)
    assert all(0 <= r.score <= 1 and not math.isnan(r.score) for r in got)
    assert all(not r.held_out for r in got if r.doc_id is None)
    untrained = score(awkward(spark), labels_for(spark, [])).collect()
    assert {r.score for r in untrained} == ({0.5} if score is quality.quality_scores else {0.0})
    assert score(awkward(spark, []), some).count() == 0


def test_quality_filter_keeps_columns(spark):
    docs = awkward(spark)
    kept = quality.drop_low_quality(docs, labels_for(spark, []))
    assert kept.schema == docs.schema and kept.count() == len(AWKWARD)


def test_ranking_cuts_at_the_share_of_bad_labels():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 10))
    label = (x[:, 0] + x[:, 3] > -1).astype(int)
    ranking = quality.fit(x, label)
    scores = ranking.scores(x)
    assert ((scores >= quality.CUTOFF) == (label == 1)).mean() > 0.98
    assert (scores < quality.CUTOFF).sum() == (label == 0).sum()


def weights_of_all_pairs(x, label):
    z = (x - x.mean(axis=0)) / np.maximum(x.std(axis=0), 1e-3)
    d = (z[label == 1][:, None] - z[label == 0][None]).reshape(-1, z.shape[1])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        lost = 1 / (1 + np.exp(d @ w))
        curvature = (d * (lost * (1 - lost))[:, None]).T @ d / len(d) + quality.RIDGE * np.eye(len(w))
        step = np.linalg.solve(curvature, quality.RIDGE * w - (d * lost[:, None]).mean(axis=0))
        w = w - step / max(1.0, np.linalg.norm(step))
    return w


def test_ranking_learns_from_all_pairs():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 10))
    label = (x[:, 0] + x[:, 3] + rng.normal(size=300) > -1).astype(int)
    assert quality.fit(x, label).weights == pytest.approx(weights_of_all_pairs(x, label), abs=1e-6)


def test_ranking_learns_from_every_labelled_document(spark):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("ab C.,#1\n "), 60)) for _ in range(400)]
    given = [(i, int(rng.random() < 0.3 + 0.5 * (t.count("#") < 7)), 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    got = quality.learn(docs, labels_for(spark, given), 5, 0)
    used = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    want = quality.fit(np.array([quality.measure(texts[i]) for i in used]), np.array([given[i][1] for i in used]))
    assert got.weights == pytest.approx(weights_of_all_pairs(np.array([quality.measure(texts[i]) for i in used]), np.array([given[i][1] for i in used])), abs=1e-6)
    assert (got.cut, got.unit) == pytest.approx((want.cut, want.unit), abs=1e-6)


def test_noisy_or_finds_the_sentence():
    clean = [f"The sky is blue today. Birds number {i} sing. All is well." for i in range(60)]
    toxic = [f"The sky is blue today. You vile{c} thing number {i}. All is well." for i in range(20) for c in "xyz"]
    model = toxicity.fit(clean + toxic, [0] * len(clean) + [1] * len(toxic))
    assert max(map(model.document, clean)) < 0.3 < min(map(model.document, toxic))
    text = "All is well. You vileq thing! The sky is blue."
    assert model.document(text) >= 0.3
    assert [text[s["start"] : s["end"]] for s in model.offending(text)] == [" You vileq thing"]
    z = np.array([z for _, _, z in model.chances(text)])
    assert model.document(text) == pytest.approx(1 - np.prod(1 - 1 / (1 + np.exp(-z))))


def test_offending_sentences_as_a_table(spark):
    model = toxicity.Blame(-9.0, {"vile": 20.0}, True)
    got = {r.doc_id: r.sentences for r in toxicity.locate(awkward(spark), model).collect()}
    assert got[1] == [] and got[3] == []


def test_language_model_counts(spark, monkeypatch):
    monkeypatch.setattr(language_model, "TOKENS_PER_RANGE", 20_000)
    got = queries.QUERIES["op9_lm_score"](spark, SF_DIR).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    tokens = {r.doc_id: [*(r.text or "").encode().lower().split(), 0] for r in docs}
    kind = {i: zlib.crc32(str(i).encode()) % 5 for i in tokens}

    def count(using):
        one, two = collections.Counter(), collections.Counter()
        for i, t in tokens.items():
            if using(kind[i]):
                one.update(t)
                one[None] += 1
                two.update(zip([None, *t[:-1]], t))
        return one, two

    one, two = count(lambda k: k != 1)
    n, v = sum(one.values()) - one[None], len(one) - 1
    rest, rest_two = count(lambda k: k not in (1, 2))
    n_rest = sum(rest.values()) - rest[None]
    cells = collections.Counter()
    for i, t in tokens.items():
        if kind[i] == 2:
            for a, b in zip([None, *t[:-1]], t):
                p2 = rest_two[a, b] / rest[a] if rest[a] else 0.0
                parts = language_model._steps(np.array([p2, rest[b] / n_rest]))
                bucket = int(language_model.buckets(np.array([float(rest[a])]))[0])
                cells[(bucket * language_model.SIDE + int(parts[0])) * language_model.SIDE + int(parts[1])] += 1
    at = np.array(sorted(cells))
    weights = language_model.learn_weights(at, np.array([cells[c] for c in at]), v)
    for i, t in tokens.items():
        r = got.loc[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (kind[i] == 1, len(t), sum(one[w] > 0 for w in t), n)
        base = sum(math.log10((one[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        score = 0.0
        for a, b in zip([None, *t[:-1]], t):
            w = weights[min(int(math.log2(one[a] + 1)), 31)]
            score += math.log10(w[0] * (two[a, b] / one[a] if one[a] else 0) + w[1] * one[b] / n + w[2] / (v + 1))
        assert r.score == pytest.approx(score, rel=1e-9)
    unseen = got[got.held_out]
    assert unseen.score.sum() > unseen.base_score.sum()


def test_weights_explain_held_out_counts():
    side = language_model.SIDE
    half, rare = side - 1 - language_model.STEPS, side - 1 - 10 * language_model.STEPS
    cells = np.array([(3 * side + half) * side + rare, (3 * side + 0) * side + rare, (5 * side) * side + rare])
    weights = language_model.learn_weights(cells, np.array([900, 100, 500]), 10**6)
    assert weights.sum(axis=1) == pytest.approx(1) and (weights > 0).all()
    assert weights[3, 0] > 0.85 and weights[5, 1] > 0.95 and weights[7] == pytest.approx(1 / 3)


def test_language_model_of_awkward_rows(spark):
    got = language_model.score_documents(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert language_model.score_documents(awkward(spark, [])).count() == 0
    only_held_out = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    rows = [(i, "a b", None, None, None) for i in only_held_out]
    assert [r.score for r in language_model.score_documents(awkward(spark, rows)).collect()] == [0.0, 0.0]


def test_planes_round_trip():
    for x in (np.arange(5, dtype=np.uint64), np.zeros(0, np.uint32), np.array([2**40], np.uint64)):
        assert language_model.numbers(language_model.planes(x), x.dtype.type).tolist() == x.tolist()
