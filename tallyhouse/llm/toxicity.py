"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence has the chance ``sigmoid(b + sum of the weights of its distinct words)`` of being toxic,
where a word weighs as much as itself and its beginnings of 4 to 6 letters together; a document is toxic if any of its sentences is (noisy-or): ``1 - prod(1 - p)``. The weights maximise
the likelihood of the document labels, so blame is shared out among sentences without any sentence
label; an L1 penalty leaves weights only where the data ask for them. The same sentence chances then
locate the offending sentences of any text.

Learning uses at most ``MAX_SAMPLE`` labelled documents (equal texts once) and the words and
beginnings that at least ``LEAST_DOCUMENTS`` of them contain and that are commoner among the toxic
ones than chance explains; scoring reads every whole text. Ids, languages, sources
and labels are not measured.

Defined results: null, empty and blank texts have no sentence and score 0; documents without id are
scored; without any usable label every score is 0; ties do not arise, as rows do not influence each
other. Other columns of the input are neither read nor required.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import held_out, labelled_sample, sampled_documents

MAX_SAMPLE = 5_000
LEAST_DOCUMENTS = 5
ROUNDS, RATE, PENALTY = 200, 0.1, 1e-4
STRENGTH = 3.0
REMEMBERED_WORDS = 150_000
CUTOFF = 0.3
# A sentence is offending from this chance on.
OFFENDING = 0.5

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
WORDED_SENTENCE = re.compile(r"\w[^.!?\n]*")


def features(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in (4, 5, 6) if len(word) > k)]


def sentences(text: str | None) -> list[tuple[int, int, set[str]]]:
    """(start, end, distinct words) of the sentences that have a word."""
    found = []
    for m in SENTENCE.finditer(text or ""):
        words = set(WORD.findall(m.group().lower()))
        if words:
            found.append((m.start(), m.end(), words))
    return found


class WordWeights(dict):
    """Weights of words, remembered up to a bound."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.of = weights

    def __missing__(self, word: str) -> float:
        value = sum(self.of.get(f, 0.0) for f in features(word))
        if len(self) < REMEMBERED_WORDS:
            self[word] = value
        return value


@dataclass(frozen=True)
class Blame:
    """The learned bias and the features whose weight is not 0."""

    bias: float = -20.0
    weights: dict[str, float] = field(default_factory=dict)
    trained: bool = False

    def chances(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, z) of the sentences that have a word; ``sigmoid(z)`` is the chance."""
        known = _word_weights(self)
        return [(a, b, self.bias + sum(map(known.__getitem__, words))) for a, b, words in sentences(text)]

    def document(self, text: str | None) -> float:
        """Chance that any sentence is toxic. Where no word of the text weighs anything, all of its
        sentences have the chance of the bias and are only counted."""
        if not self.trained or not text:
            return 0.0
        known = _word_weights(self)
        if any(map(known.__getitem__, set(WORD.findall(text.lower())))):
            z = np.array([z for _, _, z in self.chances(text)])
        else:
            z = np.full(len(WORDED_SENTENCE.findall(text)), self.bias)
        return float(-np.expm1(-np.logaddexp(0.0, z).sum()))

    def offending(self, text: str | None) -> list[dict]:
        """Spans (code points) and chances of the sentences at or over ``OFFENDING``."""
        if not self.trained:
            return []
        spans = ((a, b, float(-np.expm1(-np.logaddexp(0.0, z)))) for a, b, z in self.chances(text))
        return [{"start": a, "end": b, "chance": p} for a, b, p in spans if p >= OFFENDING]


_KNOWN: list[tuple[Blame, WordWeights]] = []


def _word_weights(model: Blame) -> WordWeights:
    """The last model's remembered words."""
    if not _KNOWN or _KNOWN[0][0] is not model:
        _KNOWN[:] = [(model, WordWeights(model.weights))]
    return _KNOWN[0][1]


def telling_features(bags: list[list[set[str]]], y: np.ndarray) -> list[str]:
    """Features that enough documents have, and that are commoner in toxic ones by more than
    ``STRENGTH`` standard errors."""
    seen, toxic = Counter(), Counter()
    for bag, label in zip(bags, y):
        found = {f for w in set().union(*bag) for f in features(w)}
        seen.update(found)
        if label:
            toxic.update(found)
    rate = y.mean()

    def tells(f: str) -> bool:
        n = seen[f]
        return n >= LEAST_DOCUMENTS and toxic[f] - n * rate > STRENGTH * (n * rate * (1 - rate)) ** 0.5

    return sorted(f for f in toxic if tells(f))


def fit(texts: list[str], labels: list[int]) -> Blame:
    """Proximal Adam over all sentences at once."""
    bags = [[s[2] for s in sentences(t)] for t in texts]
    kept = [i for i, bag in enumerate(bags) if bag]
    y = np.array([labels[i] for i in kept], dtype=float)
    if not len(y) or not 0 < y.mean() < 1:
        return Blame()
    bags = [bags[i] for i in kept]
    names = telling_features(bags, y)
    column = {f: k for k, f in enumerate(names)}
    distinct = set().union(*(words for bag in bags for words in bag))
    columns = {w: found for w in distinct if (found := [column[f] for f in features(w) if f in column])}
    ids = [[k for w in columns.keys() & words for k in columns[w]] for bag in bags for words in bag]
    sentence_of = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    feature_of = np.fromiter((f for x in ids for f in x), dtype=np.int64, count=len(sentence_of))
    document_of = np.repeat(np.arange(len(bags)), [len(bag) for bag in bags])
    w, b = np.zeros(len(names)), -6.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, ROUNDS + 1):
        z = np.clip(b + np.bincount(sentence_of, weights=w[feature_of], minlength=len(ids)), -30, 30)
        clean = np.bincount(document_of, weights=np.logaddexp(0, z), minlength=len(y))
        toxic = np.maximum(-np.expm1(-clean), 1e-9)
        # slope of the mean log-likelihood by each sentence's z
        slope = ((y - toxic) / toxic)[document_of] / (1 + np.exp(-z)) / len(y)
        g = np.append(-np.bincount(feature_of, weights=slope[sentence_of], minlength=len(w)), -slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        rate = RATE / (np.sqrt(v / (1 - 0.999**step)) + 1e-6)
        change = rate * m / (1 - 0.9**step)
        w, b = w - change[:-1], b - change[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - rate[:-1] * PENALTY, 0.0)
    return Blame(float(b), {names[k]: float(w[k]) for k in np.flatnonzero(w)}, True)


def learn(docs: DataFrame, labels: DataFrame, modulus: int, held: int, max_rows: int = MAX_SAMPLE) -> Blame:
    """The model from labels of documents that are not held out: the driver gets the texts of at
    most ``max_rows`` documents."""
    sample = labelled_sample(labels, "toxic", modulus, held, max_rows)
    rows = sampled_documents(docs, sample).groupBy("text").agg(F.max("label").alias("label")).collect()
    rows = sorted((r["text"] or "", r["label"]) for r in rows)
    return fit([t for t, _ in rows], [y for _, y in rows])


def _score(batches: Iterator[pa.RecordBatch], model: Blame) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [model.document(t.as_py()) for t in batch.column("text")]
        yield pa.record_batch(
            [batch.column("doc_id").cast(pa.int64()), pa.array(scores, pa.float64())], names=["doc_id", "score"]
        )


def score(docs: DataFrame, model: Blame) -> DataFrame:
    """(doc_id, score) of every row."""
    return docs.select("doc_id", "text").mapInArrow(partial(_score, model=model), "doc_id BIGINT, score DOUBLE")


def _locate(batches: Iterator[pa.RecordBatch], model: Blame) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("chance", pa.float64())]))
    for batch in batches:
        found = [model.offending(t.as_py()) for t in batch.column("text")]
        yield pa.record_batch(
            [batch.column("doc_id").cast(pa.int64()), pa.array(found, kind)], names=["doc_id", "sentences"]
        )


def locate(docs: DataFrame, model: Blame) -> DataFrame:
    """(doc_id, sentences) of every row: where its offending sentences are."""
    return docs.select("doc_id", "text").mapInArrow(
        partial(_locate, model=model),
        "doc_id BIGINT, sentences ARRAY<STRUCT<start INT, end INT, chance DOUBLE>>",
    )


def toxicity_scores(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row: 1 where the score reaches ``CUTOFF``."""
    return score(docs, learn(docs, labels, modulus, held)).select(
        "doc_id",
        held_out(modulus, held).alias("held_out"),
        "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
    )
