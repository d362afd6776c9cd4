"""Document quality from pairwise preferences (Bradley-Terry).

Each document has a strength ``w . x`` over a few measures of its text. A labelled pair (good, bad)
is a preference; the chance that the good one wins is ``sigmoid(w . (x_good - x_bad))``, and the
weights minimise the logistic loss of all pairs plus a small ridge, by Newton's method. Documents
whose strength is below a quantile of the training strengths, the share of bad labels, are rejected:
the cut lies halfway between the two training documents around that quantile. A score is a logistic
function of the strength that is ``cutoff`` exactly at the cut.

Learning uses every labelled document that is not held out, and every pair of a good and a bad one,
without forming pairs. Strengths are dealt into cells of width ``CELL``; a cell keeps sums over its
documents of the powers of their distance from its middle, with and without their measures. The loss
depends on the difference of two strengths only, so its Taylor series around the difference of two
middles gives the gradient of all pairs of two cells from their sums, to about 1e-9 of its size. The
curvature takes the series' first terms, which the steps correct. One step is one aggregation by cell;
the driver gets one row of sums per cell. The quantile is counted over all training strengths, in
units of 2^-40. Scoring reads every whole text. Ids, languages, sources and labels are not measured.

Defined results: null and empty texts have all measures 0 and get a score like any text; documents
without id are scored; without any usable label, or with labels of one kind only, every score is
0.5. Other columns of the input are neither read nor required.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import held_out, usable_labels, with_ids
from tallyhouse.operators.quantiles import values_at
from tallyhouse.storage import stage

RIDGE = 1e-3
CUTOFF = 0.3
# Width of a cell of strengths, and the terms kept of a series around its middle.
CELL, TERMS = 0.25, 6
# Strengths beyond this many cells count as that many: no such document is near any good or bad bound.
FAR_CELLS = 800
STEPS = 50
# Units of strength in which the cut is counted.
UNITS = float(1 << 40)

_LETTERS = bytes(b for b in range(128) if chr(b).isalpha())
_DIGITS = b"0123456789"
_PROSE_MARKS = b".,;:'\"?-()"
_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = bytes(
    b for b in range(33, 127) if b not in _LETTERS and b not in _DIGITS and b not in _PROSE_MARKS
)

MEASURES = (
    "symbols", "digits", "marks", "capitals", "all-capital words", "repeated neighbours",
    "distinct words", "distinct lines", "word length", "words",
)


def measure(text: str | None) -> list[float]:
    """Shares and means between 0 and about 1, one for each of ``MEASURES``; roots of shares, so
    that a little of something rare counts."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(MEASURES)
    raw = text.encode("utf-8", "replace")
    n, size = len(words), len(raw)

    def share(kind: bytes) -> float:
        return ((size - len(raw.translate(None, kind))) / size) ** 0.5

    lines = [x for x in text.split("\n") if x and not x.isspace()]
    upper = sum(map(str.isupper, words)) / n
    return [
        share(_SYMBOLS),
        share(_DIGITS),
        share(_PROSE_MARKS),
        share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        upper**0.5,
        (sum(map(eq, words, words[1:])) / n) ** 0.5,
        len(set(words)) / n,
        len(set(lines)) / len(lines),
        min(1.0, size / n / 32),
        min(1.0, np.log1p(n) / 12),
    ]


@dataclass(frozen=True)
class Ranking:
    """Weights of the standardised measures, the strength at the cut and the unit of strength."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    unit: float
    cutoff: float

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.unit:
            return np.full(len(x), 0.5)
        shift = np.log(self.cutoff / (1 - self.cutoff))
        z = (self.strengths(x) - self.cut) / self.unit + shift
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _cells(z: np.ndarray, label: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(label, cell) of each group of documents and its sums: of (1, z) times d^k/k! for the distance d
    from the cell's middle, and of the products of two measures."""
    s = np.clip(z @ w, -FAR_CELLS * CELL, FAR_CELLS * CELL)
    cell = np.rint(s / CELL)
    keys, group = np.unique(np.stack([label, cell]), axis=1, return_inverse=True)
    sums = np.zeros((keys.shape[1], _sums(z.shape[1])))
    power, one_z = np.ones(len(s)), np.hstack([np.ones((len(s), 1)), z])
    parts = []
    for k in range(TERMS):
        parts.append(one_z * power[:, None])
        power = power * (s - CELL * cell) / (k + 1)
    parts.append((z[:, :, None] * z[:, None, :]).reshape(len(s), -1))
    np.add.at(sums, group.ravel(), np.hstack(parts))
    return keys.T.astype(np.int64), sums


def _sums(k: int) -> int:
    return TERMS * (k + 1) + k * k


def _derivatives(x: np.ndarray) -> list[np.ndarray]:
    """Derivatives of log(1 + exp(-x)) from the first on, one for each term of a series and two more, as
    polynomials in p = 1 / (1 + exp(-x)), whose derivative is p - p^2."""
    p = 1 / (1 + np.exp(-np.clip(x, -500, 500)))
    polynomial, found = np.polynomial.Polynomial([-1.0, 1.0]), []
    for _ in range(2 * TERMS):
        found.append(polynomial(p))
        polynomial = polynomial.deriv() * np.polynomial.Polynomial([0.0, 1.0, -1.0])
    return found


def _step(keys: np.ndarray, sums: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The Newton step of the mean loss of all pairs of a good and a bad document."""
    k = len(w)
    good, bad = sums[keys[:, 0] == 1], sums[keys[:, 0] == 0]
    at_good, at_bad = keys[keys[:, 0] == 1, 1], keys[keys[:, 0] == 0, 1]
    terms = [x[:, : TERMS * (k + 1)].reshape(-1, TERMS, k + 1) for x in (good, bad)]
    squares = [x[:, TERMS * (k + 1) :].reshape(-1, k, k) for x in (good, bad)]
    n_good, n_bad = terms[0][:, 0, 0], terms[1][:, 0, 0]
    pairs = n_good.sum() * n_bad.sum()
    slopes = _derivatives(CELL * (at_good[:, None] - at_bad[None, :]))
    gradient = np.zeros(k)
    for i in range(TERMS):
        for j in range(TERMS - i):
            slope = slopes[i + j] * (-1) ** j
            gradient += (slope @ terms[1][:, j, 0]) @ terms[0][:, i, 1:]
            gradient -= (terms[0][:, i, 0] @ slope) @ terms[1][:, j, 1:]
    bend = slopes[1]
    cross = terms[0][:, 0, 1:].T @ bend @ terms[1][:, 0, 1:]
    curvature = np.tensordot(bend @ n_bad, squares[0], 1) + np.tensordot(n_good @ bend, squares[1], 1) - cross - cross.T
    return np.linalg.solve(curvature / pairs + RIDGE * np.eye(k), gradient / pairs + RIDGE * w)


def _weights(cells: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """The weights that minimise the loss; ``cells`` gives the sums of all documents for given weights.
    Rounded, so that the order in which sums were added does not show."""
    w = np.zeros(k)
    for _ in range(STEPS):
        step = _step(*cells(w), w)
        w = w - step / max(1.0, np.linalg.norm(step))
        if np.linalg.norm(step) < 1e-8:
            break
    return np.round(w, 7)


def _unlearned(k: int, cutoff: float) -> Ranking:
    return Ranking(np.zeros(k), np.ones(k), np.zeros(k), 0.0, 0.0, cutoff)


def fit(x: np.ndarray, label: np.ndarray, cutoff: float = CUTOFF) -> Ranking:
    """The ranking from documents that one process holds; ``learn`` does the same on tables."""
    k = x.shape[1] if x.ndim == 2 else len(MEASURES)
    bad = int((label == 0).sum())
    if not bad or bad == len(label):
        return _unlearned(k, cutoff)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    z = (x - mean) / scale
    w = _weights(lambda w: _cells(z, label, w), k)
    strengths = np.sort(z @ w)
    cut = (strengths[bad - 1] + strengths[bad]) / 2
    return Ranking(mean, scale, w, float(cut), float(strengths.std() / 4 or 1.0), cutoff)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [measure(t.as_py()) for t in batch.column("text")]
        yield pa.record_batch(
            [batch.column("doc_id").cast(pa.int64()), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"]
        )


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of every row: the measures of its text."""
    return docs.select("doc_id", "text").mapInArrow(_measured, "doc_id BIGINT, x ARRAY<DOUBLE>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(MEASURES))


def _cells_of(batches: Iterator[pa.RecordBatch], ranking: Ranking) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        z = (_matrix(batch.column("x")) - ranking.mean) / ranking.scale
        keys, sums = _cells(z, batch.column("label").to_numpy(), ranking.weights)
        arrays = [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(list(sums), pa.list_(pa.float64()))]
        yield pa.record_batch(arrays, names=["label", "cell", "sums"])


def _strengths(batches: Iterator[pa.RecordBatch], ranking: Ranking) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        s = ranking.strengths(_matrix(batch.column("x")))
        yield pa.record_batch([pa.array(np.rint(s * UNITS).astype(np.int64))], names=["strength"])


def learn_from(x: DataFrame, labels: DataFrame, modulus: int, held: int, cutoff: float = CUTOFF) -> Ranking:
    """The ranking from the measures of documents and their labels, all that are not held out."""
    usable = usable_labels(labels, "quality", modulus, held)
    known = stage(x.join(usable, "doc_id").select("x", "label"), "labelled-measures")
    k = len(MEASURES)
    measures = [F.col("x")[i] for i in range(k)]
    row = known.agg(
        F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0), *map(F.avg, measures), *map(F.stddev_pop, measures)
    ).first()
    if not row[0] or not row[1]:
        return _unlearned(k, cutoff)
    known = known.where("label IN (0, 1)")
    # Rounded, so that the order in which sums were added does not show.
    mean = np.round(np.array(row[2 : 2 + k]), 12)
    scale = np.maximum(np.round(np.array(row[2 + k :]), 12), 1e-3)

    def cells(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = partial(_cells_of, ranking=Ranking(mean, scale, w, 0.0, 1.0, cutoff))
        found = (
            known.mapInArrow(run, "label BIGINT, cell BIGINT, sums ARRAY<DOUBLE>")
            .groupBy("label", "cell")
            .agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(_sums(k))]).alias("sums"))
            .orderBy("label", "cell")
            .toArrow()
        )
        keys = np.stack([found.column(c).to_numpy() for c in ("label", "cell")], axis=1)
        return keys, np.array(found.column("sums").to_pylist(), dtype=float)

    ranking = Ranking(mean, scale, _weights(cells, k), 0.0, 1.0, cutoff)
    strengths = stage(known.mapInArrow(partial(_strengths, ranking=ranking), "strength BIGINT"), "strengths")
    low, high, spread = strengths.agg(
        F.min("strength"), F.max("strength"), F.stddev_pop(F.col("strength") / UNITS)
    ).first()
    at = values_at(strengths, "strength", [row[1] - 1, row[1]], low, high)
    cut = (at[row[1] - 1] + at[row[1]]) / 2 / UNITS
    return Ranking(mean, scale, ranking.weights, cut, round(spread / 4, 12) or 1.0, cutoff)


def learn(docs: DataFrame, labels: DataFrame, modulus: int, held: int) -> Ranking:
    """The ranking from the labels of all documents that are not held out."""
    usable = usable_labels(labels, "quality", modulus, held)
    return learn_from(measured(with_ids(docs.select("doc_id", "text"), usable, "doc_id")), labels, modulus, held)


def _score(batches: Iterator[pa.RecordBatch], ranking: Ranking) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = ranking.scores(_matrix(batch.column("x")))
        yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(scores)], names=["doc_id", "score"])


def score(x: DataFrame, ranking: Ranking) -> DataFrame:
    """(doc_id, score) of every row of measures."""
    return x.mapInArrow(partial(_score, ranking=ranking), "doc_id BIGINT, score DOUBLE")


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row: 1 where the score reaches ``CUTOFF``."""
    x = stage(measured(docs), "measures")
    scored = score(x, learn_from(x, labels, modulus, held))
    return scored.select(
        "doc_id",
        held_out(modulus, held).alias("held_out"),
        "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0) -> DataFrame:
    """``docs`` with its own columns and without rejected rows: a filter on the score of each row."""
    ranking = learn(docs, labels, modulus, held)
    return docs.mapInArrow(partial(_keep, ranking=ranking), docs.schema)


def _keep(batches: Iterator[pa.RecordBatch], ranking: Ranking) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.array([measure(t.as_py()) for t in batch.column("text")], dtype=float)
        yield batch.filter(pa.array(ranking.scores(x.reshape(-1, len(MEASURES))) >= CUTOFF))
