"""Scores of texts by an interpolated bigram model, learned by deleted interpolation.

Tokens are the words of a text and one end. The chance of a token after a context is

    l2[b] * c(context, token) / c(context) + l1[b] * c(token) / N + l0[b] / (V + 1)

with counts over all training documents; ``b`` is the bucket of the context's frequency, by powers
of two. The weights of each bucket are learned by expectation-maximisation on held-out counts: part of
the training documents is set aside, its tokens are explained by the counts of the rest, and the
weights that explain them best are kept. ``N``, ``V`` and all final counts cover every training
document. The learning sees the set-aside tokens as a histogram over bucket and the two chances, in
steps of a quarter of a power of two, so the driver gets at most ``MOST_CELLS`` numbers.

How counts meet documents: a task cuts its documents into chunks of about ``CHUNK_TOKENS`` tokens.
A chunk asks once for each of its distinct words and bigrams, sending its own counts along; requests
are sorted hashes, cut into ranges, and each range is summed over all chunks by one small group and
answered to the chunks. A frequent word is one request per chunk, however many documents have it, so
no key is hot. The number of ranges grows with the tokens. Requests and answers are packed as compressed
byte planes, no more than their numbers need. Words have 64-bit hashes, bigrams 48-bit ones.

Defined results: null, empty and blank texts are the end alone; rows without ``doc_id`` are scored
and learned from; repeated rows count as often as they come; without any training document every
token has the chance ``1 / (V + 1) = 1``, so scores are 0; an empty table gives no rows. Other
columns of the input are neither read nor required.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import held_out, mix, remainder, word_hashes, words_of
from tallyhouse.storage import stage

CHUNK_TOKENS = 1_000_000
TOKENS_PER_RANGE = 1_000_000
BUCKETS = 32
STEPS = 4
SIDE = 48 * STEPS + 2
MOST_CELLS = BUCKETS * SIDE * SIDE
EM_ROUNDS = 200

END, START = np.uint64(0x0D0C0B0A09080706), np.uint64(0x1D1C1B1A19181716)
WORDS, BIGRAMS = 0, 1
KEY_BITS = {WORDS: 64, BIGRAMS: 48}

CHUNK_SCHEMA = (
    "chunk STRING, n_tokens BIGINT, n_training BIGINT, n_set_aside BIGINT, docs BIGINT, docs_set_aside BIGINT, "
    "doc_ids ARRAY<BIGINT>, kinds ARRAY<INT>, lengths ARRAY<INT>, words BINARY, tokens BINARY"
)
REQUEST_SCHEMA = "kind INT, range INT, chunk STRING, keys BINARY, counts BINARY, aside BINARY"
ANSWER_SCHEMA = "kind INT, range INT, chunk STRING, counts BINARY, aside BINARY, n_distinct BIGINT"
COUNTED_SCHEMA = (
    "doc_ids ARRAY<BIGINT>, kinds ARRAY<INT>, lengths ARRAY<INT>, c1_values BINARY, c1 BINARY, c2 BINARY, a1 BINARY, a2 BINARY, "
    "n_distinct BIGINT"
)
DOCS_PER_BLOCK = 512
HELD_OUT, TRAINING, SET_ASIDE = 0, 1, 2


def planes(x: np.ndarray) -> bytes:
    """Numbers as byte planes: first all lowest bytes, last all highest that any number needs. Their
    number comes before them, and both are compressed."""
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    columns = x.view(np.uint8).reshape(-1, x.itemsize)[:, :width]
    return zstandard.compress(bytes([width]) + np.ascontiguousarray(columns.T).tobytes(), 1)


def numbers(raw: bytes, kind: type = np.uint64) -> np.ndarray:
    raw = zstandard.decompress(raw)
    rows = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((rows.shape[1], 8), np.uint8)
    out[:, : raw[0]] = rows.T
    return out.view(np.uint64).ravel().astype(kind, copy=False)


def rising(x: np.ndarray) -> bytes:
    """Numbers in sorted runs, by what each adds to the one before, modulo 2 to the power of 64."""
    return planes(np.diff(x, prepend=np.uint64(0)))


def risen(raw: bytes) -> np.ndarray:
    return np.cumsum(numbers(raw), dtype=np.uint64)


def places(order: np.ndarray) -> np.ndarray:
    """Where each item comes in an order."""
    at = np.empty(len(order), np.uint32)
    at[order] = np.arange(len(order), dtype=np.uint32)
    return at


def by_frequency(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, frequent ones first, and where each item's value is: mostly small numbers.
    Values alike in frequency, by powers of two, are sorted."""
    values, at, counts = np.unique(x, return_inverse=True, return_counts=True)
    order = np.lexsort((values, -np.log2(counts).astype(np.int64)))
    return values[order], places(order)[at]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time: those of chunks are large."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def bigram_keys(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(31) + token) >> np.uint64(64 - KEY_BITS[BIGRAMS])


# Chunks and their requests -----------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = word_hashes()
    ids, kinds, parts, size = [], [], [], 0

    def chunk() -> pa.RecordBatch:
        lengths = np.array([len(p) for p in parts], np.int32)
        kind = np.array(kinds)
        words, tokens = by_frequency(np.concatenate(parts))
        row = {
            "chunk": uuid.uuid4().hex,
            "n_tokens": int(lengths.sum()),
            "n_training": int(lengths[kind != HELD_OUT].sum()),
            "n_set_aside": int(lengths[kind == SET_ASIDE].sum()),
            "docs": int((kind != HELD_OUT).sum()),
            "docs_set_aside": int((kind == SET_ASIDE).sum()),
            "doc_ids": ids,
            "kinds": kinds,
            "lengths": lengths.tolist(),
            "words": rising(words),
            "tokens": planes(tokens),
        }
        types = {"doc_ids": pa.list_(pa.int64()), "kinds": pa.list_(pa.int32()), "lengths": pa.list_(pa.int32())}
        return pa.record_batch([pa.array([v], types.get(n)) for n, v in row.items()], names=list(row))

    for batch in batches:
        for doc_id, kind, text in zip(*(c.to_pylist() for c in batch.columns)):
            parts.append(np.append(hashes.of(words_of(text)), END))
            ids.append(doc_id)
            kinds.append(kind)
            size += len(parts[-1])
            if size >= CHUNK_TOKENS:
                yield chunk()
                ids, kinds, parts, size = [], [], [], 0
    if parts:
        yield chunk()


@dataclass
class Tokens:
    """A chunk's tokens: words, contexts, bigrams and what kind of document each is in."""

    words: np.ndarray
    tokens: np.ndarray
    bigrams: np.ndarray
    pairs: np.ndarray
    first: np.ndarray
    kind: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Tokens:
        words = risen(row["words"])
        order = np.argsort(words)
        words, tokens = words[order], places(order)[numbers(row["tokens"], np.uint32)]
        lengths = np.array(row["lengths"], np.int64)
        first = np.cumsum(lengths) - lengths
        hashes = words[tokens]
        before = np.roll(hashes, 1)
        before[first] = START
        bigrams, pairs = np.unique(bigram_keys(before, hashes), return_inverse=True)
        return cls(words, tokens, bigrams, pairs, first, np.repeat(np.array(row["kinds"]), lengths))


def _requests(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        t = Tokens.of(row)
        for kind, keys, at in ((WORDS, t.words, t.tokens), (BIGRAMS, t.bigrams, t.pairs)):
            counts = np.bincount(at[t.kind != HELD_OUT], minlength=len(keys)).astype(np.uint32)
            aside = np.bincount(at[t.kind == SET_ASIDE], minlength=len(keys)).astype(np.uint32)
            span = (1 << KEY_BITS[kind]) // ranges + 1
            cuts = np.searchsorted(keys, np.array([r * span for r in range(1, ranges)], np.uint64))
            bounds = [0, *cuts.tolist(), len(keys)]
            out = [
                (kind, r, row["chunk"], rising(keys[a:b]), planes(counts[a:b]), planes(aside[a:b]))
                for r, (a, b) in enumerate(zip(bounds, bounds[1:]))
                if b > a
            ]
            types = (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())
            names = ("kind", "range", "chunk", "keys", "counts", "aside")
            yield pa.record_batch([pa.array(c, x) for c, x in zip(zip(*out), types)], names=names)


def _sum_range(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    kind, at = key[0].as_py(), key[1].as_py()
    keys = [risen(x) for x in table.column("keys").to_pylist()]
    distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
    bounds = np.cumsum([len(k) for k in keys])[:-1]
    columns, n_distinct = [], 0
    for name in ("counts", "aside"):
        own = np.concatenate([numbers(x) for x in table.column(name).to_pylist()])
        total = np.bincount(where, weights=own, minlength=len(distinct)).astype(np.uint64)
        if name == "counts":
            n_distinct = int((total > 0).sum())
        columns.append([planes(x) for x in np.split(total[where], bounds)])
    n = table.num_rows
    chunks = table.column("chunk").to_pylist()
    # Given to one chunk, the same one when the range is summed again.
    first = chunks.index(min(chunks))
    return pa.table(
        {
            "kind": pa.array([kind] * n, pa.int32()),
            "range": pa.array([at] * n, pa.int32()),
            "chunk": table.column("chunk"),
            "counts": pa.array(columns[0], pa.binary()),
            "aside": pa.array(columns[1], pa.binary()),
            "n_distinct": pa.array([n_distinct * (i == first) for i in range(n)], pa.int64()),
        }
    )


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a chunk's documents with the counts of each token and of the bigram it ends; the
    set-aside counts only of set-aside documents, which alone need them for the learning. A chunk's
    first block has the number of distinct training words of the ranges that it answers for."""
    for row in rows_of(batches):
        t = Tokens.of(row)

        def answered(kind: int, name: str) -> np.ndarray:
            parts = sorted((a["range"], a[name]) for a in row["answers"] if a["kind"] == kind)
            return np.concatenate([numbers(x) for _, x in parts])

        c1, c2 = answered(WORDS, "counts")[t.tokens], answered(BIGRAMS, "counts")[t.pairs]
        a1, a2 = answered(WORDS, "aside")[t.tokens], answered(BIGRAMS, "aside")[t.pairs]
        distinct = sum(a["n_distinct"] for a in row["answers"] if a["kind"] == WORDS)
        bounds = [*t.first[::DOCS_PER_BLOCK].tolist(), len(c1)]
        for i, (start, end) in enumerate(zip(bounds, bounds[1:])):
            docs = slice(i * DOCS_PER_BLOCK, (i + 1) * DOCS_PER_BLOCK)
            aside = start + np.flatnonzero(t.kind[start:end] == SET_ASIDE)
            c1_values, c1_at = by_frequency(c1[start:end])
            block = {
                "doc_ids": pa.array([row["doc_ids"][docs]], pa.list_(pa.int64())),
                "kinds": pa.array([row["kinds"][docs]], pa.list_(pa.int32())),
                "lengths": pa.array([row["lengths"][docs]], pa.list_(pa.int32())),
                "c1_values": pa.array([rising(c1_values)]),
                "c1": pa.array([planes(c1_at)]),
                "c2": pa.array([planes(c2[start:end])]),
                "a1": pa.array([planes(a1[aside])]),
                "a2": pa.array([planes(a2[aside])]),
                "n_distinct": pa.array([distinct * (i == 0)], pa.int64()),
            }
            yield pa.record_batch(block)


# Learning ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Totals:
    """Training tokens, distinct training tokens and training documents; of them, set aside."""

    tokens: int
    distinct: int
    docs: int
    tokens_aside: int
    docs_aside: int


def buckets(contexts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(contexts + 1.0).astype(np.int64), BUCKETS - 1)


def _steps(chance: np.ndarray) -> np.ndarray:
    """0 for no chance, else 1 for the least and more for greater ones."""
    with np.errstate(divide="ignore"):
        at = np.round(np.log2(chance) * STEPS)
    return np.where(chance > 0, np.maximum(at + SIDE - 1, 1), 0).astype(np.int64)


def _of_steps(at: np.ndarray) -> np.ndarray:
    return np.where(at > 0, 2.0 ** ((at - SIDE + 1) / STEPS), 0.0)


def token_counts(block: dict) -> tuple[np.ndarray, np.ndarray]:
    """Counts of a block's tokens and of their bigrams."""
    c1 = risen(block["c1_values"])[numbers(block["c1"], np.uint32)]
    return c1.astype(float), numbers(block["c2"]).astype(float)


def contexts_of(c1: np.ndarray, first: np.ndarray, docs: int) -> np.ndarray:
    """Frequency of the context of each token: the word before, or the start at the first of a text."""
    before = np.roll(c1, 1)
    before[first] = docs
    return before


def _cells(batches: Iterator[pa.RecordBatch], totals: Totals) -> Iterator[pa.RecordBatch]:
    n = max(1, totals.tokens - totals.tokens_aside)
    for row in rows_of(batches):
        kinds, lengths = np.array(row["kinds"]), np.array(row["lengths"], np.int64)
        aside = np.repeat(kinds == SET_ASIDE, lengths)
        lengths = lengths[kinds == SET_ASIDE]
        c1, c2 = (c[aside] for c in token_counts(row))
        a1, a2 = (numbers(row[k]).astype(float) for k in ("a1", "a2"))
        r1, r2 = c1 - a1, c2 - a2
        context = contexts_of(r1, np.cumsum(lengths) - lengths, totals.docs - totals.docs_aside)
        p2 = np.divide(r2, context, out=np.zeros_like(r2), where=context > 0)
        found = (buckets(context) * SIDE + _steps(p2)) * SIDE + _steps(r1 / n)
        cells, counts = np.unique(found, return_counts=True)
        yield pa.record_batch([pa.array(cells, pa.int64()), pa.array(counts, pa.int64())], names=["cell", "n"])


def learn_weights(cells: np.ndarray, n: np.ndarray, distinct: int) -> np.ndarray:
    """Weights (l2, l1, l0) of every bucket by expectation-maximisation. One token that each part
    explains alone is added to every bucket, so no weight is 0 and empty buckets are even."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    b, p2, p1 = cells // (SIDE * SIDE), _of_steps(cells // SIDE % SIDE), _of_steps(cells % SIDE)
    chances = np.stack([p2, p1, np.full(len(cells), 1 / (distinct + 1))], axis=1)
    for _ in range(EM_ROUNDS):
        share = weights[b] * chances
        share *= (n / share.sum(axis=1))[:, None]
        total = np.ones((BUCKETS, 3))
        np.add.at(total, b, share)
        new = total / total.sum(axis=1, keepdims=True)
        if np.abs(new - weights).max() < 1e-9:
            return new
        weights = new
    return weights


def _score(batches: Iterator[pa.RecordBatch], totals: Totals, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    n, v = totals.tokens, totals.distinct
    for row in rows_of(batches):
        lengths = np.array(row["lengths"], np.int64)
        first = np.cumsum(lengths) - lengths
        c1, c2 = token_counts(row)
        base = np.log10((c1 + 0.5) / (n + 0.5 * (v + 1)))
        context = contexts_of(c1, first, totals.docs)
        w = weights[buckets(context)]
        p2 = np.divide(c2, context, out=np.zeros_like(c2), where=context > 0)
        chance = w[:, 0] * p2 + w[:, 1] * c1 / n + w[:, 2] / (v + 1) if n else np.ones_like(c1)
        columns = {
            "doc_id": pa.array(row["doc_ids"], pa.int64()),
            "held_out": pa.array(np.array(row["kinds"]) == HELD_OUT),
            "n_tokens": pa.array(lengths),
            "n_known": pa.array(np.add.reduceat((c1 > 0).astype(np.int64), first)),
            "train_tokens": pa.array(np.full(len(lengths), n, np.int64)),
            "base_score": pa.array(np.add.reduceat(base, first)),
            "score": pa.array(np.add.reduceat(np.log10(chance), first)),
        }
        yield pa.record_batch(columns)


SCORE_SCHEMA = (
    "doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, "
    "base_score DOUBLE, score DOUBLE"
)


def counted_tokens(docs: DataFrame, modulus: int, held: int, aside: int) -> tuple[DataFrame, Totals]:
    """The stored blocks of documents with the counts of their tokens, and the totals."""
    kind = (
        F.when(held_out(modulus, held), HELD_OUT)
        .when(F.coalesce(remainder(modulus) == aside, F.lit(False)), SET_ASIDE)
        .otherwise(TRAINING)
    )
    rows = docs.select(F.col("doc_id").cast("bigint"), kind.alias("kind"), "text")
    chunks = stage(rows.mapInArrow(_chunks, CHUNK_SCHEMA), "chunks")
    sums = chunks.agg(*(F.sum(c).alias(c) for c in ("n_tokens", "n_training", "n_set_aside", "docs", "docs_set_aside")))
    size = {k: v or 0 for k, v in sums.first().asDict().items()}
    ranges = max(16, -(-size["n_tokens"] // TOKENS_PER_RANGE))
    requests = chunks.select("chunk", "kinds", "lengths", "words", "tokens").mapInArrow(
        partial(_requests, ranges=ranges), REQUEST_SCHEMA
    )
    answers = requests.groupBy("kind", "range").applyInArrow(_sum_range, ANSWER_SCHEMA)
    of_chunk = answers.groupBy(F.col("chunk").alias("asked_by")).agg(
        F.collect_list(F.struct("kind", "range", "counts", "aside", "n_distinct")).alias("answers")
    )
    joined = chunks.join(of_chunk, F.col("chunk") == F.col("asked_by"))
    joined = joined.select("doc_ids", "kinds", "lengths", "words", "tokens", "answers")
    counted = stage(joined.mapInArrow(_count_tokens, COUNTED_SCHEMA), "counted-documents")
    distinct = counted.agg(F.sum("n_distinct")).first()[0] or 0
    totals = Totals(size["n_training"], distinct, size["docs"], size["n_set_aside"], size["docs_set_aside"])
    return counted, totals


def score_documents(docs: DataFrame, modulus: int = 5, held: int = 1, aside: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row. Rows whose
    remainder is ``held`` are not learned from; of the others, those whose remainder is ``aside`` are
    set aside to learn the weights."""
    counted, totals = counted_tokens(docs, modulus, held, aside)
    cells = (
        counted.where(F.array_contains("kinds", SET_ASIDE))
        .mapInArrow(partial(_cells, totals=totals), "cell BIGINT, n BIGINT")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()
        .sort_by("cell")
    )
    weights = learn_weights(cells.column("cell").to_numpy(), cells.column("n").to_numpy(), totals.distinct)
    return counted.mapInArrow(partial(_score, totals=totals, weights=weights), SCORE_SCHEMA)
