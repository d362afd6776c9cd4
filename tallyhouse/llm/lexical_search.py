"""Ranked lexical search by dense blocked matrix products.

The items of a search are dealt into blocks of bounded size, and each block is one search over all
documents. Its distinct terms are a compact vocabulary. One pass over the documents keeps, for every
document, how many terms it has and how often it holds the terms of that vocabulary; from these follow
the document counts of the terms, and with them the items' weights. The second pass takes tiles of
documents and tiles of the vocabulary: a dense tile of impacts (documents x terms) is multiplied by a
dense tile of weights (terms x items) with BLAS in float64.

All numbers are integers. A vocabulary tile has so few terms that the greatest weight times the
greatest impact times their number stays below 2^53, so every partial sum of a product is exact in
whatever order BLAS adds; tiles are added as 64-bit integers.

Each task keeps, per item, its best documents so far: all rows above the k-th score, and of the ties
at it those with the smallest ids. A task gives at most k rows per item; they are combined by
salted partitions first and then per item.

Memory of a task: one tile of documents, one of weights and k rows per item, whatever the input.
A block's weights are sent to every executor: at most ``BLOCK_TERMS`` terms and ``BLOCK_ITEMS`` items.

Defined results: null texts and texts without a term count neither as documents nor match; an item
without terms, or whose terms no document holds, has no rows; every row of the items is an item of its
own, and every row of the documents a document, repeated ones too; equal scores are ordered by id, a
missing id last, and repeated ids share that place in any order; empty tables give no rows. Other columns
of either table are neither read nor required.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.storage import stage

TOP = 10
BLOCK_ITEMS = 1024
BLOCK_TERMS = 65_536
TILE_DOCUMENTS = 512
TILE_TERMS = 4096
SALTS = 64
# No id: after all others.
NO_ID = np.iinfo(np.int64).max

# Terms are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z are lowered.
# In UTF-8 that is a table of bytes: what separates terms becomes a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

HELD_SCHEMA = "doc_id BIGINT, n BIGINT, terms ARRAY<INT>, tfs ARRAY<INT>"
RANKED_SCHEMA = "item INT, doc_id BIGINT, score BIGINT, salt INT"


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


class Block:
    """Items of one search: their ids, a compact vocabulary and each item's terms in it."""

    def __init__(self) -> None:
        self.item_ids: list[int | None] = []
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[list[int]] = []

    def add(self, item_id: int | None, terms: set[bytes]) -> None:
        self.item_ids.append(item_id)
        self.items.append([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in sorted(terms)])


def blocks_of(items: DataFrame) -> Iterator[Block]:
    """The items in blocks of at most ``BLOCK_ITEMS`` items and, beyond a single item, ``BLOCK_TERMS``
    terms. The driver holds one partition of items and one block at a time."""
    block = Block()
    for row in items.select("item_id", "text").toLocalIterator():
        terms = set(terms_of(row["text"]))
        if not terms:
            continue
        if block.items and (len(block.items) >= BLOCK_ITEMS or len(block.vocabulary) + len(terms) > BLOCK_TERMS):
            yield block
            block = Block()
        block.add(row["item_id"], terms)
    if block.items:
        yield block


def _slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def held_terms(docs: DataFrame, block: Block) -> DataFrame:
    """(doc_id, n, terms, tfs) of the documents that have a term at all, stored."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(block.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for part in _slices(batch, 256):
                ids, sizes, ends, terms, tfs = [], [], [0], [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                    words = terms_of(text.as_py())
                    if not words:
                        continue
                    own, n = np.unique(np.array([known[w] for w in words if w in known], dtype=np.int32), return_counts=True)
                    ids.append(doc_id)
                    sizes.append(len(words))
                    ends.append(ends[-1] + len(own))
                    terms.append(own)
                    tfs.append(n.astype(np.int32))
                none = [np.zeros(0, np.int32)]
                at = pa.array(ends, pa.int32())
                yield pa.record_batch(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(at, pa.array(np.concatenate(terms or none))),
                        pa.ListArray.from_arrays(at, pa.array(np.concatenate(tfs or none))),
                    ],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    return stage(docs.select("doc_id", "text").mapInArrow(run, HELD_SCHEMA), "held-terms")


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def tile_width(greatest_weight: int, greatest_impact: int) -> int:
    """Terms of a vocabulary tile: their sum of products stays below 2^53."""
    return max(1, min(TILE_TERMS, (2**53 - 1) // max(1, greatest_weight * greatest_impact)))


class Best:
    """Per item the k best (score, id) of the tiles so far."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.kept: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * items
        self.least = np.zeros(items, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` (documents x items); a score equal to the least kept one may still win by its id."""
        for item in np.flatnonzero((scores >= np.maximum(self.least, 1)).any(axis=0)):
            rows = np.flatnonzero(scores[:, item] >= max(self.least[item], 1))
            score = np.concatenate([self.kept[item][0], scores[rows, item]])
            own = np.concatenate([self.kept[item][1], ids[rows]])
            first = np.lexsort((own, -score))[: self.k]
            self.kept[item] = (score[first], own[first])
            if len(first) == self.k:
                self.least[item] = score[first[-1]]


def _best_of_task(batches: Iterator[pa.RecordBatch], block: tuple, weights: np.ndarray, documents: int, all_terms: int, k: int) -> Iterator[pa.RecordBatch]:
    size, items = block
    # The least m is 10 and the impact of a term is below 1,000,000,000 div 1,000.
    width = tile_width(int(weights.max()), 1_000_000)
    tiles = []
    for start in range(0, size, width):
        stop = min(start + width, size)
        tile = np.zeros((stop - start, len(items)))
        for item, terms in enumerate(items):
            own = np.array([t for t in terms if start <= t < stop], dtype=np.int64)
            tile[own - start, item] = weights[own]
        tiles.append((start, stop, tile))
    best = Best(len(items), k)
    for batch in batches:
        for part in _slices(batch, TILE_DOCUMENTS):
            sizes = part.column(1).to_pylist()
            m = np.array([10 + (90 * n * documents) // all_terms for n in sizes], dtype=np.int64)
            held = np.diff(part.column(2).offsets.to_numpy())
            rows = np.repeat(np.arange(part.num_rows), held)
            terms = part.column(2).flatten().to_numpy().astype(np.int64)
            tfs = part.column(3).flatten().to_numpy().astype(np.int64)
            impacts = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[rows])
            scores = np.zeros((part.num_rows, len(items)), dtype=np.int64)
            for start, stop, tile in tiles:
                inside = (terms >= start) & (terms < stop)
                if inside.any():
                    dense = np.zeros((part.num_rows, stop - start))
                    dense[rows[inside], terms[inside] - start] = impacts[inside]
                    scores += (dense @ tile).astype(np.int64)
            best.add(scores, pc.fill_null(part.column(0), NO_ID).to_numpy())
    from pyspark import TaskContext

    salt = TaskContext.get().partitionId() % SALTS
    for item, (score, own) in enumerate(best.kept):
        if len(score):
            n = len(score)
            yield pa.record_batch(
                [
                    pa.array([item] * n, pa.int32()),
                    pa.array([None if i == NO_ID else int(i) for i in own], pa.int64()),
                    pa.array(score),
                    pa.array([salt] * n, pa.int32()),
                ],
                names=["item", "doc_id", "score", "salt"],
            )


def search_block(docs: DataFrame, block: Block, k: int) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    held = held_terms(docs, block)
    documents, all_terms = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = held.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(block.vocabulary))
    for term, df in found:
        weights[term] = weight(documents, df)
    shared = spark.sparkContext.broadcast(((len(block.vocabulary), block.items), weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, by_term = shared.value
        return _best_of_task(batches, own, by_term, documents, all_terms, k)

    candidates = held.mapInArrow(run, RANKED_SCHEMA)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))
    candidates = candidates.withColumn("rank", salted).where(F.col("rank") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    names = spark.createDataFrame(list(enumerate(block.item_ids)), "item INT, item_id BIGINT")
    return (
        candidates.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .join(F.broadcast(names), "item")
        .select("item_id", "rank", "doc_id", "score")
    )


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores for every item."""
    found = [search_block(docs, block, k) for block in blocks_of(items)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id BIGINT, rank INT, doc_id BIGINT, score BIGINT")
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def sql(k: int = TOP) -> str:
    """The same question for DuckDB, term by term."""
    terms = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
        WITH doc AS (
            SELECT row_number() OVER () AS r, doc_id, {terms.format("text")} AS words FROM documents
        ), item AS (
            SELECT row_number() OVER () AS i, item_id, list_distinct({terms.format("text")}) AS words FROM benchmark
        ), asked AS (
            SELECT i, item_id, unnest(words) AS term FROM item
        ), total AS (
            SELECT count(*)::BIGINT AS n, sum(len(words))::BIGINT AS l FROM doc WHERE len(words) > 0
        ), counted AS (
            SELECT r, doc_id, any_value(size) AS size, term, count(*)::BIGINT AS tf
            FROM (SELECT r, doc_id, len(words)::BIGINT AS size, unnest(words) AS term FROM doc)
            WHERE term IN (SELECT term FROM asked)
            GROUP BY r, doc_id, term
        ), weighed AS (
            SELECT term, floor(1000 * ln((2 * total.n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM counted, total
            GROUP BY term, total.n
        ), scored AS (
            SELECT i, item_id, r, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * total.n) // total.l))))::BIGINT AS score
            FROM counted JOIN asked USING (term) JOIN weighed USING (term), total
            GROUP BY i, item_id, r, doc_id
        )
        SELECT item_id, rank, doc_id, score
        FROM (
            SELECT item_id, doc_id, score,
                   row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank
            FROM scored WHERE score > 0
        )
        WHERE rank <= {k}
    """
