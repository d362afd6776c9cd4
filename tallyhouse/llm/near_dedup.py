"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

Two permutations make all signature coordinates. The first spreads a shingle over ``2**20`` places;
coordinate ``k`` is the least value of the second over a document's places, shifted round by ``k``.
The second permutation is a table that is continued by its own start, so the coordinates of a
shingle are a run of neighbouring entries.

Steps: (1) documents with the same shingle set form a class; only classes are compared. (2) Each
class has one key per band of the signature. In every bucket with several classes, the least and
the greatest are paired with all others. (3) Pairs are verified on full sets; verified pairs give
components. (4) The classes of buckets that still hold several components are searched completely,
by an exact prefix index over their sets (``prefix_pairs``): every pair from different components that
can reach the similarity is verified too. Classes of one component need no more pairs, as the result
cannot change. So a bucket of thousands of near copies costs two pairs per class, and no link is lost
that a shared bucket shows.

A pair at the threshold of 0.8 shares no bucket with probability ``(1 - 0.8**8)**64 = 8e-6``;
one at 0.3, such as two short texts around one common passage, shares one with 0.4 per cent.

Shingles are held as 64-bit hashes, classes as 64-bit hashes of sets.

Defined results: null, empty and blank texts have no shingles, are linked with nothing, and their
component is their own id; a text of fewer words than a shingle is one shingle; rows without
``doc_id`` are grouped like others, and a component of such rows only has a null id; a repeated
``doc_id`` stands for each of its texts, and is dropped only with those that are copies; empty tables
give empty results. Other columns of the
input are neither read nor required.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import WordHashes, keep_rows, mix, text_key, with_ids, word_hashes, words_of
from tallyhouse.llm.components import components
from tallyhouse.storage import stage

BANDS, ROWS_PER_BAND = 64, 8
COORDINATES = BANDS * ROWS_PER_BAND
PLACES = 1 << 20
# Shingles whose coordinates are looked up at once: 2 MB of work space.
AT_ONCE = 1024

SIGNATURE_SCHEMA = "doc_id BIGINT, text_key_ BIGINT, n_shingles BIGINT, class_id BIGINT, bands ARRAY<BIGINT>"
SET_SCHEMA = "class_id BIGINT, shingles ARRAY<BIGINT>"


@cache
def permutations() -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and the run of ``COORDINATES`` shifts of the second at every place."""
    rng = np.random.Generator(np.random.PCG64(20))
    first = rng.permutation(PLACES).astype(np.uint32)
    second = rng.permutation(PLACES).astype(np.uint32)
    round_ = np.concatenate([second, second[: COORDINATES - 1]])
    return first, np.lib.stride_tricks.sliding_window_view(round_, COORDINATES)


def shingle_set(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; one for the whole of a shorter text."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    of_words = hashes.of(words)
    n = min(n, len(words))
    value = mix(of_words[: len(words) - n + 1] + np.uint64(n))
    for k in range(1, n):
        value = mix(value * np.uint64(31) + of_words[k : len(words) - n + 1 + k])
    return np.unique(value)


def signature(shingles: np.ndarray) -> np.ndarray:
    first, runs = permutations()
    places = first[(shingles >> np.uint64(44)).astype(np.int64)]
    least = np.full(COORDINATES, PLACES, dtype=np.uint32)
    for start in range(0, len(places), AT_ONCE):
        np.minimum(least, runs[places[start : start + AT_ONCE]].min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS_PER_BAND).astype(np.uint64)
    key = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for k in range(ROWS_PER_BAND):
        key = mix(key * np.uint64(31) + rows[:, k])
    return key.view(np.int64)


def class_of(shingles: np.ndarray) -> int:
    """A hash of the set: it depends on every member and on nothing else."""
    spread = mix(shingles + np.uint64(0x9E3779B97F4A7C15))
    total = np.array([spread.sum(dtype=np.uint64) + np.uint64(len(shingles))], dtype=np.uint64)
    return int(mix(total).view(np.int64)[0])


def _sign(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    hashes = word_hashes()
    for batch in batches:
        sizes, classes, bands = [], [], []
        for text in batch.column(1):
            shingles = shingle_set(text.as_py(), n, hashes)
            sizes.append(len(shingles))
            classes.append(class_of(shingles) if len(shingles) else None)
            bands.append(band_keys(signature(shingles)) if len(shingles) else None)
        yield pa.record_batch(
            [
                batch.column(0).cast(pa.int64()),
                batch.column(2),
                pa.array(sizes, pa.int64()),
                pa.array(classes, pa.int64()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            names=["doc_id", "text_key_", "n_shingles", "class_id", "bands"],
        )


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, text_key_, n_shingles, class_id, bands) of every row; the last two are null without
    words."""
    return docs.select("doc_id", "text", text_key().alias("text_key_")).mapInArrow(partial(_sign, n=n), SIGNATURE_SCHEMA)


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    hashes = word_hashes()
    for batch in batches:
        sets = [shingle_set(t.as_py(), n, hashes) for t in batch.column(0)]
        yield pa.record_batch(
            [
                pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ],
            names=["class_id", "shingles"],
        )


def class_sets(wanted: DataFrame, docs: DataFrame, signed: DataFrame, n: int) -> DataFrame:
    """(class_id, shingles) of the wanted classes, stored. The sets are made anew from one document
    of each class, so that only those of candidates are ever stored."""
    wanted = stage(wanted.select("class_id").distinct(), "wanted-classes")
    rows = signed.groupBy("class_id").agg(F.min("doc_id").alias("doc_id"))
    rows = rows.join(wanted, "class_id", "left_semi")
    texts = with_ids(docs.select("doc_id", "text"), rows.where("doc_id IS NOT NULL"), "doc_id")
    texts = texts.unionByName(docs.select("doc_id", "text").where("doc_id IS NULL"))
    sets = texts.select("text").mapInArrow(partial(_sets, n=n), SET_SCHEMA)
    sets = sets.join(wanted, "class_id", "left_semi")
    return stage(sets.groupBy("class_id").agg(F.first("shingles").alias("shingles")), "shingle-sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach the similarity."""
    both = (
        pairs.join(sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("of_a")), "a")
        .join(sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("of_b")), "b")
        .withColumn("common", F.size(F.array_intersect("of_a", "of_b")))
    )
    union = F.size("of_a") + F.size("of_b") - F.col("common")
    return both.where(100 * F.col("common") >= percent * union).select("a", "b")


def prefix_pairs(classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes with different labels that can reach the similarity.

    Shingles are put in one order: first those that only classes of one label have, then by how many
    classes have them, rare ones first. A set of ``s`` shingles shares at least ``percent * s / 100`` of
    them with any set it is linked with, so both have one of their first ``s - percent * s / 100 + 1``
    in common. Only these are indexed, and of them only those that more than one label has. So what
    the classes of a label have among themselves, or a class alone, makes no pair, and neither does a
    passage that many classes have, unless a set is little else. A pair is made at its first common
    shingle only if enough others follow it on both sides."""
    rows = sets.join(classes, "class_id").select(
        "class_id", "label", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle")
    )
    shared = rows.groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("label").alias("x"), F.max("label").alias("y")
    )
    of_class = Window.partitionBy("class_id")
    # Shingles of one label fill the first places; ``total`` others follow.
    prefix = (
        rows.join(shared.where("x < y").select("shingle", "n"), "shingle")
        .withColumn("place", F.row_number().over(of_class.orderBy("n", "shingle")))
        .withColumn("total", F.count("*").over(of_class))
        .withColumn("least", F.ceil(F.col("size") * percent / 100))
        .where("place <= total - least + 1")
    )
    # What a set can still have in common with another whose first common shingle is this one.
    prefix = prefix.select("shingle", "class_id", "label", "size", (F.col("total") - F.col("place") + 1).alias("left"))
    prefix = stage(prefix, "prefixes")
    a, b = prefix.alias("a"), prefix.alias("b")
    reach = (100 + percent) * F.least("a.left", "b.left") >= percent * (F.col("a.size") + F.col("b.size"))
    found = a.join(
        b,
        (F.col("a.shingle") == F.col("b.shingle"))
        & (F.col("a.class_id") < F.col("b.class_id"))
        & (F.col("a.label") != F.col("b.label"))
        & (100 * F.least("a.size", "b.size") >= percent * F.greatest("a.size", "b.size"))
        & reach,
    )
    return found.select(F.col("a.class_id").alias("a"), F.col("b.class_id").alias("b")).distinct()


def class_links(docs: DataFrame, signed: DataFrame, n: int, percent: int) -> DataFrame:
    """(class_id, label) of every class that is linked with another; equal labels are connected."""
    classes = signed.where("class_id IS NOT NULL").groupBy("class_id").agg(
        F.first("n_shingles").alias("size"), F.first("bands").alias("bands")
    )
    classes = stage(classes, "classes")
    keys = classes.select(F.explode("bands").alias("key"), "class_id", "size")
    buckets = keys.groupBy("key").agg(F.min("class_id").alias("least"), F.max("class_id").alias("greatest"))
    buckets = stage(buckets.where("least < greatest"), "buckets")
    members = stage(keys.join(buckets, "key"), "bucket-members")

    first = members.select("class_id", F.explode(F.array("least", "greatest")).alias("other"))
    first = first.where("class_id <> other").select(
        F.least("class_id", "other").alias("a"), F.greatest("class_id", "other").alias("b")
    )
    checked = stage(first.distinct(), "first-pairs")
    ends = checked.select(F.explode(F.array("a", "b")).alias("class_id"))
    links = stage(verified(checked, class_sets(ends, docs, signed, n), percent), "first-links")
    labels = components(links)

    labelled = members.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left")
    labelled = labelled.select("key", "class_id", "size", F.coalesce("label", "class_id").alias("label"))
    labelled = stage(labelled, "labelled-members")
    open_ = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    open_ = stage(labelled.join(open_.where("x < y").select("key"), "key", "left_semi"), "open-members")
    if open_.isEmpty():
        return labels
    sets = class_sets(open_, docs, signed, n)
    labelled_classes = stage(open_.select("class_id", "label").distinct(), "open-classes")
    rest = prefix_pairs(labelled_classes, sets, percent)
    rest = stage(rest.join(checked, ["a", "b"], "left_anti"), "rest-pairs")
    more = stage(verified(rest, sets, percent), "rest-links")
    return labels if more.isEmpty() else components(links.unionByName(more))


def grouped(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, text_key_, n_shingles, class_id, first) of every row: ``first`` names the row of the
    component with the smallest id, or with the smallest key if none has an id; null without words."""
    signed = stage(signatures(docs, n), "signatures")
    labels = class_links(docs, signed, n, percent)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key_")
    per_class = signed.where("class_id IS NOT NULL").groupBy("class_id").agg(F.min(row).alias("least"))
    per_class = per_class.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left")
    per_class = stage(per_class.withColumn("label", F.coalesce("label", "class_id")), "class-labels")
    least = per_class.groupBy("label").agg(F.min("least").alias("first"))
    per_class = per_class.join(least, "label").select("class_id", "first")
    return signed.select("doc_id", "text_key_", "n_shingles", "class_id").join(per_class, "class_id", "left")


def near_groups(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: the size of its set, the smallest
    ``doc_id`` that links lead to, and whether that is its own. Two documents are linked when
    ``100 * intersection >= percent * union`` of their sets of ``n``-word shingles."""
    component = F.when(F.col("class_id").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return (
        grouped(docs, n, percent)
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_copies(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with its own columns and one row of each group: the one with the smallest id, of the
    group's texts under that id the one with the smallest key. Rows without words are in no group."""
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key_")
    kept = F.col("class_id").isNull() | own.eqNullSafe(F.col("first"))
    return keep_rows(docs, grouped(docs, n, percent).select("doc_id", "text_key_", kept.alias("kept")))
