"""Exact deduplication against a minimal perfect hash over historical distinct digests.

The index of a history is one row per shard: a hash function that maps the shard's distinct SHA-256
digests onto slots ``0..n-1`` without gaps or collisions, and for every slot the full digest, the
``doc_id`` of its winner (the largest) and the number of rows. A batch is looked up shard by shard.
A slot is believed only after its full digest equals the one looked up: such rows repeat the
history; the others are grouped by their own digest.

The hash function is a cascade of bit arrays: a digest sits at the first level on which no other
digest of the shard shares its position, and its slot is the number of set bits before it.

Skew: rows are counted per digest before any digest is sent to a shard, so a text on a third of all
rows is one row there. Shards are sized by the number of distinct digests.

Defined results: a null text equals the empty text; texts are equal when identical byte for byte; a
row without ``doc_id`` is grouped like any other, never wins against a row with one, and is kept
only where all rows of its text lack one; rows that repeat ``doc_id`` and text share one decision;
empty tables give empty results. Other columns of the input are neither read nor required.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import keep_rows, mix, text_key
from tallyhouse.storage import stage

# Digests per shard of an index: 72 bytes each in the task that builds or reads it.
KEYS_PER_SHARD = 100_000
# Shards of even a small index, so that its work is spread.
LEAST_SHARDS = 256
# Positions per key on each level: more gives fewer levels and a larger function.
POSITIONS_PER_KEY = 2

INDEX_SCHEMA = (
    "shard INT, level_sizes ARRAY<INT>, bits BINARY, digests BINARY, winners ARRAY<BIGINT>, "
    "sizes ARRAY<BIGINT>"
)
GROUP_SCHEMA = "digest BINARY, keep_id BIGINT, group_size BIGINT, in_history BOOLEAN, repeats BIGINT"


# The hash function -------------------------------------------------------------------------------


def as_words(digests: list[bytes]) -> np.ndarray:
    """Digests of 32 bytes as rows of four 64-bit numbers."""
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


def _positions(words: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return mix(words[:, level % 4] ^ mix(words[:, (level + 1) % 4] + seed)) % np.uint64(size)


def build_function(words: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and the bits of all levels for distinct digests."""
    sizes, levels, rest = [], [], words
    while len(rest):
        size = POSITIONS_PER_KEY * len(rest) + 1
        at = _positions(rest, len(sizes), size)
        alone = np.bincount(at.astype(np.int64), minlength=size) == 1
        sizes.append(size)
        levels.append(alone)
        rest = rest[~alone[at]]
        if len(sizes) > 500:
            raise ValueError("the digests of a shard are not distinct")
    return sizes, np.concatenate(levels) if levels else np.zeros(0, dtype=bool)


def slots_of(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of every digest; -1 or any slot for one the function was not built for."""
    before = np.cumsum(bits) - bits
    slots = np.full(len(words), -1, dtype=np.int64)
    rest, start = np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        if not len(rest):
            break
        at = _positions(words[rest], level, size).astype(np.int64) + start
        found = bits[at]
        slots[rest[found]] = before[at[found]]
        rest, start = rest[~found], start + size
    return slots


# The index ---------------------------------------------------------------------------------------


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, text_key_) of every row: SHA-256 of the whole text in UTF-8, and the key that
    names the row with its id."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), text_key().alias("text_key_"))


def _per_digest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(
        F.max("doc_id").cast("bigint").alias("winner"), F.count("*").alias("size")
    )


def _sharded(per_digest: DataFrame, shards: int) -> DataFrame:
    return per_digest.withColumn(
        "shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")
    )


def _build_shard(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    table = table.sort_by("digest")
    keys = table.column("digest").to_pylist()
    words = as_words(keys)
    sizes, bits = build_function(words)
    order = np.argsort(slots_of(words, sizes, bits))
    return pa.table(
        {
            "shard": pa.array([key[0].as_py()], pa.int32()),
            "level_sizes": pa.array([sizes], pa.list_(pa.int32())),
            "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            "digests": pa.array([b"".join(keys[i] for i in order)], pa.binary()),
            "winners": pa.array([table.column("winner").take(order).to_pylist()], pa.list_(pa.int64())),
            "sizes": pa.array([table.column("size").take(order).to_pylist()], pa.list_(pa.int64())),
        }
    )


def build_index(history: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> tuple[DataFrame, int]:
    """Stored index over the (doc_id, digest) rows of a history, and its number of shards."""
    distinct = stage(_per_digest(history), "digests")
    shards = max(LEAST_SHARDS, -(-distinct.count() // keys_per_shard))
    index = _sharded(distinct, shards).groupBy("shard").applyInArrow(_build_shard, INDEX_SCHEMA)
    return stage(index, "mph"), shards


def _look_up_shard(_: tuple, new: pa.Table, index: pa.Table) -> pa.Table:
    keys = new.column("digest").to_pylist()
    winners, counts = new.column("winner").to_pylist(), new.column("size").to_pylist()
    out: dict[str, list] = {n: [] for n in ("digest", "keep_id", "group_size", "in_history", "repeats")}

    def add(*values: object) -> None:
        for column, value in zip(out.values(), values):
            column.append(value)

    if index.num_rows:
        row = index.to_pylist()[0]
        stored = np.frombuffer(row["digests"], dtype="<u8").reshape(-1, 4)
        bits = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8))[: sum(row["level_sizes"])]
        words = as_words(keys)
        slots = slots_of(words, row["level_sizes"], bits.astype(bool))
        member = slots >= 0
        member[member] = (stored[slots[member]] == words[member]).all(axis=1)
        at = {int(s): i for i, s in enumerate(slots) if member[i]}
        for slot, (winner, size) in enumerate(zip(row["winners"], row["sizes"])):
            i = at.get(slot)
            if i is None:
                best, more = winner, 0
            else:
                best = max((w for w in (winner, winners[i]) if w is not None), default=None)
                more = counts[i]
            add(row["digests"][32 * slot : 32 * slot + 32], best, size + more, True, more)
    else:
        member = np.zeros(len(keys), dtype=bool)
    for i in np.flatnonzero(~member):
        add(keys[i], winners[i], counts[i], False, counts[i] - 1)
    types = (pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.int64())
    return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), types)})


def look_up(batch: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """One row per distinct digest of history or batch: the winner, the number of rows, whether the
    history holds it, and how many rows of the batch are repeats."""
    new = _sharded(_per_digest(batch), shards)
    return (
        new.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_look_up_shard, GROUP_SCHEMA)
    )


# The operator ------------------------------------------------------------------------------------


def newer_half(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A history for a single table: the rows from the middle of its id range upwards, whose winners
    then stay when older rows repeat them; and the rest, rows without id included."""
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    newer = F.lit(False) if low is None else F.coalesce(F.col("doc_id") >= (low + high) // 2, F.lit(False))
    return rows.where(newer), rows.where(~newer)


def exact_groups(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """(doc_id, digest, keep_id, group_size, kept, text_key_) of every row of ``docs``, and of ``history`` if it
    is given; without one, the newer half of ``docs`` serves as the history."""
    rows = digests(docs) if history is None else digests(docs).unionByName(digests(history))
    rows = stage(rows, "document-digests")
    old, new = newer_half(rows) if history is None else (digests(history), digests(docs))
    index, shards = build_index(old)
    groups = look_up(new, index, shards).where("group_size > 1")
    groups = stage(groups.select("digest", "keep_id", "group_size"), "digest-groups")
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return (
        rows.join(groups, "digest", "left")
        .withColumn("keep_id", keep_id)
        .withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("bigint")))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select("doc_id", "digest", "keep_id", "group_size", "kept", "text_key_")
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with its own columns and one document of each text: the one with the largest id, or one
    of those without id if no other has the text. Rows alike in id and text are one document."""
    return keep_rows(docs, exact_groups(docs))
