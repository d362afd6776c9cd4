"""What several text operators share: words, splits by id, bounded label samples, id sets."""

from __future__ import annotations

from functools import cache

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.storage import stage

# Words remembered by a Python worker; beyond this a hash is computed anew each time.
REMEMBERED_WORDS = 150_000
# Most ids that are sent to every executor (8 bytes each); a larger set is joined by shuffling.
BROADCAST_IDS = 2_000_000

# Most (id, text key) rows that are sent to every executor (about 80 bytes each).
BROADCAST_ROWS = 500_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, as UTF-8. Bytes split and lower exactly that
    way: ASCII white space and ASCII letters only."""
    return text.encode("utf-8", "replace").lower().split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED_WORDS:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


@cache
def word_hashes() -> WordHashes:
    """One for each Python worker, which keeps what it remembers from task to task."""
    return WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def remainder(modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def held_out(modulus: int, value: int) -> Column:
    """Whether a document is kept from training; a null id counts as not held out."""
    return F.coalesce(remainder(modulus) == value, F.lit(False))


def usable_labels(labels: DataFrame, label: str, modulus: int, held: int) -> DataFrame:
    """(doc_id, label) of all labelled documents that may be learned from. Null ids and null labels are
    left out; an id labelled more than once gets its largest label."""
    usable = labels.where(F.col(label).isNotNull() & (remainder(modulus) != held))
    return usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))


def labelled_sample(
    labels: DataFrame, label: str, modulus: int, held: int, max_rows: int
) -> DataFrame:
    """At most ``max_rows`` of the usable labels: those with the smallest id hashes, so the choice does
    not depend on task order."""
    usable = usable_labels(labels, label, modulus, held)
    return usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def sampled_documents(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(text, label) of the documents in a sample, whose size its ``max_rows`` bounds."""
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label")


def text_key(text: str = "text") -> Column:
    """A number for a whole text; null counts as empty. With the id it names a row: ids may be missing
    or repeated, so no decision goes by the id alone."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _among(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose id and text key are (``left_semi``) or are not (``left_anti``) in ``rows``,
    which go to every executor up to ``BROADCAST_ROWS``."""
    named = rows.select(F.col("doc_id").alias("id_"), F.col("text_key_").alias("key_"))
    side = F.broadcast(named) if rows.count() <= BROADCAST_ROWS else named
    same = (F.col("text_key_") == F.col("key_")) & F.col("doc_id").eqNullSafe(F.col("id_"))
    return docs.join(side, same, how)


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """``docs`` with its own columns without what is not ``kept`` in ``decided`` (doc_id, text_key_, kept),
    and with one row of those that are alike in id and text."""
    decided = decided.groupBy("doc_id", "text_key_").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    decided = stage(decided.where("NOT kept OR n > 1"), "decided-rows")
    named = docs.withColumn("text_key_", text_key())
    kept = _among(named, decided, "left_anti")
    repeated = decided.where("kept")
    if not repeated.isEmpty():
        kept = kept.unionByName(_among(named, repeated, "left_semi").dropDuplicates(["doc_id", "text_key_"]))
    return kept.drop("text_key_")


def with_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` is among the distinct values of ``ids``. The stored ids are
    counted: up to ``BROADCAST_IDS`` go to every executor, more are joined by shuffling."""
    ids = stage(ids.select(column).distinct(), "ids")
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return df.join(side, column, "left_semi")
