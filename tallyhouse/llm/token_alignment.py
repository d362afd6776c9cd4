"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids are linked.

Both tokenizers encode a document; a token's place is its byte range. For a batch of documents
``pandas.merge_asof``, keyed by document, finds for the start of every A token the B token that
covers it, and for the start of every B token the covering A token. The union of both directions is
every overlapping pair, in order. An overlap whose two tokens end together closes a group, so groups
are the stretches between common ends. Within a group every A token is linked with every B token.

How many documents hold a linked id pair is counted by Spark: a document gives each of its distinct
pairs once, with the number of its links, and pairs are combined per task before the shuffle. The
counts then go back to the documents in two ways that together cover all pairs: the most frequent
pairs, at most ``HOT_PAIRS`` of them whatever the input, are sent to every executor, so a pair of
every document is never a shuffle key; all others are joined by shuffling. The choice between them is
made by a histogram of counts with one row per power of two.

Batches are cut by bytes, so memory grows with one document's text at most. A group of more than
``LARGE_GROUP`` links, which needs a long stretch without a common token end, is kept as distinct ids
with their numbers instead of single links.

Defined results: null and empty texts, and texts that the joined tokens of either side do not give
back byte for byte, have no tokens, zeros and an empty digest; every input row is a document of its
own, so repeated rows and rows without id count separately; ties for the highest count of an A id
all count; an empty table gives no rows. Other columns of the input are neither read nor required.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.storage import stage

# Bytes of text that are aligned at once, unless one document is longer.
BATCH_BYTES = 1_000_000
# Links of a group beyond which its ids are counted instead of listed.
LARGE_GROUP = 4096
# Most id pairs that are sent to every executor (24 bytes each).
HOT_PAIRS = 100_000

ALIGNED_SCHEMA = (
    "doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, groups_sha256 STRING, "
    "a ARRAY<INT>, b ARRAY<INT>, times ARRAY<BIGINT>"
)


def _numbers(end: str, size: int) -> list[bytes]:
    """The decimal text of every id with a mark after it."""
    return [f"{i}{end}".encode() for i in range(size)]


def _joined(entries: pa.LargeBinaryArray, numbers: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The numbered entries one after another, and the place where each begins, then the end."""
    if not len(numbers):
        return memoryview(b""), np.zeros(1, dtype=np.int64)
    _, places, joined = entries.take(pa.array(numbers)).buffers()
    return memoryview(joined), np.frombuffer(places, dtype=np.int64, count=len(numbers) + 1)


def _bounds(parts: list[np.ndarray]) -> np.ndarray:
    """Where each part begins when all are put together, then the end."""
    return np.cumsum([0] + [len(x) for x in parts])


class Tokenizers:
    """A: byte-level BPE from a list of ranks, with a space before the text. B: a sentencepiece
    model, which adds that space itself."""

    def __init__(self, ranks_path: str, pattern: str, model_path: str) -> None:
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # Without special tokens their strings in a text are plain text.
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.a_entries, self.b_entries = (pa.array(x, pa.large_binary()) for x in (self.a_bytes, self.b_bytes))
        # A ids inside a group, A ids that end their side of it, and the same of B.
        marks = [(",", self.a_bytes), ("|", self.a_bytes), (",", self.b_bytes), (";", self.b_bytes)]
        self.said = pa.array([x for end, side in marks for x in _numbers(end, len(side))], pa.large_binary())

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides for each text; none if either side does not give back the text."""
        a = [np.array(self.a.encode_ordinary(" " + t) if t else [], dtype=np.int32) for t in texts]
        b = self.b.encode([t or "" for t in texts], num_threads=1, return_type="numpy")
        raw = [b" " + t.encode() if t else b"" for t in texts]
        for ids, entries in ((a, self.a_entries), (b, self.b_entries)):
            joined, places = _joined(entries, np.concatenate(ids))
            places = places[_bounds(ids)].tolist()
            for k, text in enumerate(raw):
                if joined[places[k] : places[k + 1]].tobytes() != text:
                    raw[k] = b""
        none = np.zeros(0, dtype=np.int32)
        return [x if t else none for x, t in zip(a, raw)], [x if t else none for x, t in zip(b, raw)]


@cache
def tokenizers_of(ranks_path: str, pattern: str, model_path: str) -> Tokenizers:
    """One for each Python worker."""
    return Tokenizers(ranks_path, pattern, model_path)


def _side(ids: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, pd.DataFrame]:
    """Ids, ends and (start, doc, number) of one side's tokens; places run on over the documents."""
    flat = np.concatenate(ids).astype(np.int64)
    ends = np.cumsum(sizes[flat])
    doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    return flat, ends, pd.DataFrame({"start": ends - sizes[flat], "doc": doc, "number": np.arange(len(flat))})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (i, j) of all overlapping A and B tokens in order: each start finds the token of the
    other side that covers it, in both directions. ``number`` counts a side's tokens from 0."""
    into_b = pd.merge_asof(a, b, on="start", by="doc", suffixes=("_a", "_b"))
    i, j = into_b["number_a"].to_numpy(np.int64), into_b["number_b"].to_numpy(np.int64)
    # Tokens that start together have found each other; the B tokens left start inside an A token.
    inside = np.ones(len(b), dtype=bool)
    inside[j[b["start"].to_numpy()[j] == a["start"].to_numpy()]] = False
    into_a = pd.merge_asof(b[inside], a, on="start", by="doc", suffixes=("_b", "_a"))
    more = into_a["number_a"].to_numpy(np.int64) * len(b) + into_a["number_b"].to_numpy(np.int64)
    # Both are ascending, which a stable sort merges in one pass.
    pairs = np.sort(np.concatenate([i * len(b) + j, more]), kind="stable")
    return pairs // len(b), pairs % len(b)


def _links(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, size_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked pairs ``a * size_b + b`` of one document, ascending, and how many links each
    has. ``in_a`` and ``in_b`` are the tokens' groups, numbered from 0."""
    per_a, per_b = np.bincount(in_a), np.bincount(in_b)
    large = per_a * per_b > LARGE_GROUP
    usual = np.flatnonzero(~large[in_a])
    repeat = per_b[in_a[usual]]
    first_b = np.cumsum(per_b) - per_b
    place = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
    partner = b[np.repeat(first_b[in_a[usual]], repeat) + place]
    pairs, times = np.unique(np.repeat(a[usual], repeat) * size_b + partner, return_counts=True)
    if not large.any():
        return pairs, times
    parts, numbers = [pairs], [times]
    for group in np.flatnonzero(large):
        own_a, n_a = np.unique(a[in_a == group], return_counts=True)
        own_b, n_b = np.unique(b[in_b == group], return_counts=True)
        parts.append((own_a[:, None] * size_b + own_b).ravel())
        numbers.append((n_a[:, None] * n_b).ravel())
    pairs, which = np.unique(np.concatenate(parts), return_inverse=True)
    times = np.zeros(len(pairs), dtype=np.int64)
    np.add.at(times, which, np.concatenate(numbers))
    return pairs, times


def align(texts: list[str | None], tok: Tokenizers) -> list[tuple]:
    """For each text (n_a, n_b, n_groups, n_links, digest of the groups, pairs, times)."""
    a_ids, b_ids = tok.encode(texts)
    a, a_ends, a_frame = _side(a_ids, tok.a_sizes)
    b, b_ends, b_frame = _side(b_ids, tok.b_sizes)
    size_a, size_b = len(tok.a_bytes), len(tok.b_bytes)
    none = np.zeros(0, dtype=np.int64)
    if not len(a):
        return [(0, 0, 0, 0, "", none, none)] * len(texts)
    i, j = overlaps(a_frame, b_frame)
    closes = a_ends[i] == b_ends[j]
    group = np.cumsum(closes) - closes
    in_a, in_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
    in_a[i], in_b[j] = group, group
    per_a, per_b = np.bincount(in_a), np.bincount(in_b)
    # The groups as text: the A ids of a group, then its B ids.
    said = np.empty(len(a) + len(b), dtype=np.int64)
    last_a, last_b = np.append(in_a[1:] != in_a[:-1], True), np.append(in_b[1:] != in_b[:-1], True)
    said[np.arange(len(a)) + (np.cumsum(per_b) - per_b)[in_a]] = a + size_a * last_a
    said[np.arange(len(b)) + np.cumsum(per_a)[in_b]] = b + size_b * last_b + 2 * size_a
    joined, places = _joined(tok.said, said)

    found, bounds_a, bounds_b = [], _bounds(a_ids), _bounds(b_ids)
    places = places[bounds_a + bounds_b].tolist()
    bounds_a, bounds_b = bounds_a.tolist(), bounds_b.tolist()
    for k in range(len(texts)):
        own_a, own_b = slice(*bounds_a[k : k + 2]), slice(*bounds_b[k : k + 2])
        if own_a.start < own_a.stop:
            first, last = in_a[own_a.start], in_a[own_a.stop - 1] + 1
            digest = hashlib.sha256(joined[places[k] : places[k + 1] - 1]).hexdigest()
            pairs, times = _links(a[own_a], b[own_b], in_a[own_a] - first, in_b[own_b] - first, size_b)
            n_links = int((per_a[first:last] * per_b[first:last]).sum())
            found.append((len(a_ids[k]), len(b_ids[k]), int(last - first), n_links, digest, pairs, times))
        else:
            found.append((0, 0, 0, 0, "", none, none))
    return found


def _parts(sizes: list[int]) -> Iterator[slice]:
    """Stretches of a batch with ``BATCH_BYTES`` of text, or with one longer text at their end."""
    start, size = 0, 0
    for at, own in enumerate(sizes):
        size += own
        if size >= BATCH_BYTES:
            yield slice(start, at + 1)
            start, size = at + 1, 0
    if start < len(sizes):
        yield slice(start, len(sizes))


def _aligned(batches: Iterator[pa.RecordBatch], paths: tuple[str, str, str]) -> Iterator[pa.RecordBatch]:
    tok = tokenizers_of(*paths)
    size_b = len(tok.b_bytes)
    for batch in batches:
        # Only the part in work becomes Python strings.
        sizes = [size or 0 for size in pc.binary_length(batch.column("text")).to_pylist()]
        for part in _parts(sizes):
            rows = batch.slice(part.start, part.stop - part.start)
            found = align(rows.column("text").to_pylist(), tok)
            counts, digests, pairs, times = [x[:4] for x in found], [x[4] for x in found], [x[5] for x in found], [x[6] for x in found]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in pairs])]), pa.int32())
            flat = np.concatenate(pairs)
            lists = [flat // size_b, flat % size_b, np.concatenate(times)]
            kinds = [pa.int32(), pa.int32(), pa.int64()]
            yield pa.record_batch(
                [rows.column("doc_id").cast(pa.int64())]
                + [pa.array([x[k] for x in counts], pa.int64()) for k in range(4)]
                + [pa.array(digests, pa.string())]
                + [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in zip(lists, kinds)],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "times"],
            )


def aligned(docs: DataFrame, ranks_path: str, pattern: str, model_path: str) -> DataFrame:
    """One stored row per document: counts, the digest of its groups, and its distinct linked id
    pairs ``a[k], b[k]`` with ``times[k]`` links. ``row`` numbers the rows."""
    run = partial(_aligned, paths=(ranks_path, pattern, model_path))
    found = docs.select("doc_id", "text").mapInArrow(run, ALIGNED_SCHEMA)
    return stage(found.withColumn("row", F.monotonically_increasing_id()), "aligned")


def _exploded(found: DataFrame, *columns: str) -> DataFrame:
    pair = F.explode(F.arrays_zip("a", "b", "times"))
    return found.select(*columns, pair.alias("pair")).select(*columns, "pair.a", "pair.b", "pair.times")


def pair_counts(found: DataFrame) -> DataFrame:
    """(a, b, n, best): how many documents hold an id pair linked, and whether no other pair of its
    A id has more. A window holds the partners of one id, which the vocabulary bounds."""
    counts = _exploded(found).groupBy("a", "b").agg(F.count("*").alias("n"))
    most = F.max("n").over(Window.partitionBy("a"))
    return stage(counts.withColumn("best", F.col("n") == most), "pair-counts")


def _hot_bound(counts: DataFrame, most: int) -> int:
    """The least power of two so that at most ``most`` pairs have that count or more."""
    exponent = F.floor(F.log2("n")).cast("int").alias("exponent")
    rows = counts.groupBy(exponent).count().orderBy(F.desc("exponent")).collect()
    bound, total = 2 ** (rows[0]["exponent"] + 1) if rows else 1, 0
    for exponent, n in rows:
        total += n
        if total > most:
            break
        bound = 2**exponent
    return bound


def _sums(pairs: DataFrame) -> DataFrame:
    def total(value: Column, name: str) -> Column:
        return F.sum(F.col("times") * value).alias(name)

    return pairs.groupBy("row").agg(total(F.col("n"), "count_sum"), total(F.col("best").cast("bigint"), "n_best"))


def alignment_report(docs: DataFrame, ranks_path: str, pattern: str, model_path: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document:
    tokens, groups and links, the links whose pair is the most frequent of its A id, and the sum of
    the links' document counts."""
    found = aligned(docs, ranks_path, pattern, model_path)
    counts = pair_counts(found)
    bound = _hot_bound(counts, hot_pairs)
    hot = F.broadcast(counts.where(F.col("n") >= bound))
    pairs = _exploded(found, "row")
    frequent = _sums(pairs.join(hot, ["a", "b"]))
    others = pairs.join(hot.select("a", "b"), ["a", "b"], "left_anti")
    rare = _sums(others.join(counts.where(F.col("n") < bound), ["a", "b"]))
    # Both parts have a row per document at most.
    sums = frequent.unionByName(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return found.drop("a", "b", "times").join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
