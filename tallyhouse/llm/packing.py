"""Packing of tokenised documents into sequences by minimum bin slack.

Documents become ids of a given tokenizer and an end id; longer ones than a sequence are cut. Pieces
are dealt into groups of bounded size, and each group is packed on its own: per sequence the longest
piece left is put in, then a subset-sum over the lengths still available, kept as the bits of one
number, finds the fullest feasible combination, which is removed. Exact fills stop the search early.

A group leaves about one sequence that is not full, so packing in groups costs about one sequence in
``PIECES_PER_GROUP`` pieces. A group's rows are its pieces' lengths and places, never texts or ids.

The tokenizer splits at white space and looks at nothing beyond it, and words of characters below
U+0100, which its normal form leaves alone, it cuts into runs of letters, digits and runs of marks. So the
ids of a text are the ids of these parts one after another; ids of parts are remembered. New runs of
letters go through the tokenizer's merges alone, new parts of other kinds and words with other
characters through all of it. A text with the separators
U+001C to U+001F, which Python takes for white space and the tokenizer does not, or with a special
token goes to the tokenizer whole.

Defined results: null and empty texts are one piece with the end id only; rows without ``doc_id``
and repeated rows are packed like any other; an empty table gives no piece. Other columns of the
input are neither read nor required.
"""

from __future__ import annotations

import codecs
import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, partial
from itertools import islice
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.storage import stage

SEQUENCE = 4096
END_ID = 1
PIECES_PER_GROUP = 8192
REMEMBERED_WORDS = 150_000

_OTHER_SPACE = "\x1c\x1d\x1e\x1f"
# The parts into which the tokenizer cuts lower-case text of the characters below U+0100.
_LETTER, _DIGIT = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
# The most frequent kind comes first; no other kind begins like it.
_PART = re.compile(rf"[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)|[^\s{_LETTER}{_DIGIT}]+|[{_DIGIT}]")
_WORD = re.compile(f"[{_LETTER}]+")
_BEYOND = re.compile("[^\x00-\xff]")

PIECE_SCHEMA = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"
PLACED_SCHEMA = PIECE_SCHEMA + ", sequence_id BIGINT, offset BIGINT"


class Ids:
    """Ids of whole texts as little-endian 32-bit numbers."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        # The character that stands for each byte of letters below U+0100.
        shown = list(map(chr, range(256)))
        for letter in map(chr, range(0x80, 0x100)):
            for byte, character in zip(letter.encode(), byte_level.pre_tokenize_str(letter)[0][0]):
                shown[byte] = character
        self.shown = "".join(shown)
        added = {x.content.lower() for x in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = re.compile("|".join(map(re.escape, sorted(added))) or "(?!)", re.IGNORECASE)
        # A word that is asked for takes the next place; the ids of the words by place.
        self.words: defaultdict[str, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.ids: list[bytes] = []

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return list(map(self._ids, found))

    @staticmethod
    def _ids(found: Any) -> bytes:
        return array("I", found.ids).tobytes()

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters below U+0100."""
        merged, shown = self.tokenizer.model.tokenize, self.shown
        return [
            array("I", [token.id for token in merged(codecs.charmap_decode(word.encode(), "strict", shown)[0])]).tobytes()
            for word in words
        ]

    def _split(self, text: str) -> list[str] | None:
        """Parts whose ids make up the text's; None if it must be encoded as a whole."""
        if any(map(text.__contains__, _OTHER_SPACE)) or ("<" in text and self.added.search(text)):
            return None
        if text.isascii() or not _BEYOND.search(text):
            return _PART.findall(text.lower())
        return [p for w in text.split() for p in ((w,) if _BEYOND.search(w) else _PART.findall(w.lower()))]

    def _remember(self, new: list[str]) -> None:
        """Ids of the words in the last places."""
        letters = list(filter(_WORD.fullmatch, new))
        found = dict(zip(letters, self._encode_letters(letters)))
        others = [word for word in new if word not in found]
        found.update(zip(others, self._encode(others)))
        self.ids += map(found.__getitem__, new)

    def of(self, texts: list[str]) -> list[bytes]:
        known = self.words
        if len(known) > REMEMBERED_WORDS:
            known.clear()
            self.ids.clear()
        place = known.__getitem__
        places: list[list[int] | None] = []
        for text in texts:
            parts = self._split(text)
            places.append(None if parts is None else list(map(place, parts)))
        self._remember(list(islice(reversed(known), len(known) - len(self.ids)))[::-1])
        ids = self.ids.__getitem__
        return [
            self._encode([text])[0] if of_text is None else b"".join(map(ids, of_text))
            for text, of_text in zip(texts, places)
        ]


@cache
def ids_of(path: str) -> Ids:
    """One for each Python worker, which keeps what it remembers from task to task."""
    return Ids(path)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, sequence: int, end_id: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder, end = ids_of(path), np.array([end_id], dtype="<u4").tobytes()
    for whole in batches:
        for at in range(0, whole.num_rows, 768):
            batch = whole.slice(at, 768)
            columns: list[list] = [[], [], [], [], [], []]
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.of(texts)):
                ids += end
                for piece, start in enumerate(range(0, len(ids) // 4, sequence)):
                    part = ids[4 * start : 4 * (start + sequence)]
                    row = (doc_id, piece, start, len(part) // 4, zlib.crc32(part), part)
                    for column, value in zip(columns, row):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<i4") for x in columns[5]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(arrays, names=names)


def pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of each document; with ``ids`` if asked for."""
    schema = PIECE_SCHEMA + ", ids ARRAY<INT>" * with_ids
    run = partial(_pieces, path=tokenizer, sequence=sequence, end_id=end_id, with_ids=with_ids)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def fullest(available: list[int], room: int, mask: int) -> list[int]:
    """Lengths, longest first, of a combination of the available ones with the greatest sum up to
    ``room``. Bit ``s`` of a number says whether sum ``s`` can be reached."""
    reach, steps = 1, []
    goal = 1 << room
    for length in range(min(room, len(available) - 1), 0, -1):
        for _ in range(min(available[length], room // length)):
            wider = (reach | reach << length) & mask
            if wider == reach:
                break
            steps.append((length, reach))
            reach = wider
        if reach & goal:
            break
    left, chosen = (reach & ((goal << 1) - 1)).bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> left & 1:
            chosen.append(length)
            left -= length
    return chosen


def pack(lengths: np.ndarray, sequence: int) -> list[list[int]]:
    """Sequences as lists of positions in ``lengths``, each of which is used once."""
    order = np.argsort(-lengths, kind="stable")
    waiting: dict[int, list[int]] = {}
    for i in order[::-1]:
        waiting.setdefault(int(lengths[i]), []).append(int(i))
    available = [0] * (sequence + 1)
    for length, items in waiting.items():
        available[length] = len(items)
    packed = []
    for longest in sorted(waiting, reverse=True):
        while available[longest]:
            room = sequence - longest
            available[longest] -= 1
            chosen = [longest]
            if room:
                for length in fullest(available, room, (1 << room + 1) - 1):
                    available[length] -= 1
                    chosen.append(length)
            packed.append([waiting[length].pop() for length in chosen])
    return packed


def _pack_group(key: tuple[pa.Scalar, ...], table: pa.Table, sequence: int) -> pa.Table:
    table = table.drop_columns(["group_"]).sort_by(
        [(n, "ascending") for n in ("length", "doc_id", "piece", "ids_crc32")]
    )
    lengths = table.column("length").to_numpy()
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k, items in enumerate(pack(lengths, sequence)):
        number[items] = (key[0].as_py() << 32) + k
        offset[items] = np.cumsum(lengths[items]) - lengths[items]
    return table.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))


def place(stored: DataFrame, sequence: int = SEQUENCE, pieces_per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces (without ids). The groups number as many
    as the pieces ask for, and are dealt by a hash of all of a piece, so no key gathers in one."""
    groups = max(1, -(-stored.count() // pieces_per_group))
    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups))

    def packed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _pack_group(key, table, sequence)

    return stored.withColumn("group_", group).groupBy("group_").applyInArrow(packed, PLACED_SCHEMA)


def pack_documents(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    return place(stage(pieces(docs, tokenizer, sequence, end_id), "pieces"), sequence)


def sequences(docs: DataFrame, placed: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """(sequence_id, ids, doc_ids) of every sequence: the ids of its pieces in order of offset. Needs
    distinct, non-null ``doc_id``, as pieces are found again by it."""
    parts = pieces(docs, tokenizer, sequence, end_id, with_ids=True).select("doc_id", "piece", "ids")
    rows = placed.select("doc_id", "piece", "sequence_id", "offset").join(parts, ["doc_id", "piece"])
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return rows.groupBy("sequence_id").agg(ordered.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids")
    )
