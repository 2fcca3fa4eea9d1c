"""Tokens of documents, packed into sequences of bounded length by best-two-fit."""

from __future__ import annotations

import base64
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType
from tokenizers import Tokenizer

from martlight.session import materialize

SEQUENCE_TOKENS = 2048
END_ID = 0
# Pieces one packing task holds, about 50 bytes each.
GROUP_PIECES = 200_000
# Words a task's encoder remembers, about 200 bytes each.
_CACHE_WORDS = 300_000
# Bytes of ids a task hands over at once; the JVM holds them outside its heap.
_BATCH_BYTES = 1 << 22

_MIXED_SPACE = re.compile(r" \s|\s ")
# The fast library's patterns run out of stack on far longer runs of white space.
_LONG_SPACE = 10_000
_MUCH_SPACE = re.compile(rf"\s{{{_LONG_SPACE}}}")


class Encoder:
    """Ids of a byte-level BPE vocabulary, as little-endian unsigned 32-bit bytes.

    The ``.tiktoken`` file holds the vocabulary of the ``.json`` of the same name, so ids are
    those of both libraries. A single space
    between two other characters always starts a token of its own, so words are encoded apart
    and remembered; texts with other space next to a space are encoded whole.
    """

    def __init__(self, vocabulary: str):
        self._json = public_tokenizers.path(vocabulary.replace(".tiktoken", ".json"))
        with open(self._json, encoding="utf-8") as file:
            self._added = [t["content"] for t in json.load(file).get("added_tokens") or []]
        self._tokenizer: Tokenizer | None = None
        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._whole = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._known: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return np.array(self._whole.encode_ordinary(text), dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        ids = self._encode(" " + word)
        if len(self._known) < _CACHE_WORDS and len(word) < 64:
            self._known[word] = ids
        return ids

    def document_ids(self, text: str) -> bytes:
        """The ids that ``tokenizers`` gives with add_special_tokens=False: an added token in the text is one id.

        Texts with added tokens or with very long white space are encoded by that library itself.
        """
        if not any(t in text for t in self._added) and not (len(text) >= _LONG_SPACE and _MUCH_SPACE.search(text)):
            return self.ids(text)
        if self._tokenizer is None:
            self._tokenizer = Tokenizer.from_file(self._json)
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """The ids of a text in which strings of added tokens are ordinary text."""
        if text[:1] == " " or text[-1:] == " " or _MIXED_SPACE.search(text):
            return self._encode(text)
        first, *rest = text.split(" ")
        known, word = self._known.get, self._word
        return b"".join([self._encode(first), *[known(w) or word(w) for w in rest]])


_encoders: dict[str, Encoder] = {}


def _encoder(vocabulary: str) -> Encoder:
    """One encoder for all tasks of a worker process."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def token_pieces(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str = "byte_bpe_50k.tiktoken",
    longest: int = SEQUENCE_TOKENS,
) -> DataFrame:
    """(key, piece, start, length, ids): the tokens of each document, an end token after the text.

    ids is binary, four little-endian bytes a token. Only a document of more than ``longest``
    tokens is cut; all its pieces but the first are ``longest`` tokens long. A null text is
    empty, so each row, repeated or not, has at least one piece.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = StructType(
        [
            StructField("key", rows.schema["key"].dataType),
            StructField("piece", IntegerType()),
            StructField("start", LongType()),
            StructField("length", LongType()),
            StructField("ids", BinaryType()),
        ]
    )
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            keys = batch.column("key")
            found, held = [], 0

            def flush():
                row, *columns = zip(*found)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(c, type=k) for c, k in zip(columns, kinds)]
                return pa.RecordBatch.from_arrays([keys.take(pa.array(row)), *arrays], names=schema.names)

            for row, value in enumerate(batch.column("text")):
                ids = encoder.document_ids(value.as_py() or "") + end
                total = len(ids) // 4
                stops = range(total % longest or longest, total + 1, longest) if total > longest else (total,)
                start = 0
                for piece, stop in enumerate(stops):
                    found.append((row, piece, start, stop - start, ids[4 * start : 4 * stop]))
                    start = stop
                held += len(ids)
                if held >= _BATCH_BYTES:
                    yield flush()
                    found, held = [], 0
            if found:
                yield flush()

    return rows.mapInArrow(cut, schema).withColumnRenamed("key", key)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item, in as few bins as best-two-fit finds.

    A bin takes the largest item that fits, again and again. Then its smallest item gives
    way to the two unpacked items that together fill its place and the gap best, if they
    leave less of it open. Equal lengths are interchangeable, so only counts are searched.
    """
    order = np.argsort(lengths, kind="stable")
    values, first, counts = np.unique(lengths[order], return_index=True, return_counts=True)
    left = np.zeros(capacity + 1, dtype=np.int64)
    left[values] = counts
    upto = np.zeros(capacity + 1, dtype=np.int64)  # the next unpacked item of each length is order[upto - 1]
    upto[values] = first + counts
    sizes = values.tolist()  # lengths with unpacked items
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    below = np.empty(0, dtype=np.int64)  # the largest length with unpacked items up to each length
    stale = True

    def take(size: int) -> None:
        nonlocal stale
        left[size] -= 1
        if not left[size]:
            sizes.pop(bisect_right(sizes, size) - 1)
            stale = True

    def give_back(size: int) -> None:
        nonlocal stale
        if not left[size]:
            sizes.insert(bisect_right(sizes, size), size)
            stale = True
        left[size] += 1

    number = 0
    while sizes:
        packed, room = [], capacity
        while room and (at := bisect_right(sizes, room)):
            size = sizes[at - 1]
            take(size)
            packed.append(size)
            room -= size
        if room and len(packed) > 1 and sizes:
            place = packed[-1] + room
            if stale:
                below = np.maximum.accumulate(np.where(left > 0, np.arange(capacity + 1), 0))
                stale = False
            small = np.array(sizes[: bisect_right(sizes, place // 2)], dtype=np.int64)
            if len(small):
                large = below[place - small]
                alone = (large == small) & (left[small] < 2)
                large = np.where(alone, below[small - 1], large)
                sums = np.where(large > 0, small + large, 0)
                best = int(sums.argmax())
                if sums[best] > packed[-1]:
                    give_back(packed.pop())
                    for size in (int(large[best]), int(small[best])):
                        take(size)
                        packed.append(size)
        offset = 0
        for size in packed:
            upto[size] -= 1
            item = order[upto[size]]
            bins[item], offsets[item] = number, offset
            offset += size
        number += 1
    return bins, offsets


def pack_pieces(
    pieces: DataFrame,
    order: list[str],
    length: str = "length",
    capacity: int = SEQUENCE_TOKENS,
    group: int = GROUP_PIECES,
) -> DataFrame:
    """Add sequence_id and offset to rows of ``length`` 1 to ``capacity``; other columns ride along.

    Rows are dealt evenly, whatever their values, to as many tasks as keep a task near
    ``group`` rows; each task packs its own, so all but its last few sequences are full. Sorted
    by ``length`` and ``order`` first, a task that runs again packs alike. ``pieces`` is read
    twice, to count and to pack: hand in stored rows.
    """
    tasks = max(1, -(-pieces.count() // group))
    schema = StructType(
        [*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        table = table.sort_by([(c, "ascending") for c in [length, *order]])
        bins, offsets = best_two_fit(table.column(length).to_numpy(), capacity)
        number = pa.array(bins + (TaskContext.get().partitionId() << 40))
        for name, values in (("sequence_id", number), ("offset", pa.array(offsets))):
            table = table.append_column(name, values)
        yield from table.to_batches(max_chunksize=10_000)

    return pieces.repartition(tasks).mapInArrow(pack, schema)


def packed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) of every piece, with ``ids`` on demand.

    Pieces are stored before they are packed, so texts are encoded once.
    """
    pieces = token_pieces(docs, key, text).withColumn("ids_crc32", F.crc32("ids"))
    pieces = materialize(pieces if with_ids else pieces.drop("ids"), "pieces")
    return pack_pieces(pieces, [key, "piece", "ids_crc32"])
