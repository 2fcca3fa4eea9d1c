"""Periodic runs of words, found by catchers over power-of-two blocks of a growing text."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

MIN_LENGTH = 6
MIN_EXPONENT = 4

# Words appended at once, and words of short texts that share one stream.
_APPEND = 1 << 16
_STREAM_WORDS = 1 << 18
_TEXT_BYTES = 1 << 24

_RUNS = ArrayType(
    StructType([StructField(n, LongType(), False) for n in ("start", "length", "period")]), containsNull=False
)
_NONE = np.empty(0, dtype=np.int64)


def _named(left: np.ndarray, right: np.ndarray | int) -> np.ndarray:
    """64-bit names of pairs of names; equal pairs have equal names."""
    x = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + np.uint64(0x632BE59BD9B4E019))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class _Level:
    """The catchers of all completed blocks of 2 ** k words.

    The catcher of the block at l waits for the block's words to come again at a distance
    q from 2 ** k to 2 ** (k + 1) - 1. Names of windows are kept as far back as a catcher or the next
    level reads.
    """

    def __init__(self, k: int):
        self.k, self.size = k, 1 << k
        self.first = 0  # window start that names[0] stands for
        self.names = np.empty(0, dtype=np.uint64)
        self.caught: list[np.ndarray] = []

    @property
    def end(self) -> int:
        return self.first + len(self.names)

    def advance(self, new: np.ndarray) -> None:
        """Compare each window that the last words completed with the block its catcher holds."""
        at = np.arange(self.end, self.end + len(new))
        self.names = np.concatenate((self.names, new))
        block = ((at >> self.k) << self.k) - self.size
        own = np.flatnonzero(block >= 0)
        if len(own):
            same = self.names[block[own] - self.first] == new[own]
            if same.any():
                self.caught.append(at[own[same]])

    def forget(self) -> None:
        drop = len(self.names) - 2 * self.size
        if drop > 0:
            self.names, self.first = self.names[drop:], self.first + drop


class SquareCatchers:
    """Squares of a growing sequence of numbers, merged into its runs on demand.

    After each append, every window of 2 ** k numbers that the new ones complete is compared
    with one earlier block of that size; where both are equal, block and window are two ends of
    a square's period. A run of exponent 4 or more holds two neighbouring blocks that catch its period,
    so only such pairs are looked at. ``longest`` bounds the length of runs.
    """

    def __init__(self, longest: int, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT):
        if min_exponent < 4:
            raise ValueError("runs of an exponent below 4 may hold no two blocks that catch their period")
        self.min_length, self.min_exponent = min_length, min_exponent
        self.numbers = _NONE
        self._levels = [_Level(k) for k in range(max(longest // min_exponent, 0).bit_length())]

    def append(self, numbers: np.ndarray) -> None:
        self.numbers = np.concatenate((self.numbers, numbers)) if len(self.numbers) else numbers
        for level in self._levels:
            if level.k == 0:
                level.advance(_named(numbers.astype(np.uint64), 0))
            else:
                low, half = self._levels[level.k - 1], level.size // 2
                start, stop = level.end - low.first, len(low.names) - half
                if stop > start:
                    level.advance(_named(low.names[start:stop], low.names[start + half : stop + half]))
        for level in self._levels:
            level.forget()

    def _stretches(self, first: int, last: int, period: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal stretches of a period, long enough, in a part of the numbers."""
        part = self.numbers[first:last]
        edge = np.diff((part[period:] == part[:-period]).view(np.int8), prepend=0, append=0)
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + period
        long = stops - starts >= max(self.min_length, self.min_exponent * period)
        return starts[long] + first, stops[long] + first

    def runs(self, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, stop, period) of every run, ordered; each is inside one part between two ``bounds``."""
        starts, stops, periods = _NONE, _NONE, _NONE
        for level in self._levels:
            if not level.caught:
                continue
            at = np.concatenate(level.caught)
            at = at[np.isin(at + level.size, at, assume_unique=True)]
            block = ((at >> level.k) << level.k) - level.size
            if len(starts):
                # Squares inside a run of a smaller period tell nothing new: theirs is a multiple of it.
                furthest = np.maximum.accumulate(stops)
                before = np.searchsorted(starts, block, side="right") - 1
                inside = (before >= 0) & (furthest[before] >= at + 2 * level.size)
                at, block = at[~inside], block[~inside]
            if not len(at):
                continue
            owner = np.searchsorted(bounds, block, side="right") - 1
            asked = np.unique(np.stack((owner, at - block)), axis=1)
            found = [
                (s, e, np.full(len(s), q))
                for o, q in asked.T.tolist()
                for s, e in [self._stretches(bounds[o], bounds[o + 1], q)]
            ]
            more = [np.concatenate(c) for c in zip(*found)]
            starts, stops, periods = (np.concatenate(c) for c in zip((starts, stops, periods), more))
            # The same stretch may have come with a multiple of its smallest period.
            order = np.lexsort((periods, stops, starts))
            starts, stops, periods = starts[order], stops[order], periods[order]
            new = np.ones(len(starts), dtype=bool)
            new[1:] = (np.diff(starts) != 0) | (np.diff(stops) != 0)
            starts, stops, periods = starts[new], stops[new], periods[new]
        order = np.lexsort((periods, starts))
        return starts[order], stops[order], periods[order]


def _numbered(words: list[bytes], base: int) -> tuple[np.ndarray, int]:
    """Numbers from ``base`` on for the words of one text, equal words alike; the next free number."""
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = lambda: len(known) + base
    numbers = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
    return numbers, base + len(known)


def runs_of(
    texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(start, length, period) of the runs of each list of words, by start, then period.

    The texts follow each other in one stream, each with numbers of its own and a number that never
    comes again at its end, so no square reaches from one into the next.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
    catchers = SquareCatchers(int(sizes.max(initial=0)), min_length, min_exponent)
    next_number, held, count = 0, [], 0
    for words in texts:
        numbers, next_number = _numbered(words, next_number)
        held += [numbers, np.array([next_number])]
        next_number += 1
        count += len(words) + 1
        if count >= _APPEND:
            whole = np.concatenate(held)
            for at in range(0, count, _APPEND):
                catchers.append(whole[at : at + _APPEND])
            held, count = [], 0
    if count:
        catchers.append(np.concatenate(held))
    starts, stops, periods = catchers.runs(bounds)
    cut = np.searchsorted(starts, bounds)
    return [
        (starts[a:b] - first, stops[a:b] - starts[a:b], periods[a:b])
        for a, b, first in zip(cut[:-1], cut[1:], bounds.tolist())
    ]


def _collapsed(words: list[bytes], runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> str:
    starts, lengths, periods = runs
    if not len(starts):
        return b" ".join(words).decode()
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, starts + periods, 1)
    np.add.at(edge, starts + lengths, -1)
    kept = np.cumsum(edge[:-1]) == 0
    return b" ".join([w for w, k in zip(words, kept.tolist()) if k]).decode()


def find_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, runs (start, length, period), collapsed.

    A run is a stretch of words in which words a smallest period apart are equal, of ``min_length``
    words and ``min_exponent`` (4 or more) periods at least, that no neighbouring word
    prolongs. runs lists all of them by start, then period. collapsed is the text, single-spaced, without
    the words that some run has after its first period. Words are what ASCII white space leaves,
    compared as they are. A null or empty text has no words and collapses to "". Rows are
    judged one by one: null and repeated keys, repeated rows and ties change nothing; other columns are left out.

    Texts are never shuffled. A worker holds a stream of a bounded number of words, or one longer text.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = StructType(
        [
            StructField("key", rows.schema["key"].dataType),
            StructField("n_words", LongType()),
            StructField("runs", _RUNS),
            StructField("collapsed", StringType()),
        ]
    )
    kind = pa.list_(pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column("key"), batch.column("text")
            first, held, size, held_bytes = 0, [], 0, 0

            def flush(stop: int) -> pa.RecordBatch:
                found = runs_of(held, min_length, min_exponent)
                counts = np.concatenate(([0], np.cumsum([len(f[0]) for f in found]))).astype(np.int32)
                columns = [pa.array(np.concatenate([f[c] for f in found]).astype(np.int64)) for c in range(3)]
                runs = pa.ListArray.from_arrays(
                    pa.array(counts), pa.StructArray.from_arrays(columns, fields=list(kind.value_type))
                )
                collapsed = pa.array([_collapsed(w, f) for w, f in zip(held, found)], pa.string())
                arrays = [keys.slice(first, stop - first), pa.array([len(w) for w in held], pa.int64()), runs, collapsed]
                return pa.RecordBatch.from_arrays(arrays, names=schema.names)

            for row in range(batch.num_rows):
                value = (texts[row].as_py() or "").encode()
                held.append(value.split())
                size += len(held[-1]) + 1
                held_bytes += len(value)
                if size >= _STREAM_WORDS or held_bytes >= _TEXT_BYTES:
                    yield flush(row + 1)
                    first, held, size, held_bytes = row + 1, [], 0, 0
            if held:
                yield flush(batch.num_rows)

    return rows.mapInArrow(scan, schema).withColumnRenamed("key", key)
