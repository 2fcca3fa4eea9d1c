"""Benchmark passages in documents, found with one FM-index per shard of text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.llm.columns import fresh

WINDOW_WORDS = 10
# Words of text one index covers.
SHARD_WORDS = 1 << 20
# Words of benchmark text that one broadcast block holds.
BLOCK_WORDS = 1 << 21
# Every so many positions the index keeps a suffix position.
_SAMPLE = 32
# Longest stretch indexed in one piece; bounds the rounds of suffix sorting.
_STRETCH = 512
# Occurrences located at once.
_LOCATE = 1 << 20

# Words are ASCII letters, lower-cased, digits, and whatever is not ASCII; the rest is space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def word_list(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class WaveletMatrix:
    """Rank of symbols in a sequence: one bit vector a level, counted in 64-bit words."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self._levels = []
        rest = symbols
        for level in range(bits - 1, -1, -1):
            ones = ((rest >> level) & 1).astype(bool)
            packed = np.zeros((len(rest) // 64 + 1) * 8, dtype=np.uint8)
            raw = np.packbits(ones, bitorder="little")
            packed[: len(raw)] = raw
            words = packed.view("<u8")
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]))
            self._levels.append((level, words, before, len(rest) - int(ones.sum())))
            rest = np.concatenate((rest[~ones], rest[ones]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before position ``at``."""
        start = np.zeros_like(at)
        for level, words, before, zeros in self._levels:
            one = ((symbol >> level) & 1).astype(bool)

            def ones(i: np.ndarray) -> np.ndarray:
                mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
                return before[i >> 6] + np.bitwise_count(words[i >> 6] & mask).astype(np.int64)

            r, s = ones(at), ones(start)
            at, start = np.where(one, zeros + r, at - r), np.where(one, zeros + s, start - s)
        return at - start


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions by suffix; zeros end stretches, and sort by their position before all else."""
    n = len(symbols)
    ends = symbols == 0
    rank = np.where(ends, np.cumsum(ends) - 1, symbols.astype(np.int64) + n)
    rank = np.unique(rank, return_inverse=True)[1]
    step = 1
    while True:
        following = np.full(n, 0, dtype=np.int64)
        following[:-step] = rank[step:] + 1
        pair = rank * (n + 1) + following
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if rank[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Counts and locates phrases in stretches of words (1 and up), a zero after each stretch."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self._n = len(symbols)
        order = suffix_array(symbols)
        self._last = symbols[order - 1]
        self._ranks = WaveletMatrix(self._last, bits)
        counts = np.bincount(symbols, minlength=(1 << bits) + 1)
        self._first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        opens = np.concatenate(([True], symbols[:-1] == 0))
        # A walk never passes a stretch's first word: its position is always kept.
        kept = opens | (np.arange(self._n) % _SAMPLE == 0)
        self._rows = np.flatnonzero(kept[order])
        self._positions = order[self._rows]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range [low, high) of each phrase of a matrix, by extending it backwards."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self._n, dtype=np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            low[alive] = self._first[symbol] + self._ranks.rank(symbol, low[alive])
            high[alive] = self._first[symbol] + self._ranks.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: walk to the words before until one has its position kept."""
        found = np.empty(len(rows), dtype=np.int64)
        walking, at, steps = np.arange(len(rows)), rows, 0
        while len(walking):
            slot = np.searchsorted(self._rows, at)
            kept = (slot < len(self._rows)) & (self._rows[np.minimum(slot, len(self._rows) - 1)] == at)
            found[walking[kept]] = self._positions[slot[kept]] + steps
            walking, at = walking[~kept], at[~kept]
            symbol = self._last[at]
            at = self._first[symbol] + self._ranks.rank(symbol, at)
            steps += 1
        return found


@dataclass
class Phrases:
    """A block of benchmark items: their words, their distinct windows, and who has each window."""

    vocabulary: dict[bytes, int]
    windows: list[np.ndarray]  # a matrix of word ids for each window length
    owners: list[list[list[str]]]  # item names of each window


def phrase_block(items: list[tuple[str | None, list[bytes]]], window: int) -> Phrases:
    """Windows of the items; an item of fewer words than a window is one window, of none has none."""
    vocabulary: dict[bytes, int] = {}
    found: dict[int, dict[tuple, dict]] = {}
    for name, words in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
        width = min(window, len(ids))
        for at in range(len(ids) - width + 1 if ids else 0):
            owners = found.setdefault(width, {}).setdefault(tuple(ids[at : at + width]), {})
            if name is not None:
                owners[name] = None
    return Phrases(
        vocabulary,
        [np.array(list(group), dtype=np.int64) for group in found.values()],
        [[list(owners) for owners in group.values()] for group in found.values()],
    )


def _stretches(ids: np.ndarray, shortest: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of benchmark words long enough to hold a phrase, a zero after each, and where each word was."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids > 0).astype(np.int8), [0]))))
    starts, stops = edges[::2], edges[1::2]
    long = stops - starts >= shortest
    symbols, places = [], []
    for start, stop in zip(starts[long].tolist(), stops[long].tolist()):
        while True:
            cut = min(stop, start + _STRETCH)
            symbols += [ids[start:cut], [0]]
            places += [np.arange(start, cut), [-1]]
            if cut == stop:
                break
            start = cut - overlap
    if not symbols:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(symbols).astype(np.int64), np.concatenate(places).astype(np.int64)


def _search_shard(texts: list[list[bytes]], phrases: Phrases) -> list[tuple[int, list[int], list[int], list[str]]]:
    """(words, span starts, span ends, items) of each text of a shard."""
    counts = np.array([len(t) for t in texts], dtype=np.int64)
    begins = np.concatenate(([0], np.cumsum(counts + 1)))  # a gap after each text keeps texts apart
    ids = np.zeros(begins[-1], dtype=np.int64)
    known = phrases.vocabulary.get
    for text, begin, count in zip(texts, begins.tolist(), counts.tolist()):
        ids[begin : begin + count] = np.fromiter(map(known, text, repeat(0)), dtype=np.int64, count=count)
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    items: dict[int, set] = {}
    widths = [m.shape[1] for m in phrases.windows]
    symbols, places = _stretches(ids, min(widths, default=1), max(widths, default=1) - 1)
    if len(symbols) and widths:
        index = FMIndex(symbols, len(phrases.vocabulary).bit_length())
        for matrix, owners, width in zip(phrases.windows, phrases.owners, widths):
            low, high = index.search(matrix)
            hits = high - low
            upto = np.cumsum(hits)
            for at in range(0, int(upto[-1]), _LOCATE):
                number = np.arange(at, min(at + _LOCATE, int(upto[-1])))
                phrase = np.searchsorted(upto, number, side="right")
                rows = low[phrase] + number - (upto[phrase] - hits[phrase])
                where = places[index.locate(rows)]
                np.add.at(edge, where, 1)
                np.add.at(edge, where + width, -1)
                text = np.searchsorted(begins, where, side="right") - 1
                for t, p in np.unique(np.stack((text, phrase), axis=1), axis=0).tolist():
                    items.setdefault(t, set()).update(owners[p])
    covered = np.cumsum(edge[:-1]) > 0
    change = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False]))))
    starts, stops = change[::2], change[1::2]
    owner = np.searchsorted(begins, starts, side="right") - 1
    spans: dict[int, tuple[list, list]] = {}
    for t, start, stop in zip(owner.tolist(), starts.tolist(), stops.tolist()):
        begin = int(begins[t])
        own = spans.setdefault(t, ([], []))
        own[0].append(start - begin)
        own[1].append(stop - begin)
    return [
        (n, *spans.get(t, ([], [])), sorted(items.get(t, ())))
        for t, n in enumerate(counts.tolist())
    ]


_FOUND = "n_words long, starts array<int>, ends array<int>, items array<string>"


def _searcher(block):
    @F.pandas_udf(_FOUND)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        phrases = block.value
        for texts in batches:
            rows, shard, held = [], [], 0
            for text in texts:
                shard.append(word_list(text))
                held += len(shard[-1])
                if held >= SHARD_WORDS:
                    rows += _search_shard(shard, phrases)
                    shard, held = [], 0
            rows += _search_shard(shard, phrases) if shard else []
            yield pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items"])

    # A filter on the result must not make the optimizer search twice.
    return search.asNondeterministic()


def _blocks(benchmark: DataFrame, item: str, text: str, window: int, block_words: int) -> Iterator[Phrases]:
    """The benchmark in blocks of bounded size, each read from one partition after another."""
    held, size = [], 0
    for row in benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        words = word_list(row.t)
        held.append((row.i, words))
        size += len(words)
        if size >= block_words:
            yield phrase_block(held, window)
            held, size = [], 0
    if held:
        yield phrase_block(held, window)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
    block_words: int = BLOCK_WORDS,
    column: str = "passages",
) -> DataFrame:
    """Add ``column`` (n_words, starts, ends, items) to each document.

    starts and ends are word positions of merged spans (end exclusive) that benchmark windows
    cover, items the sorted names of the items whose windows occur. Each task cuts its texts
    into shards and indexes a shard's stretches of benchmark words: no window can reach over
    another word. Nothing is shuffled. The benchmark goes out in broadcast blocks of
    bounded size; each further block is one more index over the same texts.
    A null text has no words; an item without words has no window; an item without a name
    marks words and is not listed; items of one name count once. Without items nothing is hit.
    """
    sc = docs.sparkSession.sparkContext
    found = [
        _searcher(sc.broadcast(block))(F.col(text))
        for block in _blocks(benchmark, item, item_text, window, block_words)
    ] or [_searcher(sc.broadcast(phrase_block([], window)))(F.col(text))]
    if len(found) == 1:
        return docs.withColumn(column, found[0])
    names = [fresh(docs, f"{column}_{i}") for i in range(len(found))]
    merged_spans = fresh(docs, f"{column}_merged")
    rows = docs.withColumns(dict(zip(names, found)))
    spans = F.sort_array(F.concat(*[F.arrays_zip(F.col(n)["starts"], F.col(n)["ends"]) for n in names]))
    # Overlapping spans of different blocks become one.
    merged = F.aggregate(
        spans,
        F.expr("cast(array() as array<struct<s: int, e: int>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["e"] >= x["starts"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.get(done, F.size(done) - 1)["s"].alias("s"),
                        F.greatest(F.get(done, F.size(done) - 1)["e"], x["ends"]).alias("e"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(x["starts"].alias("s"), x["ends"].alias("e"))))),
    )
    return rows.withColumn(merged_spans, merged).withColumn(
        column,
        F.struct(
            F.col(names[0])["n_words"].alias("n_words"),
            F.col(merged_spans)["s"].alias("starts"),
            F.col(merged_spans)["e"].alias("ends"),
            F.sort_array(F.array_distinct(F.concat(*[F.col(n)["items"] for n in names]))).alias("items"),
        ),
    ).drop(merged_spans, *names)


def hit_words(passages: Column) -> Column:
    """Number of words inside the spans."""
    widths = F.zip_with(passages["starts"], passages["ends"], lambda s, e: (e - s).cast("long"))
    return F.aggregate(widths, F.lit(0).cast("long"), lambda total, w: total + w)


def cut_text(text: str, starts: list[int], ends: list[int]) -> str:
    """``text`` without the words of the spans and what stands between them."""
    raw = text.encode()
    spaced = raw.translate(_WORD_BYTES)
    filled = np.frombuffer(spaced, dtype=np.uint8) != 32
    change = np.flatnonzero(np.diff(np.concatenate(([False], filled, [False]))))
    first, last = change[::2], change[1::2]
    kept, at = [], 0
    for start, end in zip(starts, ends):
        kept.append(raw[at : first[start]])
        at = int(last[end - 1])
    return b"".join([*kept, raw[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the passages cut out of the texts; a document of nothing else goes.

    Texts without a passage, null and empty ones included, stay as they are.
    """

    @F.pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else cut_text(t, s, e) for t, s, e in zip(texts, starts, ends)])

    column = fresh(docs, "passages")
    found = find_passages(docs, benchmark, text, column=column, **options)
    p = F.col(column)
    hit = F.size(p["starts"]) > 0
    # Only texts with a passage travel to be cut.
    cleaned = cut(F.when(hit, F.col(text)), p["starts"], p["ends"])
    return (
        found.where((hit_words(p) < p["n_words"]) | ~hit)
        .withColumn(text, F.coalesce(cleaned, F.col(text)))
        .select(*docs.columns)
    )
