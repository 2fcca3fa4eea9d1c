"""Removal of long passages that repeat across documents, by level-wise doubling of windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martlight.session import materialize

WINDOW_WORDS = 50
# Windows of the first level; each level's are about twice as long as those of the one before.
SHORTEST_WORDS = 13

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)
# Word hashes one worker process remembers, about 150 bytes each.
_CACHE_WORDS = 400_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word, 7)
        if len(self) < _CACHE_WORDS and len(word) < 64:
            self[word] = found
        return found


_hashes = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit sums."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and its inverse, kept as far as a text of the process needed them."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << n.bit_length()
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)
        return self.up[:n], self.down[:n]


_powers_of = _Powers()


class WindowHashes:
    """64-bit hashes of word sequences of one text, all of a length at once."""

    def __init__(self, text: str | None):
        self.words = (text or "").encode().split()
        n = len(self.words)
        up, self._down = _powers_of.upto(n + 1)
        hashes = np.fromiter(map(_hashes.__getitem__, self.words), dtype=np.uint64, count=n)
        self._sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:n], dtype=np.uint64)))

    def between(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        sums = (self._sums[stops] - self._sums[starts]) * self._down[starts]
        return _mixed(sums + (stops - starts).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        starts = np.arange(max(0, len(self.words) - width + 1))
        return self.between(starts, starts + width)

    def runs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(seed, run, first window, last window) of the runs of windows that share a seed.

        A window's seed is the least hash among the windows of half its length inside it, the
        first of equal ones. It depends on the window's words alone, so equal windows of two
        texts have equal seeds. run hashes all words of the run's windows.
        """
        half = (width + 1) // 2
        inner = self.windows(half)
        if len(inner) < width - half + 1:
            none = np.empty(0, dtype=np.uint64)
            return none, none, none.astype(np.int64), none.astype(np.int64)
        least = sliding_window_view(inner, width - half + 1).argmin(axis=1)
        seed_at = least + np.arange(len(least))
        first = np.flatnonzero(np.diff(seed_at, prepend=-1))
        last = np.concatenate((first[1:], [len(least)])) - 1
        return inner[seed_at[first]], self.between(first, last + width), first, last


def _unique(*columns: np.ndarray) -> list[np.ndarray]:
    """Distinct rows; the last column decides alone whether rows are equal."""
    at = np.unique(columns[-1], return_index=True)[1]
    return [c[at] for c in columns]


# What names a row: its document's key, and a hash of its text, as any number of rows may share a key.
_ROW = ["key", "own"]


def _rows_of(key_type, names: list[str]) -> StructType:
    return StructType([StructField("key", key_type), *[StructField(n, LongType()) for n in ["own", *names]]])


def _emit(batch: pa.RecordBatch, rows: list[int], columns: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    counts = [len(c) for c in columns[0]]
    at = pa.array(np.repeat(np.array(rows, dtype=np.int64), counts))
    arrays = [pa.array(np.concatenate(c).view(np.int64)) for c in columns]
    return pa.RecordBatch.from_arrays([*[batch.column(c).take(at) for c in _ROW], *arrays], names=[*_ROW, *names])


def levels(width: int, shortest: int) -> list[int]:
    """Lengths of windows, level by level: each at most twice the one before, the last ``width``."""
    found = [width]
    while found[0] > shortest:
        found.insert(0, (found[0] + 1) // 2)
    return found


def _alive(hashes: WindowHashes, live: np.ndarray, below: int, width: int) -> np.ndarray:
    """Which windows of ``width`` words consist of nothing but windows of ``below`` words in the runs ``live``."""
    _, run, first, last = hashes.runs(below)
    held = np.isin(run, live)
    edge = np.zeros(len(hashes.words) + 1, dtype=np.int64)
    np.add.at(edge, first[held], 1)
    np.add.at(edge, last[held] + 1, -1)
    dead = np.concatenate(([0], np.cumsum(np.cumsum(edge) == 0)))
    starts = np.arange(max(0, len(hashes.words) - width + 1))
    return dead[starts + width - below + 1] == dead[starts]


def _seeds(rows: DataFrame, width: int, below: int | None = None) -> DataFrame:
    """(key, own, seed, run): every run of a row once; with ``below``, those that its ``run`` list of that level leaves."""
    schema = _rows_of(rows.schema["key"].dataType, ["seed", "run"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, seeds, runs = [], [], []
            for i, text in enumerate(batch.column("text")):
                hashes = WindowHashes(text.as_py())
                seed, run, first, last = hashes.runs(width)
                if below is not None and len(seed):
                    live = np.array(batch.column("run")[i].as_py(), dtype=np.int64).view(np.uint64)
                    count = np.concatenate(([0], np.cumsum(_alive(hashes, live, below, width))))
                    left = count[last + 1] > count[first]
                    seed, run = seed[left], run[left]
                if len(seed):
                    seed, run = _unique(seed, run)
                    owners.append(i)
                    seeds.append(seed)
                    runs.append(run)
            if owners:
                yield _emit(batch, owners, [seeds, runs], ["seed", "run"])

    return rows.mapInArrow(scan, schema)


def _windows(rows: DataFrame, width: int) -> DataFrame:
    """(key, own, window): the windows of each row's ``extend`` runs, each once."""
    schema = _rows_of(rows.schema["key"].dataType, ["window"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, found = [], []
            for i, (text, wanted) in enumerate(zip(batch.column("text"), batch.column("extend"))):
                hashes = WindowHashes(text.as_py())
                _, run, first, last = hashes.runs(width)
                asked = np.isin(run, np.array(wanted.as_py(), dtype=np.int64).view(np.uint64))
                if asked.any():
                    at = np.concatenate([np.arange(a, b + 1) for a, b in zip(first[asked], last[asked])])
                    owners.append(i)
                    found.append(_unique(hashes.between(at, at + width))[0])
            if owners:
                yield _emit(batch, owners, [found], ["window"])

    return rows.mapInArrow(scan, schema)


def _earlier(first: Column, key: Column) -> Column:
    """Whether ``first`` comes before ``key``; a null key comes after all others."""
    return F.coalesce(first < key, first.isNotNull() & key.isNull())


def _gathered(rows: DataFrame, column: str) -> DataFrame:
    """One list a row, no longer than its text."""
    return rows.groupBy(*_ROW).agg(F.collect_set(column).alias(column))


def _with(rows: DataFrame, more: DataFrame, how: str) -> DataFrame:
    """``rows`` with the further columns of the same row; null keys meet."""
    more = more.withColumnsRenamed({"key": "more_key", "own": "more_own"})
    same = F.col("key").eqNullSafe(F.col("more_key")) & (F.col("own") == F.col("more_own"))
    return rows.join(more, same, how).drop("more_key", "more_own")


def _kept(text: str | None, runs, windows, width: int) -> tuple[int, int, str]:
    if runs is None and windows is None:
        words = (text or "").encode().split()
        return len(words), 0, b" ".join(words).decode()
    hashes = WindowHashes(text)
    edge = np.zeros(len(hashes.words) + 1, dtype=np.int64)
    _, run, first, last = hashes.runs(width)
    if runs is not None:
        gone = np.isin(run, np.asarray(runs, dtype=np.int64).view(np.uint64))
        np.add.at(edge, first[gone], 1)
        np.add.at(edge, last[gone] + width, -1)
    if windows is not None:
        found = np.isin(hashes.windows(width), np.asarray(windows, dtype=np.int64).view(np.uint64))
        starts = np.flatnonzero(found)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + width, -1)
    covered = np.cumsum(edge[:-1]) > 0
    kept = [w for w, gone in zip(hashes.words, covered.tolist()) if not gone]
    return len(hashes.words), len(hashes.words) - len(kept), b" ".join(kept).decode()


def _met_twice(seeds: DataFrame) -> DataFrame:
    """(key, own, run, varies): the runs whose seed stands in two documents; varies tells whether their runs differ."""
    twice = (
        seeds.groupBy("seed")
        .agg(
            F.min("key").alias("low"),
            F.max("key").alias("high"),
            F.bool_or(F.col("key").isNull()).alias("unnamed"),
            (F.min("run") != F.max("run")).alias("varies"),
        )
        .where("low < high or (unnamed and low is not null)")
        .select("seed", "varies")
    )
    return seeds.join(twice, "seed").select(*_ROW, "run", "varies")


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WINDOW_WORDS,
    shortest: int = SHORTEST_WORDS,
) -> DataFrame:
    """One row per document: key, n_words, n_removed, kept_text (the words left, single-spaced).

    A word goes if a window of ``width`` words around it also starts in a document of a lesser
    key. Levels: a window names one of the windows of half its length inside it, its seed, by content
    alone. What repeats at a level is a seed met in two documents; only windows that consist
    of such ones are extended to twice the length at the next, until ``width`` is reached or no
    candidate is left. At the last level, runs of windows with one seed are compared whole first: all documents of a
    run but its first lose it, and only that first one has the run's windows compared one by
    one, if the seed also stands in another run. A group of copies thus costs a row for each
    run and copy, and no pairs. Rows of one key count as one document, rows of a null key as a
    last one; what goes back to a text is its own list, however many rows share its key. Texts of
    fewer than ``width`` words, null and empty ones lose nothing.
    Windows are told apart by 64-bit hashes.
    """
    own = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(key).alias("key"), own.alias("own"), F.col(text).alias("text"))
    live, below = None, None
    for length in levels(width, shortest)[1:] or [width]:
        left = rows if live is None else _with(rows, _gathered(live, "run"), "inner")
        seeds = materialize(_seeds(left, length, below), "repeat-seeds")
        live, below = materialize(_met_twice(seeds), "repeat-runs"), length
        if live.isEmpty():
            break
    firsts = live.groupBy("run").agg(F.min("key").alias("first"), F.bool_or("varies").alias("varies"))
    held = live.select(*_ROW, "run").join(firsts, "run")
    whole = held.where(_earlier(F.col("first"), F.col("key")))
    # Of equal keys each row with the run, as they are one document.
    extend = held.where(F.col("varies") & F.col("key").eqNullSafe(F.col("first"))).withColumnRenamed("run", "extend")
    windows = materialize(_windows(_with(rows, _gathered(extend, "extend"), "inner"), width), "repeat-windows")
    starts = windows.groupBy("window").agg(F.min("key").alias("first"))
    single = windows.join(starts, "window").where(_earlier(F.col("first"), F.col("key")))
    marked = _with(rows, _gathered(whole, "run"), "left")
    marked = _with(marked, _gathered(single, "window"), "left")

    @F.pandas_udf("n_words long, n_removed long, kept_text string")
    def keep(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, runs, windows in batches:
            done = [_kept(t, r, w, width) for t, r, w in zip(texts, runs, windows)]
            yield pd.DataFrame(done, columns=["n_words", "n_removed", "kept_text"])

    return marked.select(F.col("key").alias(key), keep("text", "run", "window").alias("done")).select(key, "done.*")
