"""Periodic runs against brute force, as an operator and as the registered query."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from martlight.llm import periodic
from martlight.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.tables import DOCUMENTS, clashing, document_rows, documents, sentence


def brute_runs(w, least=6, exponent=4):
    """[(start, length, period)]: every period's maximal stretches, each under its smallest period."""
    n, found = len(w), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_collapsed(w, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_words(rng, longest=160):
    kinds, out = rng.choice([1, 2, 3, 9]), []
    while len(out) < rng.randrange(longest):
        unit = [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(1, 22))]
        out += (unit * rng.randrange(1, 9))[: rng.randrange(1, 130)]
    return out


@pytest.mark.parametrize("appended", [1, 7, 64, 1 << 16])
@pytest.mark.parametrize("least,exponent", [(6, 4), (1, 4), (10, 5)])
def test_runs_of_streams(monkeypatch, appended, least, exponent):
    """Words that come one by one, a few, or all at once: the same runs."""
    monkeypatch.setattr(periodic, "_APPEND", appended)
    rng = random.Random(appended * 100 + exponent)
    for _ in range(40):
        texts = [periodic_words(rng) for _ in range(rng.randrange(1, 6))]
        found = periodic.runs_of([[w.encode() for w in t] for t in texts], least, exponent)
        for text, runs in zip(texts, found):
            assert list(zip(*(c.tolist() for c in runs))) == brute_runs(text, least, exponent)


def test_thue_morse_words_have_no_runs():
    word = np.array([bin(i).count("1") & 1 for i in range(1 << 14)])
    (runs,) = periodic.runs_of([[b"01"[b : b + 1] for b in word.tolist()]], 1, 4)
    assert len(runs[0]) == 0


def test_catchers_need_exponent_four():
    with pytest.raises(ValueError):
        periodic.SquareCatchers(100, min_exponent=3)


def run_rows():
    rng = random.Random(9)
    rows = [(i, " ".join(periodic_words(rng)), "s") for i in range(150)]
    long = sentence(rng, 3000).split(" ")
    rows += [(700, " ".join(long * 5), "s"), (701, "same " * 50_000, "s"), (702, ("a b c\n" * 9) + "a", "s")]
    rows += [(703, "\x1c ".join(["x"] * 9), "s"), rows[0], rows[0], (5, "z z z z z z", None)]
    return rows + [(None if k is None else k + 1000, t, h) for k, t, h in document_rows()]


def test_find_runs(spark, monkeypatch):
    monkeypatch.setattr(periodic, "_STREAM_WORDS", 500)
    rows = [r for r in run_rows() if r[0] != 701 and len(r[1] or "") < 100_000]
    found = periodic.find_runs(clashing(documents(spark, rows)).repartition(5)).collect()
    expected = Counter()
    for key, text, _ in rows:
        w = brute.words(text)
        runs = brute_runs(w)
        expected[key, len(w), tuple(runs), brute_collapsed(w, runs)] += 1
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in found) == expected


def contract_row(key, text):
    w = brute.words(text)
    if key is not None and w:
        h = zlib.crc32(str(key).encode())
        g = h // 10
        if h % 10 == 0:
            n = len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = brute_runs(w)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    shas = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, brute_collapsed(w, runs))]
    if not runs:
        return (key, 0, None, None, None, None, *shas)
    s, length, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    return (key, len(runs), s, length, q, 1000 * length // q, *shas)


def test_query(spark, tmp_path):
    # Ids that the contract makes periodic, among others, on texts short enough for brute force.
    rows = [(k, t, h) for k, t, h in run_rows() if len(t or "") < 20_000]
    rows += [(10_000 + i, t, h) for i, (_, t, h) in enumerate(rows * 3)]
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k, t, _ in rows if k is not None and t) > 30
    documents(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    kinds = dict(found.dtypes)
    assert all(kinds[c] == "bigint" for c in ("n_runs", "start", "length", "period", "exponent_milli"))
    assert Counter(map(tuple, found.collect())) == Counter(contract_row(k, t) for k, t, _ in rows)


def test_very_long_texts(spark):
    rng = random.Random(3)
    unit = sentence(rng, 40_000).split(" ")
    rows = [(1, "same " * 300_000, "s"), (2, " ".join(unit * 5), "s"), (3, sentence(rng, 60_000), "s")]
    found = {r.doc_id: r for r in periodic.find_runs(documents(spark, rows)).collect()}
    assert list(map(tuple, found[1].runs)) == [(0, 300_000, 1)] and found[1].collapsed == "same"
    assert list(map(tuple, found[2].runs)) == [(0, 200_000, 40_000)] and found[2].collapsed == " ".join(unit)
    assert found[3].runs == [] and found[3].collapsed == rows[2][1]


def test_no_rows(spark):
    assert periodic.find_runs(spark.createDataFrame([], DOCUMENTS)).isEmpty()
