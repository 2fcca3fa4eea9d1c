"""Plain Python counterparts of the operators, for small inputs."""

from __future__ import annotations

import math
import re
import struct
from collections import Counter, defaultdict

import xxhash

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return _WORD.findall(text or "")


def fingerprint(text):
    parts = words((text or "").translate(_LOWER))
    if not parts:
        return 0
    width = min(4, len(parts))
    shingles = [" ".join(parts[i : i + width]) for i in range(len(parts) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_roots(prints, distance=4):
    """For each fingerprint, the number of one that stands for its class."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def near_classes(docs, distance=4):
    """[(doc_id, fingerprint, component_id)] of (doc_id, text) rows."""
    prints = [fingerprint(t) for _, t in docs]
    roots = near_roots(prints, distance)
    least = {}
    for r, (key, _) in zip(roots, docs):
        if key is not None:
            least[r] = min(least.get(r, key), key)
    return [(key, p, least.get(r)) for r, p, (key, _) in zip(roots, prints, docs)]


def one_of_each_class(rows):
    """(doc_id, text, ...) rows of null ids, and of each class the row of the least id and text key."""
    roots = near_roots([fingerprint(r[1]) for r in rows])
    kept = [r for r in rows if r[0] is None]
    best = {}
    for root, row in zip(roots, rows):
        if row[0] is not None:
            mark = xxhash.xxh64_intdigest((row[1] or "").encode(), 42)
            mark = (row[0], mark - (1 << 64) if mark >> 63 else mark)
            if root not in best or mark < best[root][0]:
                best[root] = (mark, row)
    return kept + [row for _, row in best.values()]


def quality_base(text):
    parts = words(text)
    seen = Counter(tuple(parts[i : i + 8]) for i in range(len(parts) - 7))
    inside = {
        i + d for i in range(len(parts) - 7) if seen[tuple(parts[i : i + 8])] > 1 for d in range(8)
    }
    lines = [x for x in (text or "").split("\n") if _WORD.search(x)]
    failed = len(parts) < 20 or 100 * len(inside) > 30 * len(parts)
    return (
        len(parts),
        sum(map(len, parts)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(inside),
        failed,
    )


def normal_line(line):
    return " ".join(words(line)).translate(_LOWER)


def frequent_lines(docs, min_documents, max_percent):
    """{(host, line)} of (text, host) rows; copies in a host count as one document."""
    texts, having = defaultdict(set), defaultdict(set)
    for text, host in docs:
        text, host = text or "", host or ""
        texts[host].add(text)
        for line in text.split("\n"):
            if _WORD.search(line):
                having[host, normal_line(line)].add(text)
    return {
        k for k, s in having.items() if len(s) > min_documents and 100 * len(s) > max_percent * len(texts[k[0]])
    }


def good_documents(docs, min_documents, max_percent):
    """What quality keeps of (doc_id, text, host) rows, with the texts cleaned."""
    often = frequent_lines([(t, h) for _, t, h in docs], min_documents, max_percent)
    out = []
    for key, text, host in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if (host or "", normal_line(x)) not in often or not _WORD.search(x)]
        if not quality_base(text)[5] and len(words("\n".join(kept))) >= 20:
            out.append((key, "\n".join(kept) if len(kept) < len(lines) else text, host))
    return out


_ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def passages(text, items, window=10):
    """(n_words, hit word positions, item names) for (item_id, text) items."""
    parts = _ITEM_WORD.findall((text or "").translate(_LOWER))
    hit, names = set(), set()
    for name, item in items:
        asked = _ITEM_WORD.findall((item or "").translate(_LOWER))
        width = min(window, len(asked))
        found = {tuple(asked[i : i + width]) for i in range(len(asked) - width + 1)} if asked else set()
        for i in range(len(parts) - width + 1):
            if tuple(parts[i : i + width]) in found:
                hit.update(range(i, i + width))
                if name is not None:
                    names.add(str(name))
    return len(parts), hit, sorted(names)


def without_passages(text, items):
    n, hit, _ = passages(text, items)
    if not hit:
        return text
    if len(hit) == n:
        return None
    spans = [m.span() for m in _ITEM_WORD.finditer(text.translate(_LOWER))]
    out, at = [], 0
    for i in sorted(hit):
        if i - 1 not in hit:
            out.append(text[at : spans[i][0]])
        at = spans[i][1]
    return "".join([*out, text[at:]])


_KINDS = [
    (re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 1, 6),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    (re.compile(r"[0-9a-f]+"), 0, 24),
]
_ENCODINGS = [
    (r"(?=.*[0-9])(?=.*[a-f])[0-9a-f]+", "0123456789abcdef"),
    (r"(?=.*[0-9])(?=.*[A-F])[0-9A-F]+", "0123456789ABCDEF"),
    (r"(?=.*[2-7])(?=.*[A-Z])[2-7A-Z]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    (r"(?=.*[0-9])(?=.*[a-z])[0-9a-z]+", "0123456789abcdefghijklmnopqrstuvwxyz"),
    (r"(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (
        r"(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[0-9A-Za-z+/]+",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    ),
    (
        r"(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[0-9A-Za-z_-]+",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    ),
]


def base_spans(text):
    """[(start, kind number, end)] of the named patterns."""
    found = [
        (m.start(), k, m.end())
        for k, (pattern, group, least) in enumerate(_KINDS)
        for m in pattern.finditer(text or "")
        if len(m[group]) >= least
    ]
    return sorted(found)


def token_score(token):
    """None for no known encoding, -1 if a test speaks against uniform symbols, else the score."""
    symbols = next((s for p, s in _ENCODINGS if re.fullmatch(p, token)), None)
    if symbols is None:
        return None
    k, n, x = len(symbols), float(len(token)), [symbols.index(c) for c in token]
    squares = float(sum(v * v for v in Counter(x).values()))
    uniform = (squares * k / n - n - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    upper = [v >= k // 2 for v in x]
    u = float(sum(upper))
    runs = 1 + sum(a != b for a, b in zip(upper, upper[1:]))
    expected = 2 * u * (n - u) / n + 1
    spread = (expected - 1) * (expected - 2) / (n - 1)
    runs_z = (runs - expected) / math.sqrt(spread) if spread > 0 else 99.0
    mean = sum(x) / n
    power = sum((v - mean) ** 2 for v in x)
    lagged = sum((a - mean) * (b - mean) for a, b in zip(x, x[1:]))
    serial = (lagged / power + 1 / n) * math.sqrt(n) if power > 0 else 99.0
    if uniform > 3.29 or abs(runs_z) > 3.29 or abs(serial) > 3.29:
        return -1
    word = max(0.066, 1.75 / k)
    seen = (squares - n) / (n * (n - 1))
    z = (word - seen) / math.sqrt(2 * word * (1 - word) / (n * (n - 1)) + 4 * 0.3 * word * word / n)
    tail = 0.5 * math.exp(-0.717 * abs(z) - 0.416 * z * z)
    p = min(max((tail if z >= 0 else 1 - tail) / (n / 40), 1e-300), 1.0)
    return math.floor(-math.log10(p) * 100)


def token_readings(m):
    """[(start, end, score)] of a token, and of its parts if it isn't random-looking as a whole."""
    whole = token_score(m[0])
    out = [(m.start(), m.end(), whole)]
    if whole is not None and whole >= 0 or not re.search(r"[/_-]", m[0]):
        return out
    pieces = list(re.finditer(r"[A-Za-z0-9+]{20,}", m[0]))
    bare = m[0].replace("-", "").replace("_", "")
    if pieces:
        out += [(m.start() + p.start(), m.start() + p.end(), token_score(p[0])) for p in pieces]
    elif len(bare) >= 20 and "/" not in m[0]:
        out.append((m.start(), m.end(), token_score(bare)))
    return out


def secret_spans(texts, rate=0.05):
    """[[(start, kind number, end)]] of each text."""
    tokens = [[x for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", t or "") for x in token_readings(m)] for t in texts]
    scores = [s for row in tokens for _, _, s in row if s is not None]
    good = [s for s in set(scores) if s >= 0 and 10 ** (-s / 100) * len(scores) <= rate * sum(o >= s for o in scores)]
    least = min(good, default=math.inf)
    out = []
    for text, row in zip(texts, tokens):
        base = base_spans(text)
        more = [
            (a, 3, b)
            for a, b, s in row
            if s is not None and s >= least and not any(x < b and a < y for x, _, y in base)
        ]
        out.append(sorted(base + more))
    return out


def masked(text, spans):
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if spans else text


def without_repeats(docs, width=50):
    """[(doc_id, n_words, n_removed, kept text)] of (doc_id, text) rows."""
    first = {}
    last = float("inf")
    for key, text in docs:
        parts = words(text)
        for i in range(len(parts) - width + 1):
            w = tuple(parts[i : i + width])
            first[w] = min(first.get(w, last), last if key is None else key)
    out = []
    for key, text in docs:
        parts = words(text)
        gone = {
            i + d
            for i in range(len(parts) - width + 1)
            if first[tuple(parts[i : i + width])] < (last if key is None else key)
            for d in range(width)
        }
        out.append((key, len(parts), len(gone), " ".join(w for i, w in enumerate(parts) if i not in gone)))
    return out


def draw(key, level, weights):
    """The child that a shard tree's level gives a key."""
    def score(child, weight):
        seed = xxhash.xxh64_intdigest(struct.pack("<i", level), 42)
        seed = xxhash.xxh64_intdigest(struct.pack("<i", child), seed)
        u = ((xxhash.xxh64_intdigest(struct.pack("<q", key), seed) >> 11) + 1) / 2**53
        return -math.log(u) / weight

    return min(weights, key=lambda c: score(c, weights[c]))
