"""Operators on pages against brute force."""

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
import zstandard
from pyspark.sql import functions as F

from martlight.llm import langid, urlfilter, warc
from martlight.llm.queries import URL_RULES
from tests.llm import brute
from tests.llm.tables import PAGES, clashing


def pages(spark, rows):
    return clashing(spark.createDataFrame(rows, PAGES))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], PAGES)


# URL, host, path, rule and the rule's verdict.
URLS = [
    ("https://a.com/x?q#f", "a.com", "/x", "com/", "allow"),
    ("http://A.Example.COM/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("http://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://m.www.example.com/en/", "m.www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://example.com/EN/1", "example.com", "/EN/1", "com/", "allow"),
    ("http://badexample.com/en/1", "badexample.com", "/en/1", "com/", "allow"),
    ("http://x.net/es/", "x.net", "/es/", "net/es/", "block"),
    ("http://x.net/fr/a?b", "x.net", "/fr/a", "net/fr/", "block"),
    ("http://x.net/fr", "x.net", "/fr", None, None),
    ("http://y.org/fr/", "y.org", "/fr/", None, None),
    ("http://com", "com", "", None, None),
    ("http://com/", "com", "/", "com/", "allow"),
    ("http://a.com?x=/y", "a.com", "", None, None),
    ("ftp://u:p@h.com:81/x://y/z", "u:p@h.com:81", "/x://y/z", None, None),
    ("://h.com/p", "h.com", "/p", "com/", "allow"),
    ("mailto:x@a.com", "", "", None, None),
    ("http://h.com/a\nb", "h.com", "/a\nb", "com/", "allow"),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def test_rules(spark, none):
    rows = [(i, u, None) for i, (u, *_) in enumerate(URLS)] + [(None, URLS[0][0], ""), (1, URLS[1][0], "<a href=")]
    found = urlfilter.judge_urls(pages(spark, rows), URL_RULES).collect()
    assert len(found) == len(rows)
    for r in found:
        url, host, path, name, verdict = URLS[r.page_id or 0]
        assert (r.host, r.path, r.rule) == (host, path, name)
        if verdict:
            assert r.verdict == verdict
    assert urlfilter.judge_urls(none, URL_RULES).isEmpty()
    assert urlfilter.judge_urls(pages(spark, rows), []).where("rule is not null or verdict <> 'allow'").isEmpty()


def link(host):
    return f'<A class="x" hReF = "https://{host}/page?x#y">t</a><link href="//not.a.link/">'


def test_trust_and_distrust_spread(spark):
    graph = {
        "good.com": ["friend.org", "both.org"],
        "friend.org": ["friendly.org"],
        "friendly.org": ["good.com"],
        "spam.org": ["bad.net", "worse.org"],
        "worse.org": ["bad.net"],
        "both.org": ["bad.net"],
        "alone.org": [],
        "bad.net": ["victim.org"],
        "victim.org": [],
    }
    paths = {"good.com": "/", "bad.net": "/es/"}
    rows = [
        (i, f"http://{h}{paths.get(h, '/p')}", "".join(map(link, t)) + link(h) + '<a href="/own">')
        for i, (h, t) in enumerate(graph.items())
    ]
    found = {r.host: r for r in urlfilter.judge_urls(pages(spark, rows), URL_RULES, rounds=8).collect()}
    total = 10**15
    start = {"trust": {"good.com": total}, "distrust": {"bad.net": total}}
    for kind, own in start.items():
        ways = defaultdict(list)
        for s, targets in graph.items():
            for t in targets:
                a, b = (s, t) if kind == "trust" else (t, s)
                ways[a].append(b)
        ranks = dict(own)
        for _ in range(8):
            following = defaultdict(int, {h: m * 15 // 100 for h, m in own.items()})
            for h, m in ranks.items():
                for t in ways[h]:
                    following[t] += m * 85 // 100 // len(ways[h])
            ranks = following
        assert {h: r[kind] for h, r in found.items()} == {h: ranks.get(h, 0) for h in graph}
    verdicts = {h: r.verdict for h, r in found.items()}
    assert {h for h, v in verdicts.items() if v == "block"} >= {"bad.net", "spam.org", "worse.org"}
    assert {verdicts[h] for h in ("good.com", "friend.org", "alone.org", "victim.org")} == {"allow"}


def page_rows():
    rng = random.Random(4)
    bodies = [f"<html>{' '.join(str(rng.random()) for _ in range(rng.randrange(200)))}</html>" for _ in range(60)]
    bodies += ["", "Ü\U0001f600" * 50, "\r\n\r\nWARC/1.1\r\n\r\n", "\x00\x01 P*M\x18", "long " * 300_000]
    rows = [(i, f"http://h{i}.com/", b) for i, b in enumerate(bodies)]
    rows += [(100 + i, "http://copy.com/", bodies[7]) for i in range(30)]
    rows += [(200, None, None), (201, "http://x/\r\nEvil: 1", None), (None, "u", bodies[7]), (None, "u", "only nameless")]
    return rows + [rows[7], rows[80], (-5, "http://first/", bodies[9])]


@pytest.mark.parametrize("archive_bytes", [warc.ARCHIVE_BYTES, 30_000, 1])
def test_archives(spark, tmp_path, none, archive_bytes):
    rows = page_rows()
    path = str(tmp_path / "archives")
    warc.write_archives(pages(spark, rows).repartition(3), path, archive_bytes=archive_bytes)
    found = warc.read_archives(spark, path).collect()
    first = {}
    for k, _, body in rows:
        if k is not None:
            first[body or ""] = min(first.get(body or "", k), k)
    expected = Counter()
    for k, _, body in rows:
        raw = (body or "").encode()
        lead = first.get(body or "")
        later = lead is not None and (k is None or k > lead)
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        expected[
            None if k is None else str(k), len(raw), digest, "revisit" if later else "response",
            str(lead) if later else None, b"" if later else raw,
        ] += 1
    assert expected == Counter(
        (r.page_key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to_key, bytes(r.payload)) for r in found
    )
    files = sorted(Path(path).glob("part-*"))
    assert len(files) <= 3 if archive_bytes == warc.ARCHIVE_BYTES else len(files) > 3
    records = 0
    for raw in (f.read_bytes() for f in files):
        # Any reader that takes the dictionary from the first frame reads the rest as one stream.
        assert raw[:4] == b"\x5d\x2a\x4d\x18"
        size = int.from_bytes(raw[4:8], "little")
        unpack = zstandard.ZstdDecompressor(dict_data=warc._dictionary(raw[8 : 8 + size]))
        with unpack.stream_reader(raw[8 + size :], read_across_frames=True) as stream:
            text = stream.read()
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: ")
        inside = list(warc.read_frames(raw))
        assert b"".join(inside) == text
        # Only the last record may take an archive over its size.
        assert len(raw) - len(inside[-1]) - 100 < archive_bytes + 8 + size
        records += len(inside)
    assert records == len(rows)
    warc.write_archives(none, path + "-none")
    assert warc.read_archives(spark, path + "-none").isEmpty()


def test_damage_is_found():
    digest = base64.b32encode(hashlib.sha1(b"abc").digest()).decode()
    good = warc.record(1, "u", b"abc", digest, 3, None, "2024-01-01T00:00:00Z")
    assert warc.parse_record(good)[1] == b"abc"
    with pytest.raises(ValueError):
        warc.parse_record(good.replace(b"abc", b"abd"))


def html(text, lang=None):
    return f"<html{f' lang={lang}' if lang else ''}><script>var the = 'le la der';</script><p>{text}</p></html>"


def test_language_by_text_alone(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) > 60")
    model = langid.train(docs.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1").select(F.col("doc_id").alias("page_id"), "text", "lang").collect()
    rows = [(r.page_id, None, html(r.text)) for r in held]
    found = {r.page_id: r.language for r in langid.identify(pages(spark, rows), model).collect()}
    right = sum(found[r.page_id] == r.lang for r in held)
    assert right / len(held) > 0.9


def soft(scores):
    top = max(scores)
    powers = [math.exp(s - top) for s in scores]
    return [p / sum(powers) for p in powers]


def fused_languages(rows, model):
    """{row number: (text language, language, probability)}, every sum over all pages written out."""
    k, names = len(model.languages), model.languages
    facts = []
    for _, url, body in rows:
        body = body or ""
        found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (found[1].translate(brute._LOWER), found[2]) if found else ("", "")
        declared = re.search(r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([a-z]{2})""", body)
        folder = re.match(r"/([A-Za-z]{2})(?:/|$)", path)
        bare = re.sub(r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ", body)
        bare = re.sub(r"(?s)<[^>]*>|&[a-zA-Z#0-9]{1,8};", " ", bare)
        domain = re.search(r"([^.]+\.[^.]+)$", host)
        facts.append(
            {
                "host": host,
                "domain": domain[1] if domain else "",
                "declared": declared[1].lower() if declared else "",
                "suffix": host.rpartition(".")[2],
                "folder": folder[1].lower() if folder else "",
                "text": model.scores(bare).tolist(),
            }
        )

    def sums(by, shares):
        out = defaultdict(lambda: [0] * k)
        for f, p in zip(facts, shares):
            for i in range(k):
                # Halves go away from zero.
                out[f[by] if by else ""][i] += math.floor(p[i] * 1_000_000 + 0.5)
        return {g: [n / 1_000_000 for n in own] for g, own in out.items()}

    by_text = [soft(f["text"]) for f in facts]
    everywhere = sums(None, by_text)[""]
    scores = [list(f["text"]) for f in facts]
    for evidence in ("declared", "suffix", "folder"):
        counts = sums(evidence, by_text)
        for f, s in zip(facts, scores):
            for i in range(k):
                s[i] += math.log((counts[f[evidence]][i] + 0.5) / (everywhere[i] + 1))
    shares = [soft(s) for s in scores]
    hosts, domains = sums("host", shares), sums("domain", shares)
    total, out = sum(everywhere), []
    for f, s, p in zip(facts, scores, shares):
        prior = [(a + 0.5) / (total + 0.5 * k) for a in everywhere]
        for group in (domains[f["domain"]], hosts[f["host"]]):
            own = [max(n - q, 0.0) for n, q in zip(group, p)]
            prior = [(o + 10 * a) / (sum(own) + 10) for o, a in zip(own, prior)]
        final = soft([x + math.log(a) for x, a in zip(s, prior)])
        out.append((names[f["text"].index(max(f["text"]))], names[final.index(max(final))], max(final)))
    return out


def test_languages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.train(docs)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    texts = [r.text for r in docs.where("length(text) > 300").limit(40).collect()]
    rows += [(50_000 + i, f"http://h{i % 3}.d{i % 2}.{'de' if i % 2 else 'fr'}/{'es' if i % 5 else 'x'}/", html(t[:200], ("en", None, "de")[i % 3])) for i, t in enumerate(texts)]
    rows += [(None, None, None), (60_000, "no address", ""), (60_001, "http://h0.d0.fr", html(""))]
    found = sorted(
        ((r.page_id is None, r.page_id or 0, r.text_language, r.language, r.probability) for r in langid.identify(pages(spark, rows), model).collect())
    )
    expected = sorted((key is None, key or 0, *e) for (key, *_), e in zip(rows, fused_languages(rows, model)))
    assert [f[:4] for f in found] == [e[:4] for e in expected]
    assert all(abs(f[4] - e[4]) < 2e-6 for f, e in zip(found, expected))


def test_evidence_is_fused(spark, sf_dir, none):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.train(docs)
    texts = {r.lang: r.text for r in docs.where("length(text) > 400").collect()}
    rows, key = [], 0
    for lang, text in sorted(texts.items()):
        for i in range(30):
            rows.append((key, f"http://{lang}{i % 3}.site{lang}.com/{lang}/{i}", html(text[i : i + 300], lang)))
            key += 1
    asked = [
        (key, "http://de0.sitede.com/x", html("")),  # the host alone
        (key + 1, "http://new.sitede.com/x", html("")),  # the domain
        (key + 2, "http://unknown.org/x", html("", "es")),  # the markup
        (key + 3, "http://unknown.org/fr/x", html("")),  # the address
        (key + 4, "http://de0.sitede.com/de/", html(texts["fr"], "de")),  # text against the rest
        (key + 5, None, None),
    ]
    found = {r.page_id: r for r in langid.identify(pages(spark, [*rows, *asked, (None, None, ""), rows[0]]), model).collect()}
    assert [found[key + i].language for i in range(5)] == ["de", "de", "es", "fr", "fr"]
    assert found[key + 5].language is not None and found[None].language == found[key + 5].language
    assert all(0 < r.probability <= 1 for r in found.values())
    assert langid.identify(none, model).isEmpty()
    untrained = langid.train(docs.where("false"))
    assert langid.identify(pages(spark, asked), untrained).where("language is not null").isEmpty()
