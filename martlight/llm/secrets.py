"""Secrets in texts: named patterns, and tokens that pass a battery of randomness tests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlight.llm.columns import LOWER, UPPER, bind, fresh, in_blocks, running

# The patterns, in the order in which they are listed.
KINDS = ["assign", "access", "hex", "random"]
_ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# Runs of a class are matched whole, so their least length may stand in the pattern.
_ACCESS = r"(AKIA[A-Z0-9]{16,})"
_HEX = r"([0-9a-f]{24,})"
_TOKEN = r"([A-Za-z0-9+/_-]{20,})"
# What separators part a token into, and those that one secret may be written with.
_PIECE = r"([A-Za-z0-9+]{20,})"
_SEPARATOR = r"[/_-]"
TOKEN_CHARS = 20
ASSIGN_CHARS = 6

_DIGITS = "0123456789"
# z value up to which a token's test does not speak against uniform symbols (two-sided p 0.001).
UNIFORM_Z = 3.29
# Chance that two symbols of a word are equal, at least and as a multiple of the uniform chance.
WORD_COINCIDENCE = 0.066
WORD_COINCIDENCE_RATIO = 1.75
WORD_CUBES_RATIO = 1.3
FALSE_DISCOVERIES = 0.05
# Resolution of p values: hundredths of a power of ten.
_STEPS = 100
# Gaps between secrets in the blocks that a text is cut into before them.
_CUT_BLOCKS = [4096, 64]


@dataclass(frozen=True)
class Encoding:
    """Symbols in order; ``pattern`` matches the whole tokens that are written in it."""

    pattern: str
    symbols: str


ENCODINGS = [
    Encoding(r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", _DIGITS + "abcdef"),
    Encoding(r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", _DIGITS + "ABCDEF"),
    Encoding(r"^(?=.*[2-7])(?=.*[A-Z])[2-7A-Z]+$", UPPER + "234567"),
    Encoding(r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", _DIGITS + LOWER),
    Encoding(r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$", _DIGITS + UPPER),
    Encoding(r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[0-9A-Za-z+/]+$", UPPER + LOWER + _DIGITS + "+/"),
    Encoding(r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[0-9A-Za-z_-]+$", UPPER + LOWER + _DIGITS + "-_"),
]

_NO_SPANS = "cast(array() as array<struct<start: int, kind: int, end: int, token: string>>)"


def _matches(text: Column, pattern: str, kind: int, least: int = 0) -> Column:
    """Spans (start, kind, end, token) of the pattern's matches whose group 1 has ``least`` characters.

    Between two matches stands what a split leaves, so positions are sums of lengths.
    """
    def place(parts: Column) -> Column:
        lengths = F.transform(parts, lambda p: F.length(p["gap"]) + F.length(p["whole"]))

        def span(p: Column, at: Column) -> Column:
            begin = at + F.length(p["gap"])
            end = begin + F.length(p["whole"])
            return F.struct(
                begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), p["token"].alias("token")
            )

        spans = F.zip_with(parts, running(lengths, F.lit(0), lambda a, b: a + b), span)
        return F.filter(spans, lambda s: F.length(s["token"]) >= least)

    expression = F.lit(pattern)
    # The last piece of the split follows the last match and pairs with nothing.
    parts = F.filter(
        F.arrays_zip(
            F.split(text, pattern, -1).alias("gap"),
            F.regexp_extract_all(text, expression, 0).alias("whole"),
            F.regexp_extract_all(text, expression, 1).alias("token"),
        ),
        lambda p: p["whole"].isNotNull(),
    )
    return F.when(F.regexp_like(text, expression), bind(parts, place)).otherwise(F.expr(_NO_SPANS))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, within a few percent."""
    a = F.abs(z)
    tail = 0.5 * F.exp(-0.717 * a - 0.416 * a * a)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _z_values(token: Column, symbols: str) -> Column:
    """(uniform, runs, serial, coincidence) of a token in an encoding.

    uniform: chi-squared of the symbol counts, standardised by its exact variance; runs: runs of
    symbols of the upper and lower half of the alphabet; serial: correlation of
    neighbours' numbers; coincidence: how far below a word's the chance of equal symbols is.
    """
    k = len(symbols)

    def tests(chars: Column) -> Column:
        n = F.size(chars).cast("double")
        numbers = F.transform(chars, lambda c: F.instr(F.lit(symbols), c) - 1)

        def measured(x: Column) -> Column:
            squares = F.aggregate(
                F.array_distinct(x),
                F.lit(0.0),
                lambda total, v: total + F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), 2.0),
            )
            upper = F.size(F.filter(x, lambda v: v >= k // 2)).cast("double")
            sums = F.aggregate(x, F.lit(0.0), lambda total, v: total + v)
            turns = F.size(
                F.filter(
                    F.transform(x, lambda v, i: (v >= k // 2) != (F.get(x, F.greatest(i - 1, F.lit(0))) >= k // 2)),
                    lambda changed: changed,
                )
            ).cast("double")
            return F.struct(
                squares.alias("squares"), upper.alias("upper"), (sums / n).alias("mean"), (turns + 1).alias("runs"), x.alias("x")
            )

        def scores(m: Column) -> Column:
            squares, upper, runs = m["squares"], m["upper"], m["runs"]
            chi = squares * k / n - n
            uniform = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
            expected = 2 * upper * (n - upper) / n + 1
            spread = (expected - 1) * (expected - 2) / (n - 1)
            runs_z = F.when(spread > 0, (runs - expected) / F.sqrt(spread)).otherwise(F.lit(99.0))
            power = F.aggregate(m["x"], F.lit(0.0), lambda t, v: t + (v - m["mean"]) * (v - m["mean"]))
            lagged = F.aggregate(
                F.transform(
                    m["x"],
                    lambda v, i: F.when(i > 0, (v - m["mean"]) * (F.get(m["x"], F.greatest(i - 1, F.lit(0))) - m["mean"]))
                    .otherwise(F.lit(0.0)),
                ),
                F.lit(0.0),
                lambda t, v: t + v,
            )
            serial = F.when(power > 0, (lagged / power + 1 / n) * F.sqrt(n)).otherwise(F.lit(99.0))
            word = max(WORD_COINCIDENCE, WORD_COINCIDENCE_RATIO / k)
            seen = (squares - n) / (n * (n - 1))
            variance = 2 * word * (1 - word) / (n * (n - 1)) + 4 * (WORD_CUBES_RATIO - 1) * word * word / n
            return F.struct(
                uniform.alias("uniform"),
                runs_z.alias("runs"),
                serial.alias("serial"),
                ((word - seen) / F.sqrt(variance)).alias("coincidence"),
            )

        return bind(bind(numbers, measured), scores)

    return bind(F.split(token, ""), tests)


def _tested(span: Column) -> Column:
    """The span with ``score``, hundredths of -log10 of its p value as a word; null if not random-looking.

    The encoding is the first that fits. A token counts as random-looking if no test speaks
    against uniform symbols. Its p value is that of a word's rate of equal symbols falling as low, weighted
    by length: a longer token is given more of the false discoveries.
    """
    token = span["token"]
    values = F.when(F.lit(False), _z_values(token, ENCODINGS[0].symbols))
    for encoding in ENCODINGS:
        values = values.when(F.regexp_like(token, F.lit(encoding.pattern)), _z_values(token, encoding.symbols))

    def judged(z: Column) -> Column:
        random = (
            (z["uniform"] <= UNIFORM_Z) & (F.abs(z["runs"]) <= UNIFORM_Z) & (F.abs(z["serial"]) <= UNIFORM_Z)
        )
        weight = F.length(token) / 40.0
        p = F.greatest(F.least(_tail(z["coincidence"]) / weight, F.lit(1.0)), F.lit(1e-300))
        score = F.floor(-F.log10(p) * _STEPS).cast("int")
        return F.struct(
            span["start"].alias("start"),
            span["kind"].alias("kind"),
            span["end"].alias("end"),
            F.when(random, score).alias("score"),
            z.isNotNull().alias("candidate"),
        )

    return bind(values, judged)


def _parts(span: Column) -> Column:
    """Other readings of a token with separators, as spans of the text.

    Its pieces between separators, those that are long enough; where there is none, and it has no slash,
    all of it without its hyphens and underscores, as keys are written in groups.
    """
    kind = KINDS.index("random")

    def or_joined(pieces: Column) -> Column:
        shifted = F.transform(
            pieces,
            lambda p: F.struct(
                (span["start"] + p["start"]).alias("start"),
                p["kind"].alias("kind"),
                (span["start"] + p["end"]).alias("end"),
                p["token"].alias("token"),
            ),
        )
        bare = F.translate(span["token"], "-_", "")
        joined = F.struct(
            span["start"].alias("start"), span["kind"].alias("kind"), span["end"].alias("end"), bare.alias("token")
        )
        groups = (F.length(bare) >= TOKEN_CHARS) & ~F.contains(span["token"], F.lit("/"))
        return F.when(F.size(pieces) > 0, shifted).when(groups, F.array(joined)).otherwise(F.expr(_NO_SPANS))

    parted = F.regexp_like(span["token"], F.lit(_SEPARATOR))
    return F.when(parted, bind(_matches(span["token"], _PIECE, kind), or_joined)).otherwise(F.expr(_NO_SPANS))


def random_tokens(text: Column) -> Column:
    """(start, kind, end, score) of the tokens in a known encoding.

    A token that does not look random as a whole is tested in its parts as well; every
    test counts as one.
    """

    def tested(span: Column) -> Column:
        def with_parts(whole: Column) -> Column:
            alone = F.array(whole)
            return F.when(whole["score"].isNotNull(), alone).otherwise(F.concat(alone, F.transform(_parts(span), _tested)))

        return bind(_tested(span), with_parts)

    found = F.flatten(F.transform(_matches(text, _TOKEN, KINDS.index("random")), tested))
    return F.filter(found, lambda s: s["candidate"])


def discovery_score(texts: DataFrame, text: str = "text", rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """One row, ``least``: the score from which tokens are discoveries at the false-discovery ``rate``.

    Benjamini-Hochberg over all tokens of the corpus, on a histogram of scores: the least
    score s whose p value is at most rate * (tokens scoring s or more) / (all tokens).
    No such score, or no token: null, and nothing is a discovery.
    """
    found = texts.select(F.explode(random_tokens(F.coalesce(F.col(text), F.lit("")))).alias("t"))
    bins = found.groupBy(F.coalesce("t.score", F.lit(-1)).alias("score")).agg(F.count(F.lit(1)).alias("n"))
    # The window is over bins, of which there are 30,000 at most.
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = bins.select("score", F.sum("n").over(above).alias("at_least"), F.sum("n").over(every).alias("tokens"))
    p = F.pow(F.lit(10.0), -F.col("score") / float(_STEPS))
    enough = (F.col("score") >= 0) & (p * F.col("tokens") <= rate * F.col("at_least"))
    return ranked.where(enough).agg(F.min("score").alias("least"))


def _apart(spans: Column) -> Column:
    """Sorted spans without the random tokens that a pattern's span overlaps.

    Spans that start no later are asked for their farthest end, later ones for their first start.
    """
    random, far = KINDS.index("random"), 2**31 - 1
    ends = F.transform(spans, lambda s: F.when(s["kind"] < random, s["end"]).otherwise(0))
    starts = F.transform(F.reverse(spans), lambda s: F.when(s["kind"] < random, s["start"]).otherwise(far))

    def kept(around: Column) -> Column:
        free = lambda s, i: (F.get(around["reach"], i) <= s["start"]) & (F.get(around["next"], i) >= s["end"])
        return F.filter(spans, lambda s, i: (s["kind"] < random) | free(s, i))

    reach = running(ends, F.lit(0), F.greatest)
    following = F.reverse(running(starts, F.lit(far), F.least))
    return bind(F.struct(reach.alias("reach"), following.alias("next")), kept)


def find_secrets(
    docs: DataFrame, text: str = "text", rate: float = FALSE_DISCOVERIES, column: str = "secrets"
) -> DataFrame:
    """Add ``column``: spans (start, kind, end) of each text, sorted; code points, end exclusive.

    kind is a position in KINDS. Patterns come first; a random token counts where no
    pattern's span overlaps it. A null or empty text has none. The corpus is read twice: for the
    score that discoveries need, and for the spans. The work on a text grows with its length and matches alone.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    least = fresh(docs, "least_score")
    rows = docs.withColumn(least, discovery_score(docs, text, rate).scalar())

    def plain(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))

    named = F.concat(
        _matches(whole, _ASSIGN, KINDS.index("assign"), ASSIGN_CHARS),
        _matches(whole, _ACCESS, KINDS.index("access")),
        _matches(whole, _HEX, KINDS.index("hex")),
    )

    discoveries = F.filter(random_tokens(whole), lambda s: F.coalesce(s["score"] >= F.col(least), F.lit(False)))
    spans = F.sort_array(F.concat(plain(named), plain(discoveries)))
    return rows.withColumn(column, bind(spans, _apart)).drop(least)


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    entry = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, entry), ",")


def _joined(text: Column, offset: Column, gaps: Column, mark: str, blocks: list[int]) -> Column:
    """The ``gaps`` (start, end) of a text that begins at ``offset``, in order, each followed by ``mark``.

    Spark finds a character by counting from a string's start, so the text is cut block by
    block before it is cut gap by gap.
    """
    def cut(first: Column, last: Column) -> Column:
        return F.substring(text, first["start"] - offset + 1, last["end"] - first["start"])

    if not blocks:
        return F.array_join(F.transform(gaps, lambda g: F.concat(cut(g, g), F.lit(mark))), "")

    def section(block: Column) -> Column:
        first, last = F.get(block, F.lit(0)), F.get(block, F.size(block) - 1)
        return bind(cut(first, last), lambda part: _joined(part, first["start"], block, mark, blocks[1:]))

    return F.array_join(F.transform(in_blocks(gaps, blocks[0]), section), "")


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]", rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; overlapping ones by one mark."""
    column = fresh(docs, "secrets")
    found = find_secrets(docs, text, rate, column)
    reach = running(F.transform(column, lambda s: s["end"]), F.lit(0), F.greatest)

    def gaps(reach: Column) -> Column:
        before = F.zip_with(column, reach, lambda s, at: F.struct(at.alias("start"), s["start"].alias("end")))
        return F.filter(before, lambda g: g["end"] >= g["start"])

    kept = bind(bind(reach, gaps), lambda g: _joined(F.col(text), F.lit(0), g, mark, _CUT_BLOCKS))
    last = F.array_max(F.transform(column, lambda s: s["end"]))
    clean = F.concat(kept, F.substring(F.col(text), last + 1, F.length(text)))
    return found.withColumn(text, F.when(F.size(column) > 0, clean).otherwise(F.col(text))).select(*docs.columns)
