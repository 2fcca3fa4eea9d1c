"""Quality rules: shape of a text, and lines that many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.llm.columns import SPACES, ascii_lower, bind, fresh, text_key, words
from martlight.session import materialize

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
# A line is boilerplate if more documents of its host have it than both limits allow.
MIN_LINE_DOCUMENTS = 20
MAX_LINE_PERCENT = 2

_SYMBOLS = "#*$%&|<>"
_TEXT_KEY = ["text_key_1", "text_key_2"]


def normal_line(line: Column) -> Column:
    """A line as lines are compared: A-Z lower-cased, single-spaced, trimmed."""
    return ascii_lower(F.trim(F.regexp_replace(line, f"[{SPACES}]+", " ")))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.regexp_like(x, F.lit(f"[^{SPACES}]")))


def _covered(positions: Column, width: int) -> Column:
    """Places covered by windows of ``width`` at ascending positions."""
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-width).alias("last"))

    def add(done: Column, p: Column) -> Column:
        more = F.least(F.lit(width), p - done["last"]).cast("long")
        return F.struct((done["sum"] + more).alias("sum"), p.alias("last"))

    return F.aggregate(positions, start, add, lambda done: done["sum"])


def repeated_words(hashes: Column, width: int = REPEAT_WINDOW) -> Column:
    """Words inside windows of ``width`` word hashes that occur more than once in the array."""

    def window(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - width)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))

    def repeats(found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def more_than_once(p: Column) -> Column:
            def twin(x: Column, i: Column) -> Column:
                before = F.when(i > 0, F.get(p, i - 1)["h"] == x["h"]).otherwise(False)
                return before | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False))

            return F.sort_array(F.transform(F.filter(p, twin), lambda x: x["i"]))

        return _covered(bind(pairs, more_than_once), width)

    def counted(found: Column) -> Column:
        # Most texts repeat nothing, and a set shows it without sorting.
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(repeats(found))

    return F.when(F.size(hashes) < width, F.lit(0).cast("long")).otherwise(bind(window(hashes), counted))


def text_facts(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """Add ``facts``: the base counts, host, text key and lines (hash, words, first) of each text.

    Lines are ordered by hash; ``first`` is 1 for one of equal lines and 0 for the others.

    All in one pass over the text. A null text is empty; a null host is the host "".
    """
    whole = F.coalesce(F.col(text), F.lit(""))

    def of_words(parts: Column) -> Column:
        hashes = F.transform(parts, lambda w: F.xxhash64(w))
        return F.struct(
            F.size(parts).cast("long").alias("n_words"),
            F.aggregate(parts, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
            bind(hashes, repeated_words).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        def entry(line: Column) -> Column:
            spaces = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
            return F.struct(F.xxhash64(line).alias("line"), (spaces + 1).alias("words"))

        def marked(sorted_lines: Column) -> Column:
            def mark(x: Column, i: Column) -> Column:
                again = F.coalesce(F.get(sorted_lines, i - 1)["line"] == x["line"], F.lit(False))
                return F.struct(x["line"].alias("line"), x["words"].alias("words"), F.when(again, 0).otherwise(1).alias("first"))

            return F.transform(sorted_lines, mark)

        return F.struct(
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            bind(F.sort_array(F.transform(F.transform(lines, normal_line), entry)), marked).alias("lines"),
        )

    return docs.withColumn(
        "facts",
        F.struct(
            F.coalesce(F.col(host), F.lit("")).alias("host"),
            *text_key(F.col(text)),
            bind(words(F.col(text)), of_words).alias("w"),
            (F.length(whole) - F.length(F.translate(whole, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
            bind(lines_with_words(F.col(text)), of_lines).alias("l"),
        ),
    )


def frequent_lines(texts: DataFrame, min_documents: int, max_percent: float) -> DataFrame:
    """(host, line) of the lines in more distinct documents of their host than both limits.

    ``texts`` has host and lines, a row for each distinct text of a host, so copies don't
    make their lines frequent. A text counts once for each line of its own. Counts are summed before
    they are shuffled, a host's documents too.
    """
    hosts = texts.groupBy("host").agg(F.count(F.lit(1)).alias("host_documents"))
    counts = texts.select("host", F.inline("lines")).groupBy("host", "line").agg(F.sum("first").alias("documents"))
    often = counts.where(F.col("documents") > min_documents)
    share = F.col("documents") * 100 > F.col("host_documents") * max_percent
    return often.join(hosts, "host").where(share).select("host", "line")


def judge(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    min_line_documents: int = MIN_LINE_DOCUMENTS,
    max_line_percent: float = MAX_LINE_PERCENT,
) -> DataFrame:
    """``docs`` without text and host, with the base counts, base_failed, words_left, removed and kept.

    removed holds the hashes of the text's lines that too many documents of its host share
    (null: none); words_left are the words outside them. A document is kept if it doesn't fail the
    base rules and min_words words are left: many frequent lines alone don't reject it.
    A text without a word has no lines; copies are judged alike. The text is read once;
    what it gave is stored, and all counts run over that.
    """
    clear = [c for c in docs.columns if c not in (text, host)]
    kept_columns = F.struct(*clear) if clear else F.struct(F.lit(1).alias("none"))
    named = docs.select(kept_columns.alias("row"), F.col(text).alias("text"), F.col(host).alias("source"))
    facts = text_facts(named).select("row", "facts.*")
    facts = facts.select("row", "host", *_TEXT_KEY, "w.*", "n_symbols", "l.*")
    facts = materialize(facts, "quality-facts")
    # One row for each text of a host, however many copies it has.
    texts = facts.groupBy("host", *_TEXT_KEY).agg(F.first("lines").alias("lines"))
    lines = texts.select("host", *_TEXT_KEY, F.inline("lines"))
    often = frequent_lines(texts, min_line_documents, max_line_percent)
    removed = (
        lines.join(often, ["host", "line"])
        .groupBy("host", *_TEXT_KEY)
        .agg(F.sum("words").alias("words_removed"), F.collect_set("line").alias("removed"))
    )
    repeats = 100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    base_failed = (F.col("n_words") < min_words) | repeats
    left = F.col("n_words") - F.coalesce("words_removed", F.lit(0))
    judged = facts.join(removed, ["host", *_TEXT_KEY], "left").select(
        "row",
        "host",
        *_TEXT_KEY,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        left.alias("words_left"),
        "removed",
        (~base_failed & (left >= min_words)).alias("kept"),
    )
    return judged


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", **limits) -> DataFrame:
    """The rows of ``docs`` that are kept, their texts without the frequent lines.

    All copies of a text in a host are kept or rejected together.
    """
    verdicts = judge(docs.select(F.col(text).alias("text"), F.col(host).alias("source")), **limits)
    verdicts = verdicts.where("kept").groupBy("host", *_TEXT_KEY).agg(F.first("removed"))
    keys = [F.coalesce(F.col(host), F.lit("")), *text_key(F.col(text))]
    names = [fresh(docs, n) for n in ("its_host", "its_key_1", "its_key_2")]
    others = [fresh(docs, n) for n in ("host_judged", "key_1_judged", "key_2_judged", "lines_removed")]
    keyed = docs.withColumns(dict(zip(names, keys)))
    verdicts = verdicts.toDF(*others)
    same = [F.col(mine) == F.col(other) for mine, other in zip(names, others)]
    removed = F.col(others[-1])
    good = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(removed, F.xxhash64(normal_line(x))))
    cleaned = F.when(removed.isNull(), F.col(text)).otherwise(F.array_join(good, "\n"))
    return keyed.join(verdicts, same).withColumn(text, cleaned).select(*docs.columns)
