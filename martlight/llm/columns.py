"""Column expressions shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ASCII white space that ends a word, and the ASCII capitals.
SPACES = r"\x20\x09-\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# The same for bytes of UTF-8, which keep every other letter as it is.
LOWER_BYTES = bytes(range(65)) + LOWER.encode() + bytes(range(91, 256))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body reads it.

    The optimizer may copy a column's expression into the lambda that uses it, where it
    would run once per element; a lambda variable is never copied.
    """
    return F.get(F.transform(F.array(value), lambda x: body(x)), 0)


# Elements that one block of a long array holds.
BLOCK = 256


def in_blocks(items: Column, size: int) -> Column:
    """The array cut into arrays of ``size`` elements, the last one shorter; none for an empty array."""
    last = F.greatest(F.floor((F.size(items) - 1) / size).cast("int"), F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * size + 1, size))
    return F.filter(cut, lambda block: F.size(block) > 0)


def running(values: Column, zero: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each element of an array what the associative ``add`` makes of all elements before it.

    Appending copies an array, so prefixes are made within blocks, then for the blocks: an array of n elements
    costs n blocks of copies, not n arrays.
    """
    empty = F.slice(F.array(zero), 1, 0)

    def prefixes(items: Column, value: Callable[[Column], Column]) -> Column:
        return F.aggregate(
            items,
            F.struct(empty.alias("before"), zero.alias("total")),
            lambda state, x: F.struct(
                F.array_append(state["before"], state["total"]).alias("before"),
                add(state["total"], value(x)).alias("total"),
            ),
        )

    def joined(inside: Column) -> Column:
        starts = prefixes(inside, lambda block: block["total"])["before"]
        return F.flatten(
            F.zip_with(inside, starts, lambda block, s: F.transform(block["before"], lambda x: add(s, x)))
        )

    inside = lambda items: F.transform(in_blocks(items, BLOCK), lambda block: prefixes(block, lambda x: x))
    return bind(values, lambda items: bind(inside(items), joined))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text, none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+"), "")


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a whole text, as two longs; a null has the key of an empty text."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("text_key_1"), F.xxhash64(F.lit(1), whole).alias("text_key_2")]


def fresh(rows: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``rows`` has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name
