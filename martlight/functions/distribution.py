"""Salting: spread one hot join key over several tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted(left: DataFrame, right: DataFrame, spread_by: str | Column, salts: int) -> tuple[DataFrame, DataFrame]:
    """Add a ``_salt`` join key so that one hot key spreads over ``salts`` tasks.

    Left rows draw their salt from ``spread_by``; each right row is repeated
    once per salt, so every pair still meets exactly once.
    """
    return (
        left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")),
        right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))),
    )
