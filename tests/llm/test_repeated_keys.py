"""Near-duplicate classes whose rows share a key with rows of other classes."""

import random
from collections import Counter

from martlight.llm import simhash
from tests.llm.tables import documents, sentence


def repeated_rows():
    rng = random.Random(2)
    first, second, third = (sentence(rng, 80) for _ in range(3))
    return [(5, first, "s"), (5, second, "s"), (7, first, "s"), (8, second, "s"), (3, third, "s"), (5, third, "s"), (5, first, "s")]


def test_repeated_key_keeps_every_class(spark):
    rows = repeated_rows()
    kept = simhash.drop_near_duplicates(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([rows[0][:2], rows[1][:2], rows[4][:2]])
