"""Folders of intermediate tables."""

from pathlib import Path

import pytest

from martlight.session import materialize, scratch_tables, shared_dir, store


def test_scratch_tables_leave_nothing(spark):
    base = Path(shared_dir(spark, "x")).parent
    before = set(base.glob("*")) if base.exists() else set()
    with scratch_tables(spark):
        first = materialize(spark.range(5), "first")
        with scratch_tables(spark):
            assert store(spark.range(3), "second")[0].count() == 3
        assert first.count() == 5 and materialize(spark.range(2), "third").count() == 2
    with pytest.raises(RuntimeError), scratch_tables(spark):
        materialize(spark.range(5), "fourth")
        raise RuntimeError
    assert set(base.glob("*")) == before
    kept = materialize(spark.range(4), "kept")
    assert kept.count() == 4 and len(set(base.glob("*")) - before) == 1
