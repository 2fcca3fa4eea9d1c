"""The retail queries stand without the libraries that only the training-data package needs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
sys.modules[{hidden!r}] = None
import __spark_entry__
names = set(__spark_entry__.queries())
assert names >= {{"category_sales_share", "ledger_load"}} and set(__spark_entry__.oracle_sql()) <= names
assert not any(n[:2] == "op" and n[2].isdigit() for n in names)
"""


@pytest.mark.parametrize("hidden", ["zstandard", "tiktoken", "martlight.llm", "corpus_pipeline"])
def test_retail_queries_stand_alone(hidden):
    subprocess.run([sys.executable, "-c", SCRIPT.format(hidden=hidden)], cwd=ROOT, check=True, timeout=120)
