"""What the pipeline leaves in the shared folder."""

from pathlib import Path

import corpus_pipeline
from martlight.session import shared_dir
from tests.llm.tables import BENCHMARK, documents, document_rows


def test_run_leaves_only_what_its_result_reads(spark, tmp_path):
    rows = [r for r in document_rows() if len(r[1] or "") < 10_000]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, rows[0][1])], BENCHMARK).write.parquet(f"{tmp_path}/benchmark.parquet")
    base = Path(shared_dir(spark, "x")).parent
    before = set(base.glob("*")) if base.exists() else set()
    result = corpus_pipeline.run(spark, str(tmp_path))
    left = {p.name.rpartition("-")[0] for p in set(base.glob("*")) - before}
    assert left == {"pipeline-secret_scans", "pieces"}
    assert result.count() > 0
