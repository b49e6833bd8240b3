from __future__ import annotations

import os
import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import check_oracle  # noqa: E402
import corpus_pipeline  # noqa: E402
from sievewell.llm import queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_agrees_with_its_sql(spark, name):
    assert check_oracle.compare(spark, check_oracle.duck(SF_DIR), SF_DIR, name) is None


def test_the_pipeline_keeps_what_its_stages_leave(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before, left = docs.columns, docs.count(), []
    for name, stage in corpus_pipeline.STAGES:
        docs = docs.sparkSession.createDataFrame(stage(spark, docs, SF_DIR).toArrow())
        left.append((name, docs.count()))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert before >= left[0][1] > left[1][1] > left[2][1] == left[3][1] >= left[4][1] > 0.8 * left[3][1]
    assert corpus_pipeline.run(spark, SF_DIR).count() == left[-1][1]
    assert docs.where(r"text rlike '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\\.[A-Za-z0-9-]+'").count() == 0
