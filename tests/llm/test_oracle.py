"""The corpus queries that SQL can express against their twins."""

import pytest

from rosterlake.llm.queries import ORACLE, QUERIES
from workloads import compare

SMALL = "/root/testdata/sf0.001"
ROWS = {"op12_embedding_whitening": 8, "op13_multi_index": 5}  # rows of one id
SEVERAL = {"op8_benchmark_leaks", *ROWS}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLE", ORACLE)
    ok, note, _ = compare.compare(spark, compare.connect(SMALL), name, SMALL)
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, name):
    frame = QUERIES[name](spark, SMALL)
    ids = [r[frame.columns[0]] for r in frame.collect()]
    per_id = ROWS.get(name, 1)
    assert ids and (name == "op8_benchmark_leaks" or len(ids) == per_id * len(set(ids)))
    assert name in SEVERAL or len(ids) == 200
