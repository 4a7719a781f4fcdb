"""Plan-shape checks over every registered query (sf0.001)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

Q = E.queries()
SKIP = {"pack_stream"}   # runs a streaming query on construction; checked in test_streaming


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(Q) - SKIP))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(Q[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["chunk_counts", "pretokenize_docs", "chunk_stats_by_lang", "pair_counts",
                                  "sentences", "qa_pairs", "validate_chat", "pack_blocks", "bits_per_byte"])
def test_hot_paths_stay_in_the_jvm(spark, name):
    plan = _plan(Q[name](spark, SF_SMALL))
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_flagship_prunes_columns(spark):
    plan = _plan(E.entry(spark))
    assert "ReadSchema: struct<text:string,lang:string>" in plan or \
        "ReadSchema: struct<lang:string,text:string>" in plan
