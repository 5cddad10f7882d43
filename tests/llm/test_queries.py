"""Registered text queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__
import corpus_pipeline
from oddsline.llm.queries import ORACLES, QUERIES
from tests.conftest import DATA
from tests.oracle import connect, differences

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "minhash_near_dedup", "benchmark_decontamination", "curriculum_mixing", "kd_tree_sharding"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == []
