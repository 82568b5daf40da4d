"""The queries that have an oracle, and what every registered query promises."""

import pytest

import __spark_entry__ as E
from newsarc.llm.oracle import ORACLE
from newsarc.llm.queries import QUERIES
from newsarc.plans.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF), duck(SF), ORACLE[name])
    assert ok, msg


def test_one_query_per_operator_and_the_pipeline_are_registered():
    names = E.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names
