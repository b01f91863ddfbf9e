"""Every query with SQL gives the rows DuckDB gives."""

import os

import pytest

from suite.check import compare, connect
from suite.oracles import ORACLES
from suite.queries import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
MORE_ROWS = {"trend_model_facts", "trend_job_outbox"}  # the guard of a training run asks for 500 complete rows


def folder(name):
    return "/root/testdata/sf0.01" if name in MORE_ROWS else SF


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert compare(QUERIES[name](spark, folder(name)), connect(folder(name)), ORACLES[name]) is None
