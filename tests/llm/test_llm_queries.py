import pytest

from barframe.llm.oracles import ORACLES
from barframe.llm.queries import QUERIES
from suite.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
