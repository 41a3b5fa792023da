"""Every operator has one query; SQL gives the rows of those that SQL can express."""
import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator_and_the_pipeline():
    names = entry.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if re.match(r"op\d+_", n)) == list(range(1, 14))
    assert "pipeline" in names


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_sql_gives_the_same_rows(spark, name):
    ok, message = compare(spark, duck(SF), entry.queries(), entry.oracle_sql(), name, SF)
    assert ok, message
