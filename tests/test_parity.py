"""Every registered query that has an SQL counterpart, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_module
from coldspring.checks import parity

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_every_query_equals_its_sql(spark):
    sql = entry_module.oracle_sql()
    queries = entry_module.queries()
    assert set(sql) <= set(queries)
    wrong = {name: verdict for name, verdict in parity.compare(spark, FOLDER, queries, sql, sorted(sql)).items() if verdict}
    assert not wrong


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
