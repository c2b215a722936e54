"""Corpus queries next to their SQL, and what the driver's entry registers."""

import re

import pytest

import __spark_entry__ as entry_module
from tests.compare import differences, tables
from tickloom.llm.oracle import ORACLE
from tickloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    con = tables(sf_dir)
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(ORACLE[name]).df()
    nullable = {c: "Int64" for c in want if str(want[c].dtype) == "Int64"}  # longs with NULLs
    assert differences(got.astype(nullable), want) is None
    con.close()


def test_entry_registers_one_query_per_operator():
    names = [n for n in entry_module.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 1 + len(names))) and len(names) >= 11
    assert "pipeline" in entry_module.queries() and set(ORACLE) <= set(entry_module.oracle_sql())
