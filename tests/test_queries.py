"""Every registered query against its DuckDB twin; those without one must run and give rows."""

import pytest
from compare import compare

import __spark_entry__ as entry

QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_runs_and_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(CHECKS)))
def test_matches_duckdb(spark, sf_dir, name):
    n, problems = compare(spark, sf_dir, QUERIES[name], CHECKS[name])
    assert not problems, problems


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


def test_entry_gives_the_worklist(spark):
    top = entry.entry(spark)
    assert top.columns[0] == "outreach_priority"
    assert 0 < top.count() <= 30
