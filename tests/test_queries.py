"""Every core query that has SQL gives DuckDB's rows; the others give rows."""

import pytest

from tests.compare import rows, views
from vocabmill.plans import graph, quality, relational, workflow

SF = "/root/testdata/sf0.001"
QUERIES = {**relational.QUERIES, **graph.QUERIES, **quality.QUERIES, **workflow.QUERIES}
ORACLES = {**relational.ORACLES, **graph.ORACLES, **quality.ORACLES, **workflow.ORACLES}


@pytest.fixture(scope="module")
def con():
    return views(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert rows(got.toPandas()) == rows(con.execute(ORACLES[name]).df())
    else:
        got.collect()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())


WHOLE = ["try_cast_parse", "shared_concept_pairs", "unit_pairs", "route_agreement", "salt_base", "single_group_chain", "mrcm_domain", "mrcm_range", "mrcm_grouping", "mrcm_cardinality", "mrcm_mandatory"]


@pytest.mark.parametrize("name", WHOLE)
def test_whole_tables(spark, name):
    """Queries that once read part of their tables, on tables that reach beyond it."""
    sf = "/root/testdata/sf0.01"
    assert rows(QUERIES[name](spark, sf).toPandas()) == rows(views(sf).execute(ORACLES[name]).df())
