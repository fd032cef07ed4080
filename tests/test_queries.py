"""Every registered query of the record operators against its SQL."""

import pytest

from eventlake.plans import curation, lookup_queries, normalize_queries, reshape_queries, rule_queries, source_queries, time_queries  # noqa: F401
from eventlake.plans.registry import QUERIES, SQL

from .compare import same


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    same(spark, QUERIES[name], SQL[name])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
