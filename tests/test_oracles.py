"""Every core query with SQL against that SQL, and the others for whether they run."""

import pytest

from millrace.plans import catalog
from tests.oracle import compare, views

SF = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return views(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, connection, name):
    df = catalog.queries()[name](spark, SF)
    assert (compare(df, connection, SQL[name]) if name in SQL else df.count() < 0 or None) is None


def test_shuffled_input_gives_the_same(spark, connection, monkeypatch):
    """Nothing depends on the order or partitioning of the rows that are read."""
    from millrace import tables
    from millrace.plans import articles, selection

    for module in (articles, selection):
        monkeypatch.setattr(module, "table", lambda s, d, n: tables.table(s, d, n).repartition(5).orderBy("source_id" if n == "collected_item" else tables.table(s, d, n).columns[-1]))
    for name in ("exact_duplicates", "newest_per_source", "keyword_hits", "audit_targets", "digest_lines", "story_heads", "state_after"):
        assert compare(catalog.queries()[name](spark, SF), connection, SQL[name]) is None
