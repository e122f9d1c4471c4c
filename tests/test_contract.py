"""Registered queries against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.compare import difference, duck

SF_DIR = "/root/testdata/sf0.001"
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(contract.queries())


@pytest.mark.parametrize("name", contract.queries())
def test_query(spark, con, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    assert len(got) > 0 or name.startswith(("min_df", "posting"))
    if name in ORACLE:
        assert difference(got, con.execute(ORACLE[name]).df()) is None


@pytest.mark.parametrize("name", ["search_anchor", "search_anchor_source", "search_anchor_stored"])
def test_every_page_asks_for_links(spark, tmp_path, name):
    """The title of each page is a query, whatever its id."""
    page = '<title>{0}</title><a href="/{1}">{1} link</a>'
    rows = [(i, page.format(word, word)) for i, word in enumerate(["alphas", "betas", "gammas", "deltas"], 48)]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/written")
    next(tmp_path.glob("written/*.parquet")).rename(tmp_path / "pages.parquet")
    got = contract.queries()[name](spark, str(tmp_path)).toPandas()
    assert sorted(got.query_id) == [48, 49, 50, 51]
    assert difference(got, duck(str(tmp_path)).execute(ORACLE[name]).df()) is None
