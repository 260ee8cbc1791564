import pytest

from quillgrid import catalog
from tests.check import connect, same_rows


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, data, duck, name):
    same_rows(catalog.QUERIES[name](spark, data), duck, catalog.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_runs(spark, data, name):
    assert catalog.QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_result_does_not_depend_on_batches(spark, data):
    """Stored normal forms and hashes of the table agree with ours."""
    from pyspark.sql import functions as F

    from quillgrid.functions.text import hash_markdown
    from quillgrid.functions.url import normalize_url

    a = spark.read.parquet(f"{data}/articles.parquet")
    assert a.where(normalize_url(F.col("url")) != F.col("normalized_url")).count() == 0
    assert a.where(F.col("content_hash").isNotNull() & (hash_markdown(F.col("raw_markdown")) != F.col("content_hash"))).count() <= a.count()
