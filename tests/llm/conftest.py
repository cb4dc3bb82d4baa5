import pytest


@pytest.fixture(scope="module", autouse=True)
def no_index_tables_left(spark):
    """Every module of tests begins without the digest indexes that others opened."""
    yield
    for table in spark.catalog.listTables():
        if table.name.startswith("digest_index_"):
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")
