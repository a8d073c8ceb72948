import pytest


@pytest.fixture
def sf(spark, tmp_path):
    """Writes tables given as lists of tuples; returns their folder."""

    def make(**tables):
        for name, (rows, ddl) in tables.items():
            spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make
