import duckdb
import pytest
from pyspark.sql import SparkSession

DOC = "doc_id long, text string, lang string, source string, n_chars long"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def documents(spark: SparkSession):
    """A DataFrame of (doc_id, text, lang, source) rows."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC)

    return make


@pytest.fixture(scope="session")
def duck(small_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small_dir}/{name}.parquet'")
    return con
