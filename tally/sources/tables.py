"""Reading declared tables and appending to stored ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tally.schemas import CLUSTER_BY, PRIMARY_KEYS, TABLES, wide


def load(spark: SparkSession, directory: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A table by name, with its declared schema: no inference job, no footer merging."""
    return spark.read.schema(schema or TABLES[name]).parquet(f"{directory}/{name}.parquet")


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def save(df: DataFrame, directory: str, name: str, mode: str = "errorifexists", files: int | None = None) -> None:
    """Store a declared table; one with a date is laid out along it, in ``files`` ranges.

    Without ``files`` there are ``spark.sql.shuffle.partitions`` of them at most, merged by adaptive
    execution to its advisory size.

    Files then cover narrow date ranges, and the year filters of the reports skip whole files
    and row groups.  The key is part of the range, so a day with very many rows is split.
    Not bucketed by flight: a single hot flight would make one bucket a share of the table.
    """
    laid_out = df
    if name in CLUSTER_BY:
        order = [CLUSTER_BY[name], *PRIMARY_KEYS[name]]
        ranged = df.repartitionByRange(*order) if files is None else df.repartitionByRange(files, *order)
        laid_out = ranged.sortWithinPartitions(*order)
    laid_out.write.mode(mode).parquet(f"{directory}/{name}.parquet")


class ParquetTables:
    """``tables("tickets", "flight_id", "final_price")``: only the named columns are read.

    ``wide_ids`` reads ids as bigint, which more than two billion tickets need.
    """

    def __init__(self, spark: SparkSession, directory: str, wide_ids: bool = False):
        self.spark = spark
        self.directory = directory
        self.wide_ids = wide_ids

    def __call__(self, name: str, *columns: str) -> DataFrame:
        schema = wide(TABLES[name]) if self.wide_ids else TABLES[name]
        table = load(self.spark, self.directory, name, schema)
        return table.select(*columns) if columns else table

    def register(self, *names: str) -> None:
        """Make tables (all by default) known to ``spark.sql`` under their own names."""
        for name in names or TABLES:
            self(name).createOrReplaceTempView(name)
