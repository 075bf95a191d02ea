"""Rows kept as ``INSERT ... VALUES`` lines, read and written as a distributed text job.

One statement per line.  Anything else in the file (separators, comments, other tables)
is passed over, so several tables may share a file.  A line with an INSERT anywhere outside
literals and comments is read or is an error, never a lost row: also one behind another statement,
one with values that are not literals, and one with columns that the schema does not have.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.workspace import fresh_path

_QUOTED = r"N?'[^']*+(?:''[^']*+)*+'"
_BARE = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:E[-+]?\d+)?|0x[0-9A-F]*|NULL|TRUE|FALSE"
_LITERAL = rf"CAST\(\s*(?:{_QUOTED}|{_BARE})\s+AS\s+\w+\s*(?:\([\d\s,]*\))?\s*\)|{_QUOTED}|(?:{_BARE})(?=[\s,]|$)"
_ROW = rf"(?i)^\s*(?:{_LITERAL})(?:\s*,\s*(?:{_LITERAL}))*+\s*$"
_HEAD = (
    r"(?i)^\s*(?:/\*.*?\*/\s*)*INSERT\s+(?:INTO\s+)?(?:\[?\w+\]?\.)?\[?(\w+)\]?\s*\(([^)]*)\)\s*"
    r"VALUES\s*\((.*)\)\s*;?\s*$"
)
_HIDDEN = rf"{_QUOTED}|/\*.*?\*/|--.*$"


def _value(token: Column) -> Column:
    """The text inside a literal: CAST and quotes removed, NULL as NULL."""
    inner = F.regexp_extract(token, r"(?is)^CAST\(\s*(.*?)\s+AS\s+[^']*\)$", 1)
    bare = F.when(inner != "", inner).otherwise(token)
    quoted = F.regexp_extract(bare, r"(?s)^N?'(.*)'$", 1)
    return (
        F.when(bare.rlike(r"(?s)^N?'.*'$"), F.replace(quoted, F.lit("''"), F.lit("'")))
        .when(F.upper(bare) == "NULL", F.lit(None))
        .otherwise(bare)
    )


def _typed(text: Column, kind: T.DataType) -> Column:
    return text if isinstance(kind, T.StringType) else text.cast(kind)


def _statements(spark: SparkSession, path: str) -> DataFrame:
    """(table, column -> text) of every INSERT line."""
    line = F.col("value")
    table = F.lower(F.regexp_extract(line, _HEAD, 1))
    values = F.regexp_extract(line, _HEAD, 3)
    unreadable = F.raise_error(F.concat(F.lit("cannot read INSERT line: "), F.substring(line, 1, 200)))
    return (
        spark.read.text(path)
        .filter(F.regexp_replace(line, _HIDDEN, " ").rlike(r"(?i)\bINSERT\b"))
        .select(
            F.when((table != "") & values.rlike(_ROW), table).otherwise(unreadable).alias("table"),
            F.transform(
                F.split(F.regexp_extract(line, _HEAD, 2), ","),
                lambda name: F.lower(F.regexp_replace(name, r"[\[\]\s]", "")),
            ).alias("names"),
            F.transform(F.regexp_extract_all(values, F.lit(f"(?i)({_LITERAL})"), F.lit(1)), _value).alias("texts"),
        )
        .select("table", F.map_from_arrays("names", "texts").alias("row"))
    )


def _rows(statements: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    known = F.array(*[F.lit(field.name.lower()) for field in schema])
    unknown = F.array_except(F.map_keys("row"), known)
    refused = F.raise_error(F.concat(F.lit(f"{table} has no column "), F.array_join(unknown, ", ")))
    own = statements.filter(F.col("table") == table.lower())
    return own.filter(F.when(F.size(unknown) > 0, refused.cast("boolean")).otherwise(True)).select(
        *[
            _typed(F.try_element_at("row", F.lit(field.name.lower())), field.dataType).alias(field.name)
            for field in schema
        ]
    )


def read_insert_dump(spark: SparkSession, path: str, table: str, schema: T.StructType) -> DataFrame:
    """Rows of ``table``; columns are matched by the statement's own column list."""
    return _rows(_statements(spark, path), table, schema)


def import_dump(spark: SparkSession, path: str, directory: str, schemas: Mapping[str, T.StructType]) -> None:
    """All tables of a dump to ``directory/<table>.parquet``; tables without rows come out empty.

    The text is taken apart once, into a table partitioned by name; each output reads its part.
    """
    staged = fresh_path(spark, "dump")
    _statements(spark, path).write.partitionBy("table").parquet(staged)
    parts = spark.read.schema("row map<string,string>, table string").parquet(staged)
    for table, schema in schemas.items():
        _rows(parts, table, schema).write.mode("overwrite").parquet(f"{directory}/{table}.parquet")


def _literal(field: T.StructField) -> Column:
    text = F.col(f"`{field.name}`").cast("string")
    quoted = F.concat(F.lit("N'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
    kind = field.dataType
    if isinstance(kind, T.StringType):
        broken = F.raise_error(F.lit(f"{field.name}: a line end cannot be kept in an INSERT line"))
        written = F.when(text.rlike(r"[\r\n\u0085\u2028\u2029]"), broken).otherwise(quoted)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        written = F.concat(F.lit("CAST("), quoted, F.lit(" AS DateTime)"))
    elif isinstance(kind, T.DateType):
        written = F.concat(F.lit("CAST("), quoted, F.lit(" AS Date)"))
    elif isinstance(kind, T.DecimalType):
        written = F.concat(F.lit("CAST("), text, F.lit(f" AS Decimal({kind.precision}, {kind.scale}))"))
    else:
        written = text
    return F.coalesce(written, F.lit("NULL"))


def write_insert_dump(df: DataFrame, path: str, table: str) -> None:
    """The reverse of :func:`read_insert_dump`, one line per row."""
    names = ", ".join(f"[{field.name}]" for field in df.schema)
    values = F.concat_ws(", ", *[_literal(field) for field in df.schema])
    df.select(F.concat(F.lit(f"INSERT [dbo].[{table}] ({names}) VALUES ("), values, F.lit(")"))).write.text(path)
