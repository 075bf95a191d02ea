import os

import pytest
from booking import d, money
from frames import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally import workspace
from tally.schemas import TABLES, wide
from tally.sources import ParquetTables, append, import_dump, load, read_insert_dump, save, write_insert_dump

TEXT = """--INSERT TABLE [employees]

INSERT [dbo].[employees] ([employee_id], [first_name], [last_name], [birth_date], [gender]) VALUES (1, N'Ann', N'O''Hara', CAST(N'1990-02-03' AS Date), N'F')
GO
INSERT [dbo].[employees] ([employee_id], [last_name], [first_name]) VALUES (2, NULL, N'a, b) VALUES (3, ''x''')
GO
INSERT INTO employees (employee_id, first_name) VALUES (-3, '');
INSERT [dbo].[discounts] ([discount_id], [name], [percentage], [start_date], [end_date]) VALUES (1, N'Half ', CAST(0.50 AS Decimal(5, 2)), CAST(N'2021-01-01' AS Date), NULL)
GO
INSERT [dbo].[routes] ([route_id], [start_time]) VALUES (7, CAST(N'06:00:00' AS Time))

ALTER TABLE employees ADD CONSTRAINT fk FOREIGN KEY (employee_id) REFERENCES employees (employee_id);
"""


@pytest.fixture
def dump(tmp_path):
    path = tmp_path / "dump.sql"
    path.write_text(TEXT)
    return str(path)


def test_one_table_of_a_mixed_file(spark, dump):
    got = read_insert_dump(spark, dump, "employees", TABLES["employees"])
    assert [f.dataType for f in got.schema] == [f.dataType for f in TABLES["employees"]]
    assert rows(got.select("employee_id", "first_name", "last_name", "birth_date", "gender", "ssn")) == [
        (-3, "", None, None, None, None),
        (1, "Ann", "O'Hara", d("1990-02-03"), "F", None),
        (2, "a, b) VALUES (3, 'x'", None, None, None, None),
    ]


def test_decimals_dates_times_and_trailing_spaces(spark, dump):
    [rate] = read_insert_dump(spark, dump, "discounts", TABLES["discounts"]).collect()
    assert (rate.name, rate.percentage, rate.start_date, rate.end_date) == ("Half ", money("0.50"), d("2021-01-01"), None)
    [route] = read_insert_dump(spark, dump, "ROUTES", TABLES["routes"]).collect()
    assert (route.route_id, route.start_time) == (7, "06:00:00")


def test_a_broken_line_is_an_error(spark, tmp_path):
    path = tmp_path / "broken.sql"
    path.write_text("INSERT [dbo].[states] ([state_id], [name]) VALUES (1, N'cut off\n")
    with pytest.raises(Exception, match="cannot read INSERT line"):
        read_insert_dump(spark, str(path), "states", TABLES["states"]).collect()
    path.write_text("INSERT [dbo].[states] ([state_id], [name]) VALUES (1)\n")
    with pytest.raises(Exception, match="same length"):
        read_insert_dump(spark, str(path), "states", TABLES["states"]).collect()


def test_long_text_with_many_quotes(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("s", T.StringType())])
    text = "it's " * 4000 + "x" * 50_000
    write_insert_dump(spark.createDataFrame([(1, text), (2, None)], schema), str(tmp_path / "long"), "notes")
    assert rows(read_insert_dump(spark, str(tmp_path / "long"), "notes", schema)) == [(1, text), (2, None)]


def test_round_trip_of_every_type(spark, tmp_path):
    schema = TABLES["routes_cabin_types"]
    df = spark.createDataFrame([(1, 2, 3, money("-1.50"), d("2020-02-29"), None), (2, 2, 3, None, None, None)], schema)
    write_insert_dump(df, str(tmp_path / "prices"), "routes_cabin_types")
    assert rows(read_insert_dump(spark, str(tmp_path / "prices"), "routes_cabin_types", schema)) == rows(df)


def test_parquet_tables_read_only_the_asked_columns(spark, tmp_path):
    people = spark.createDataFrame([(1, "Ann"), (2, "Bo")], "city_state_id int, name string").selectExpr("*", "1 AS state_id")
    people.write.parquet(str(tmp_path / "cities_states.parquet"))
    tables = ParquetTables(spark, str(tmp_path))
    assert rows(tables("cities_states", "name")) == [("Ann",), ("Bo",)]
    plan = tables("cities_states", "name")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<name:string>" in plan
    assert load(spark, str(tmp_path), "cities_states").columns == ["city_state_id", "name", "state_id"]


def test_append_adds_rows(spark, tmp_path):
    df = spark.range(3)
    append(df, str(tmp_path / "t"))
    append(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6


def test_workspace_is_the_folder_the_session_names(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert workspace.shared_dir(spark) == folder
    path = workspace.fresh_path(spark, "x")
    assert path.startswith(folder) and path != workspace.fresh_path(spark, "x")
    assert rows(workspace.store(spark.range(2))) == [(0,), (1,)]
    assert os.path.isdir(folder)


def test_import_of_a_whole_dump(spark, dump, tmp_path):
    chosen = {name: TABLES[name] for name in ("employees", "discounts", "routes", "states")}
    import_dump(spark, dump, str(tmp_path / "db"), chosen)
    tables = ParquetTables(spark, str(tmp_path / "db"))
    assert {name: tables(name).count() for name in chosen} == {"employees": 3, "discounts": 1, "routes": 1, "states": 0}
    tables.register(*chosen)
    assert spark.sql("SELECT name FROM discounts").first()["name"] == "Half "


def test_saved_flights_are_laid_out_by_date(spark, tmp_path):
    days = spark.range(4000).selectExpr(
        "CAST(id AS INT) AS flight_id",
        "date_add(DATE'2016-01-01', CAST(id * 7919 % 1460 AS INT)) AS date",
        "'06:00:00' AS start_time_actual",
        "'07:00:00' AS end_time_actual",
        "1 AS route_id",
        "1 AS plane_id",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        save(days, str(tmp_path), "flights")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = ParquetTables(spark, str(tmp_path))("flights")
    spans = stored.groupBy(F.input_file_name()).agg(F.min("date").alias("lo"), F.max("date").alias("hi")).collect()
    ends = sorted((r.lo, r.hi) for r in spans)
    assert len(ends) > 4 and all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert rows(stored) == rows(days)


def test_wide_ids_read_both_widths(spark, tmp_path):
    big = 5_000_000_000
    narrow = spark.createDataFrame([(1, "Ann")], "cabin_type_id int, name string")
    narrow.write.parquet(str(tmp_path / "cabin_types.parquet"))
    spark.createDataFrame([(big, "Bo")], "payment_type_id long, name string").write.parquet(
        str(tmp_path / "payment_types.parquet")
    )
    tables = ParquetTables(spark, str(tmp_path), wide_ids=True)
    assert rows(tables("cabin_types")) == [(1, "Ann")]
    assert rows(tables("payment_types")) == [(big, "Bo")]
    assert dict(tables("cabin_types").dtypes) == {"cabin_type_id": "bigint", "name": "string"}
    assert wide(TABLES["planes"])["capacity"].dataType == T.IntegerType()


@pytest.mark.parametrize(
    "line",
    [
        "SET IDENTITY_INSERT t ON INSERT [dbo].[states] ([state_id], [name]) VALUES (2, N'x')",
        "INSERT [dbo].[states] ([state_id], [name]) VALUES (1, getdate())",
        "INSERT [dbo].[states] ([state_id], [name]) VALUES (1, getdate(), 'lost')",
        "INSERT [dbo].[states] ([state_id], [name]) VALUES (1, nothing)",
        "INSERT [dbo].[states] ([state_id], [name]) SELECT 1, 'x'",
    ],
)
def test_lines_that_are_not_literal_rows_are_errors(spark, tmp_path, line):
    path = tmp_path / "odd.sql"
    path.write_text(line + "\n")
    with pytest.raises(Exception, match="cannot read INSERT line"):
        read_insert_dump(spark, str(path), "states", TABLES["states"]).collect()


def test_comments_and_texts_that_mention_inserts(spark, tmp_path):
    path = tmp_path / "odd.sql"
    path.write_text(
        "/* seed */ INSERT [dbo].[states] ([state_id], [name]) VALUES (1, N'kept?')\n-- INSERT later\nPRINT 'INSERT INTO x'\n"
        "INSERT [dbo].[states] ([state_id], [name]) VALUES (2, N'-- INSERT (1)')\n"
    )
    got = read_insert_dump(spark, str(path), "states", TABLES["states"])
    assert rows(got.select("state_id", "name")) == [(1, "kept?"), (2, "-- INSERT (1)")]


def test_unknown_columns_are_errors(spark, tmp_path):
    path = tmp_path / "odd.sql"
    path.write_text("INSERT [dbo].[states] ([state_id], [motto]) VALUES (1, N'x')\n")
    with pytest.raises(Exception, match="no column motto"):
        read_insert_dump(spark, str(path), "states", TABLES["states"]).collect()


def test_timestamps_return_and_line_ends_are_refused(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ'2020-01-02 03:04:05' AS at, true AS ok, 'a''b' AS name")
    write_insert_dump(df, str(tmp_path / "dump"), "t")
    assert rows(read_insert_dump(spark, str(tmp_path / "dump"), "t", df.schema)) == rows(df)
    with pytest.raises(Exception, match="line end"):
        write_insert_dump(spark.sql("SELECT 'a\\nb' AS name"), str(tmp_path / "broken"), "t")
