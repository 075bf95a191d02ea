import glob
import os

import pytest
from frames import rows
from pyspark.sql import functions as F

from tally.operators import apply_updates
from tally.sources import CommitLog, Conflict, StoredTable


@pytest.fixture
def items(spark, tmp_path):
    df = spark.range(20_000).select("id", (F.col("id") % 7).alias("size"), F.concat(F.lit("n"), "id").alias("name"))
    return df, StoredTable.create(df, str(tmp_path / "items"), "id", 16)


def written(table, before):
    return set(table.files()) - set(before)


def test_only_touched_files_are_written(items):
    df, table = items
    before = table.files()
    assert len(before) == 16
    changes = df.filter(F.col("id").between(5000, 5019)).select("id", F.lit(-1).cast("long").alias("size"))
    done = table.update(changes, ["size"])
    assert done.rewritten <= 2 and done.kept == 16 - done.rewritten
    assert len(written(table, before)) == done.added <= 2
    assert rows(table.read()) == rows(apply_updates(df, changes, "id", ["size"]))
    assert rows(table.read(0)) == rows(df)
    # the files that were kept are the same files, and new ones stay narrow for the next update
    assert len(set(before) & set(table.files())) == done.kept
    assert table.update(changes.withColumn("size", F.lit(5).cast("long")), ["size"]).rewritten <= 2


def test_scattered_changes_with_null_and_unknown_keys(spark, items):
    df, table = items
    changes = spark.createDataFrame([(0, None), (19_999, 3), (77_777, 1), (None, 4), (-5, 6)], "id long, size long")
    done = table.update(changes, ["size"], limit=0)
    assert done.rewritten == 2
    assert rows(table.read()) == rows(apply_updates(df, changes, "id", ["size"]))


def test_changes_that_meet_nothing_make_no_version(spark, items):
    df, table = items
    files = table.files()
    for data in ([], [(None, 1)], [(20_001, 1)], [(-3, 1)]):
        done = table.update(spark.createDataFrame(data, "id long, size long"), ["size"])
        assert (done.version, done.rewritten) == (0, 0) and table.files() == files


def test_the_last_of_several_changes(spark, items):
    df, table = items
    changes = spark.createDataFrame([(9, 1, 1), (9, 5, 3), (9, 3, 2)], "id long, size long, seq int")
    with pytest.raises(Exception, match="more than one row"):
        table.update(changes, ["size"])
    assert table.version() == 0 and rows(table.read()) == rows(df)
    table.update(changes, ["size"], order=F.col("seq"))
    assert table.read().filter("id = 9").first().size == 5


def test_a_killed_run_leaves_the_old_table(monkeypatch, items):
    df, table = items
    changes = df.filter("id < 30").select("id", F.lit(0).cast("long").alias("size"))

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            table.update(changes, ["size"])
    again = StoredTable(table.spark, table.folder)
    assert again.version() == 0 and rows(again.read()) == rows(df)
    assert again.update(changes, ["size"]).version == 1
    files = lambda: glob.glob(f"{table.folder}/data/*/*.parquet")
    left = len(files())
    assert again.vacuum() == left - len(again.files()) > 0
    assert len(files()) == len(again.files())
    assert rows(again.read()) == rows(apply_updates(df, changes, "id", ["size"]))
    assert again.log.numbers() == [1]


def test_two_writers(monkeypatch, items):
    df, table = items
    other = StoredTable(table.spark, table.folder)
    changes = df.filter("id < 3").select("id", F.lit(8).cast("long").alias("size"))
    apart = table._write

    def meanwhile(*args):
        made = apart(*args)
        monkeypatch.undo()
        other.append(df.limit(1))
        return made

    monkeypatch.setattr(table, "_write", meanwhile)
    with pytest.raises(Conflict):
        table.update(changes, ["size"])
    assert table.version() == 1 and table.read().count() == 20_001
    assert not [f for f in os.listdir(f"{table.folder}/log") if f.startswith("tmp")]


def test_a_hot_key_is_split(spark, tmp_path):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    table = StoredTable.create(df, str(tmp_path / "hot"), "k", 12)
    sizes = table.read().groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 12 and max(r["count"] for r in sizes) < 2500
    table.update(spark.createDataFrame([(5, -1)], "k long, v long"), ["v"])
    assert table.read().filter("v = -1").count() == df.filter("k = 5").count()


def test_empty_and_appended_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "a string, b date")
    table = StoredTable.create(empty, str(tmp_path / "empty"), "a")
    assert table.read().count() == 0 and table.read().schema == empty.schema
    assert table.update(spark.createDataFrame([("x", None)], "a string, b date"), ["b"]).rewritten == 0
    table.append(spark.createDataFrame([("x", None), (None, None)], "a string, b date"))
    assert table.read().count() == 2 and table.read(0).count() == 0
    with pytest.raises(ValueError):
        StoredTable.create(empty, str(tmp_path / "empty"), "a")
    with pytest.raises(ValueError):
        StoredTable(spark, str(tmp_path / "nothing")).read()


def test_a_log_entry_is_published_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.numbers() == []
    log.publish(3, ["a", "é b"])
    log.publish(10, [])
    with pytest.raises(Conflict):
        log.publish(3, ["other"])
    assert log.numbers() == [3, 10] and log.read(3) == ["a", "é b"] and log.read(10) == []
