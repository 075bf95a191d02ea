import datetime
from decimal import Decimal

import pytest
from booking import d
from frames import rows
from pyspark.sql import functions as F

from tally.operators.changes import apply_updates, audit_changes, audit_pairs
from tally.operators.quality import clamp_to_reference
from tally.sources import CommitLog
from tally.streaming import audit_stream, read_batches, validate_stream, violations_stream

AT = datetime.datetime(2021, 5, 6, 7, 8, 9)
SCHEMA = "plane_id int, brand string, capacity int, seq int, gone boolean"
COLUMNS = ["plane_id", "brand", "capacity"]
STAMP = ("planes", "clerk", "desk")


@pytest.fixture
def feed(spark, tmp_path):
    """A change folder; each call adds one file, read one file per batch."""

    def add(*changes):
        spark.createDataFrame(changes, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))

    def read():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "feed"))

    return add, read


def audited(spark, folder, read, current, **options):
    audit_stream(
        read(), current, "plane_id", COLUMNS, f"{folder}/log", f"{folder}/cp", *STAMP, at=AT, **options
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/log").drop("batch_id")


def test_one_batch_equals_the_batch_audit(spark, tmp_path, feed):
    add, read = feed
    add((2, "B2", 16, 1, False), (3, None, None, 1, True), (4, "D", 8, 1, False))
    before = spark.createDataFrame([(1, "A", 16), (2, "B", 16), (3, "C", 16)], "plane_id int, brand string, capacity int")
    after = spark.createDataFrame([(1, "A", 16), (2, "B2", 16), (4, "D", 8)], "plane_id int, brand string, capacity int")
    got = audited(spark, tmp_path, read, before, deleted=F.col("gone"))
    assert rows(got) == rows(audit_changes(before, after, "plane_id", COLUMNS, *STAMP, AT))


def test_last_change_of_a_key_counts(spark, tmp_path, feed):
    add, read = feed
    add((1, "x", 1, 1, False), (1, "z", 3, 3, False), (1, "y", 2, 2, False))
    before = spark.createDataFrame([(1, "A", 3)], "plane_id int, brand string, capacity int")
    got = audited(spark, tmp_path, read, before, order=F.col("seq"))
    assert rows(got.select("aud_column", "aud_before", "aud_after")) == [("brand", "A", "z")]


def test_batches_see_the_state_before_them_and_reruns_add_nothing(spark, tmp_path, feed):
    add, read = feed
    start = spark.createDataFrame([(1, "A", 1)], "plane_id int, brand string, capacity int")
    step = spark.createDataFrame([(1, "B", 1)], "plane_id int, brand string, capacity int")
    states = [start, apply_updates(start, step, "plane_id", ["brand"])]
    add((1, "B", 1, 1, False))
    audited(spark, tmp_path, read, lambda batch: states[batch])
    add((1, "C", 1, 2, False))
    got = audited(spark, tmp_path, read, lambda batch: states[batch])
    assert rows(got.select("aud_id", "aud_before", "aud_after")) == [
        ("0:planes:1:brand", "A", "B"),
        ("1:planes:1:brand", "B", "C"),
    ]
    again = audited(spark, tmp_path, read, lambda batch: states[batch])
    assert again.count() == 2


def test_feed_of_both_images(spark, tmp_path):
    """Several changes of one key stay apart by their sequence; no join, no state."""
    image = "struct<plane_id:int,brand:string>"
    feed = spark.createDataFrame(
        [(1, 1, None, (1, "A")), (2, 1, (1, "A"), (1, "B")), (3, 1, (1, "B"), (1, "B")), (4, 1, (1, "B"), None)],
        f"seq int, plane_id int, before {image}, after {image}",
    )
    feed.write.parquet(str(tmp_path / "pairs"))
    stream = spark.readStream.schema(feed.schema).parquet(str(tmp_path / "pairs"))
    log = audit_pairs(stream, "plane_id", ["plane_id", "brand"], *STAMP, AT, F.col("seq"))
    writer = log.writeStream.format("parquet").option("path", str(tmp_path / "log"))
    writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "log")).select("aud_id", "aud_operation", "aud_before", "aud_after")
    assert rows(got) == [
        ("1:planes:1:brand", "INSERT", None, "A"),
        ("1:planes:1:plane_id", "INSERT", None, "1"),
        ("2:planes:1:brand", "UPDATE", "A", "B"),
        ("4:planes:1:brand", "DELETE", "B", None),
        ("4:planes:1:plane_id", "DELETE", "1", None),
    ]


def test_validate_stream(spark, tmp_path):
    asked = spark.createDataFrame([(1, 1, Decimal("79.99")), (2, 1, Decimal("110.00"))], "id int, k int, price decimal(10,2)")
    asked.write.parquet(str(tmp_path / "asked"))
    listed = spark.createDataFrame([(1, Decimal("100.00"))], "k int, list_price decimal(10,2)")

    def rule(batch):
        return clamp_to_reference(batch, listed, ["k"], "price", "list_price").select("id", "validated")

    stream = spark.readStream.schema(asked.schema).parquet(str(tmp_path / "asked"))
    validate_stream(stream, rule, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("id", "validated")
    assert rows(got) == [(1, Decimal("100.00")), (2, Decimal("110.00"))]


def test_violations_stream(spark, tmp_path):
    days = spark.createDataFrame([(d("2015-12-31"),), (d("2016-01-01"),), (d("2020-01-01"),), (None,)], "date date")
    days.write.parquet(str(tmp_path / "days"))
    stream = spark.readStream.schema(days.schema).parquet(str(tmp_path / "days"))
    bad = violations_stream(stream, "date", d("2016-01-01"), d("2019-12-31"))
    query = (
        bad.writeStream.format("parquet")
        .option("path", str(tmp_path / "bad"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "bad"))) == [(d("2015-12-31"),), (d("2020-01-01"),)]
    seen = [p["observedMetrics"]["checked"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(m["total_rows"] for m in seen) == 4 and sum(m["errors"] for m in seen) == 2


def test_a_missing_mark_is_no_deletion(spark, tmp_path, feed):
    add, read = feed
    add((1, "a2", 1, 1, None))
    before = spark.createDataFrame([(1, "a", 1)], "plane_id int, brand string, capacity int")
    got = audited(spark, tmp_path, read, before, deleted=F.col("gone"))
    assert rows(got.select("aud_operation", "aud_column", "aud_after")) == [("UPDATE", "brand", "a2")]


def test_the_key_need_not_be_audited(spark, tmp_path, feed):
    add, read = feed
    add((1, "b", 1, 1, False))
    before = spark.createDataFrame([(1, "a", 1)], "plane_id int, brand string, capacity int")
    audit_stream(read(), before, "plane_id", ["brand"], f"{tmp_path}/log", f"{tmp_path}/cp", *STAMP, at=AT).awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/log").select("aud_column", "aud_before")) == [("brand", "a")]


def test_a_plain_table_serves_one_batch(spark, tmp_path, feed):
    add, read = feed
    before = spark.createDataFrame([(1, "a", 1)], "plane_id int, brand string, capacity int")
    add((1, "a2", 1, 1, False))
    audited(spark, tmp_path, read, before)
    add((1, "a3", 1, 2, False))
    with pytest.raises(Exception, match="second batch"):
        audited(spark, tmp_path, read, before)
    with pytest.raises(ValueError, match="time stamp"):
        audit_stream(read(), before, "plane_id", COLUMNS, "x", "y", *STAMP)


def test_a_batch_is_seen_whole_or_not_at_all(spark, tmp_path, feed, monkeypatch):
    add, read = feed
    add((1, "A", 1, 1, False))
    sink = f"{tmp_path}/log"
    run = lambda: validate_stream(read(), lambda b: b, sink, f"{tmp_path}/cp", published=True).awaitTermination()
    run()
    add((2, "B", 2, 1, False), (3, "C", 3, 1, False))
    publish = CommitLog.publish

    def killed(self, number, lines):
        assert spark.read.parquet(f"{sink}/data/{lines[0]}").count() == 2  # written, not entered
        raise RuntimeError("killed")

    monkeypatch.setattr(CommitLog, "publish", killed)
    with pytest.raises(Exception, match="killed"):
        run()
    assert rows(read_batches(spark, sink).select("plane_id", "batch_id")) == [(1, 0)]

    def entered_then_killed(self, number, lines):
        publish(self, number, lines)
        raise RuntimeError("killed later")

    monkeypatch.setattr(CommitLog, "publish", entered_then_killed)
    with pytest.raises(Exception, match="killed later"):
        run()
    monkeypatch.undo()
    run()  # the batch is entered already and not written again
    assert rows(read_batches(spark, sink).select("plane_id", "batch_id")) == [(1, 0), (2, 1), (3, 1)]


def test_a_sink_without_batches(spark, tmp_path):
    with pytest.raises(ValueError):
        read_batches(spark, str(tmp_path / "none"))
