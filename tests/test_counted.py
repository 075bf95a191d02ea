"""Counts that follow a changing table, and reports on them."""

import pytest
from booking import HandMade, d
from frames import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.plans.counted import BOARDED, CountedTables, TicketCounts, count_stream
from tally.plans.reports import REPORTS
from tally.sources import KeptCounts
from tally.sources.commits import Conflict

TICKETS = "ticket_id long, flight_id long, customer_id long, boarding_date date"
FLIGHTS = "flight_id long"


def ticket(number, flight, customer, day="2016-05-01"):
    return number, flight, customer, d(day) if day else None


def made(spark, data):
    return spark.createDataFrame(data, TICKETS)


@pytest.fixture
def flights(spark):
    return spark.createDataFrame([(i,) for i in range(1, 6)], FLIGHTS)


FIRST = [ticket(i, 1, i % 3) for i in range(40)] + [ticket(50, 2, None), ticket(51, None, 1), ticket(52, 9, 1), ticket(53, 2, 2, None)]
GONE = [ticket(i, 1, i % 3) for i in range(0, 40, 2)] + [ticket(50, 2, None)]
LATER = [ticket(60, 3, 7, "2017-01-01"), ticket(61, 2, 2)]


def by_hand(spark, data, flights):
    sold = made(spark, data).withColumn(BOARDED, F.year("boarding_date"))
    known = sold.filter("customer_id IS NOT NULL").join(flights, "flight_id", "left_semi")
    return rows(sold.groupBy("flight_id", BOARDED).count()), rows(known.groupBy("customer_id", BOARDED).count())


def held(counts):
    return rows(counts.flights.read()), rows(counts.customers.read())


def test_two_batches_and_a_replay(spark, tmp_path, flights):
    counts = TicketCounts(spark, str(tmp_path))
    assert counts.apply(0, flights, made(spark, FIRST)) and held(counts) == by_hand(spark, FIRST, flights)
    assert counts.apply(1, flights, made(spark, LATER), made(spark, GONE))
    left = [t for t in FIRST if t not in GONE] + LATER
    assert held(counts) == by_hand(spark, left, flights)
    assert not counts.apply(1, flights, made(spark, LATER), made(spark, GONE)) and not counts.apply(0, flights, made(spark, FIRST))
    assert held(counts) == by_hand(spark, left, flights)
    counts.compact()
    assert len(counts.flights._names()) == 1 and held(counts) == by_hand(spark, left, flights)
    assert not counts.apply(1, flights, made(spark, LATER))
    assert counts.apply(2, flights, gone=made(spark, left)) and held(TicketCounts(spark, str(tmp_path))) == ([], [])
    assert counts.apply(3, flights) and held(counts) == ([], [])
    counts.compact()
    counts.compact()
    assert held(counts) == ([], [])


def test_a_batch_cut_off_between_its_counts_is_finished(spark, tmp_path, flights, monkeypatch):
    counts = TicketCounts(spark, str(tmp_path))
    with monkeypatch.context() as patched:
        patched.setattr(counts.customers, "apply", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            counts.apply(0, flights, made(spark, FIRST))
    assert counts.apply(0, flights, made(spark, FIRST)) and held(counts) == by_hand(spark, FIRST, flights)


def test_a_run_killed_before_its_entry_leaves_nothing(spark, tmp_path, monkeypatch):
    keys = T.StructType([T.StructField("k", T.StringType())])
    kept = KeptCounts(spark, str(tmp_path), keys)
    assert kept.read().count() == 0
    with monkeypatch.context() as patched:
        patched.setattr(kept.log, "publish", lambda *a: (_ for _ in ()).throw(Conflict("lost")))
        with pytest.raises(Conflict):
            kept.apply(0, spark.createDataFrame([("a",)], keys))
    assert kept.read().count() == 0
    kept.apply(0, spark.createDataFrame([("a",), ("a",), (None,)], keys))
    assert rows(kept.read()) == rows(spark.createDataFrame([("a", 2), (None, 1)], "k string, n long"))


def test_hot_keys_are_summed_before_the_shuffle(spark, tmp_path, monkeypatch):
    keys = T.StructType([T.StructField("k", T.LongType())])
    kept, plans = KeptCounts(spark, str(tmp_path), keys), []
    write = kept._write
    monkeypatch.setattr(kept, "_write", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    kept.apply(0, spark.range(100_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(0).alias("k")))
    assert "partial_sum" in plans[0].split("Exchange hashpartitioning")[1] and plans[0].count("Exchange") == 1
    assert {r.k: r.n for r in kept.read().filter("k = 0").collect()} == {0: 33_334}


def test_stream_of_tickets(spark, tmp_path, flights):
    source = tmp_path / "in"
    for name, data in (("a", [(*t, False) for t in FIRST]), ("b", [(*t, True) for t in GONE] + [(*t, None) for t in LATER])):
        spark.createDataFrame(data, TICKETS + ", gone boolean").coalesce(1).write.mode("append").parquet(f"{source}/{name}")
    counts = TicketCounts(spark, str(tmp_path / "counts"))
    stream = spark.readStream.schema(TICKETS + ", gone boolean").option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    for _ in range(2):  # the second run finds nothing new
        count_stream(stream, counts, flights, str(tmp_path / "state"), F.col("gone")).awaitTermination()
    assert held(counts) == by_hand(spark, [t for t in FIRST if t not in GONE] + LATER, flights)


def test_other_reports_say_that_they_need_the_tickets(spark, tmp_path):
    tables = CountedTables(HandMade(spark), TicketCounts(spark, str(tmp_path)))
    with pytest.raises(ValueError, match="needs the tickets"):
        REPORTS["r15"](tables)
