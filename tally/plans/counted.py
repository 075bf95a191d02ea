"""Ticket counts that follow the tickets, for reports on a table that changes.

The reports on load factors, months, route demand and residents' flights read tickets only to count them by flight or by
customer.  ``TicketCounts`` keeps both counts by boarding year; a batch of sold and cancelled tickets moves
them on.  ``CountedTables`` stands for the tables in a report: what the report counts comes from there, and the
tickets themselves are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tally.operators.joins import join_dim
from tally.sources.counts import COUNT, KeptCounts

BOARDED = "boarding_year"
TICKET_COLUMNS = ["ticket_id", "flight_id", "customer_id", "boarding_date"]


class TicketCounts:
    """Tickets by flight and by customer, each by boarding year, in one folder.

    By customer only tickets on known flights count, as in the reports: a flight is to be in the table when its
    tickets come, and to stay.
    """

    def __init__(self, spark: SparkSession, folder: str, id_type: T.DataType | None = None):
        kind = T.LongType() if id_type is None else id_type

        def kept(name: str) -> KeptCounts:
            keys = T.StructType([T.StructField(name, kind), T.StructField(BOARDED, T.IntegerType())])
            return KeptCounts(spark, f"{folder.rstrip('/')}/{name}", keys)

        self.flights, self.customers = kept("flight_id"), kept("customer_id")

    def apply(self, batch: int, flights: DataFrame, sold: DataFrame | None = None, gone: DataFrame | None = None) -> bool:
        """Move both counts on by a batch; a batch that was cut off between the two is finished when it is repeated."""

        def dated(df: DataFrame | None) -> DataFrame | None:
            return None if df is None else df.select(*TICKET_COLUMNS).withColumn(BOARDED, F.year("boarding_date"))

        def flown(df: DataFrame | None) -> DataFrame | None:
            if df is None:
                return None
            own = dated(df).filter(F.col("customer_id").isNotNull() & F.col("flight_id").isNotNull())
            return join_dim(own, flights.select("flight_id"), "flight_id", "left_semi", ["ticket_id"])

        # both are asked in any case: one may have missed a batch that the other has
        by_flight = self.flights.apply(batch, dated(sold), dated(gone))
        by_customer = self.customers.apply(batch, flown(sold), flown(gone))
        return by_flight or by_customer

    def compact(self) -> None:
        self.flights.compact()
        self.customers.compact()

    def per_flight(self, years: Sequence[int] = ()) -> DataFrame:
        return _of_years(self.flights, "flight_id", "tickets", years)

    def per_customer(self, years: Sequence[int] = ()) -> DataFrame:
        return _of_years(self.customers, "customer_id", "n", years)


def _of_years(counts: KeptCounts, key: str, name: str, years: Sequence[int]) -> DataFrame:
    held = counts.read()
    if years:
        held = held.filter(F.col(BOARDED).isin(*years))
    return held.groupBy(key).agg(F.sum(COUNT).alias(name))


class CountedTables:
    """Tables whose tickets are known by their counts only."""

    def __init__(self, tables: Callable[..., DataFrame], counts: TicketCounts):
        self.tables = tables
        self.counts = counts

    def __call__(self, name: str, *columns: str) -> DataFrame:
        if name == "tickets":
            raise ValueError("this report needs the tickets, not only their counts")
        return self.tables(name, *columns)


def count_stream(
    changes: DataFrame, counts: TicketCounts, flights: DataFrame, checkpoint: str, gone: Column, trigger: dict | None = None
) -> StreamingQuery:
    """Keep ``counts`` up with a stream of tickets; ``gone`` marks rows that are cancelled (NULL does not)."""
    cancelled = F.coalesce(gone, F.lit(False))

    def move(batch: DataFrame, number: int) -> None:
        counts.apply(number, flights, batch.filter(~cancelled), batch.filter(cancelled))

    writer = changes.writeStream.foreachBatch(move).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
