"""Reports on tickets that changed in two batches, from kept counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.plans import report_queries  # noqa: F401  (its SQL is taken over here)
from tally.plans.bindings import AS_OF, SQL, OrderTables
from tally.plans.counted import TICKET_COLUMNS, CountedTables, TicketCounts
from tally.plans.registry import ORACLES, query
from tally.plans.report_queries import Y1, Y2
from tally.plans.reports import REPORTS
from tally.workspace import fresh_path

_GONE, _BACK = "ticket_id % 7 = 0", "ticket_id % 14 = 0"  # cancelled by the first batch, sold again by the second
_NUMBER = "(l.l_partkey * 100 + l.l_linenumber)"
_LEFT = f" WHERE {_NUMBER} % 7 <> 0 OR {_NUMBER} % 14 = 0"


def _counted(spark: SparkSession, sf_dir: str) -> CountedTables:
    tables = OrderTables(spark, sf_dir)
    tickets, flights = tables("tickets", *TICKET_COLUMNS), tables("flights", "flight_id")
    counts = TicketCounts(spark, fresh_path(spark, "ticket-counts"))
    counts.apply(0, flights, tickets)
    counts.apply(1, flights, gone=tickets.filter(_GONE))
    counts.compact()
    counts.apply(2, flights, tickets.filter(_BACK))
    counts.apply(1, flights, gone=tickets.filter(_GONE))  # repeated, and not counted again
    return CountedTables(tables, counts)


def _on_counts(key: str, **kwargs: object) -> None:
    sold = SQL["tickets"].strip()
    sql = ORACLES[key].replace(sold, sold + _LEFT)
    query(f"{key}_counted", sql)(lambda spark, sf_dir: REPORTS[key](_counted(spark, sf_dir), **kwargs))


_on_counts("r01", year=Y1)
_on_counts("r09", year=Y2)
_on_counts("v07", years=(Y1, Y2))
_on_counts("v08", years=(Y1, Y2))
_on_counts("v09", as_of=AS_OF, years=(Y1, Y2))
