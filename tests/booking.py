"""Hand-made booking tables: rows are dicts, missing columns are NULL."""

import datetime
from decimal import Decimal

from tally.schemas import TABLES


def d(text):
    return datetime.date.fromisoformat(text)


def money(text):
    return Decimal(text)


class HandMade:
    """Answers like ``ParquetTables`` from rows in memory."""

    def __init__(self, spark, **tables):
        self.spark = spark
        self.tables = tables

    def __call__(self, name, *columns):
        schema = TABLES[name]
        data = [tuple(row.get(field.name) for field in schema) for row in self.tables.get(name, [])]
        df = self.spark.createDataFrame(data, schema)
        return df.select(*columns) if columns else df


def tickets(*groups):
    """``(count, fields)`` groups to numbered tickets."""
    made = []
    for count, fields in groups:
        for _ in range(count):
            made.append({"ticket_id": len(made) + 1, **fields})
    return made


WEEKDAYS = [
    {"weekday_id": i, "name": name, "day_order": i}
    for i, name in enumerate(["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"], 1)
]
CITIES = [
    {"city_state_id": 10, "name": "Tampa", "state_id": 1},
    {"city_state_id": 20, "name": "Orlando", "state_id": 1},
    {"city_state_id": 30, "name": "Tampa", "state_id": 2},
]
