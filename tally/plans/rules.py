"""Value rules, unique columns and defaults of the declared tables.

Only their number per table is given; the conditions are this package's own choice.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.operators.quality import check_rules, check_unique, fill_defaults
from tally.plans.reports import Tables


@dataclass(frozen=True)
class TableRules:
    checks: dict[str, str] = field(default_factory=dict)
    unique: list[str] = field(default_factory=list)
    defaults: dict[str, object] = field(default_factory=dict)

    def __len__(self) -> int:
        return len(self.checks) + len(self.unique) + len(self.defaults)


TODAY = "today"  # default filled with the ``as_of`` day

RULES: dict[str, TableRules] = {
    "employees": TableRules(
        checks={
            "gender is M or F": "gender IN ('M', 'F')",
            "hired after birth": "hire_date > birth_date",
            "nobody reports to themselves": "employee_id_reports_to <> employee_id",
            "email has an @": "email LIKE '%_@_%'",
            "ssn is 3-2-4 digits": "ssn RLIKE '^[0-9]{3}-[0-9]{2}-[0-9]{4}$'",
        },
        unique=["ssn", "email"],
        defaults={"hire_date": TODAY},
    ),
    "customers": TableRules(
        checks={
            "gender is M or F": "gender IN ('M', 'F')",
            "born since 1900": "birth_date >= DATE'1900-01-01'",
            "joined after birth": "start_date > birth_date",
            "email has an @": "email LIKE '%_@_%'",
        },
        unique=["email"],
        defaults={"start_date": TODAY},
    ),
    "tickets": TableRules(
        checks={
            "price is not negative": "final_price >= 0",
            "bought before boarding": "purchase_date <= boarding_date",
            "purchase time is a time": "try_cast(concat('2000-01-01 ', purchase_time) AS TIMESTAMP) IS NOT NULL"
            " OR purchase_time IS NULL",
            "boarding time is a time": "try_cast(concat('2000-01-01 ', boarding_time) AS TIMESTAMP) IS NOT NULL"
            " OR boarding_time IS NULL",
        },
        defaults={"purchase_date": TODAY, "payment_type_id": 1},
    ),
    "locations": TableRules(
        checks={"name is not blank": "trim(name) <> ''"}, unique=["name"], defaults={"location_type_id": 1}
    ),
    "planes": TableRules(
        checks={"capacity is positive": "capacity > 0", "used after it was built": "first_use_date >= fabrication_date"},
        defaults={"capacity": 16},
    ),
    "flights": TableRules(
        checks={
            "dated 2016 to 2019": "date BETWEEN DATE'2016-01-01' AND DATE'2019-12-31'",
            "lands after take-off": "end_time_actual > start_time_actual",
        },
        defaults={"date": TODAY},
    ),
    "routes": TableRules(
        checks={
            "two different cities": "city_state_id_origin <> city_state_id_destination",
            "weekday is 1 to 7": "weekday_id BETWEEN 1 AND 7",
            "lands after take-off": "end_time > start_time",
        }
    ),
    "discounts": TableRules(
        checks={"rate is a fraction": "percentage BETWEEN 0 AND 1", "ends after it starts": "end_date >= start_date"},
        unique=["name"],
    ),
}


def rule_report(tables: Tables, table: str) -> DataFrame:
    """(rule, violations): every check in one pass, and repeated values per unique column."""
    rules, rows = RULES[table], tables(table)
    reports = [check_rules(rows, rules.checks)] if rules.checks else []
    for column in rules.unique:
        repeated = check_unique(rows.filter(F.col(column).isNotNull()), [column])
        counted = repeated.agg(F.count("*").alias("violations"))
        reports.append(counted.select(F.lit(f"{column} is unique").alias("rule"), "violations"))
    whole = reports[0]
    for report in reports[1:]:
        whole = whole.unionByName(report)
    return whole


def with_defaults(tables: Tables, table: str, as_of: datetime.date) -> DataFrame:
    """The table with its declared defaults filled in."""
    filled: dict[str, Column] = {
        name: F.lit(as_of if value == TODAY else value) for name, value in RULES[table].defaults.items()
    }
    return fill_defaults(tables(table), filled)
