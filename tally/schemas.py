"""Declared tables: columns, keys, references and text limits.

Types as stored in parquet: times are ``HH:mm:ss`` strings (they sort correctly and need no
session flag) and ``varchar(n)`` is a string whose limit is kept apart for the length check.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Table and column names, types and keys of the booking database.
_COLUMNS = {
    "tickets": """ticket_id int!, flight_id int, customer_id int, employee_id int, purchase_date date,
        purchase_time time, boarding_date date, boarding_time time, purchase_location_id int,
        cabin_type_id int, discount_id int, final_price decimal(10,2), payment_type_id int""",
    "flights": """flight_id int!, date date, start_time_actual time, end_time_actual time, route_id int,
        plane_id int""",
    "customers": """customer_id int!, first_name varchar(50), last_name varchar(50), birth_date date,
        start_date date, email varchar(50), gender varchar(1), phone1 varchar(50), phone2 varchar(50),
        address_line1 varchar(50), address_line2 varchar(50), zipcode_id int, city_state_id int""",
    "employees": """employee_id int!, first_name varchar(50), last_name varchar(50), birth_date date,
        hire_date date, email varchar(50), gender varchar(1), ssn varchar(50), phone1 varchar(50),
        phone2 varchar(50), address_line1 varchar(50), address_line2 varchar(50), zipcode_id int,
        city_state_id int, job_position_id int, employee_id_reports_to int, flight_role_id int""",
    "flights_employees": "flight_id int!, employee_id int!",
    "routes": """route_id int!, city_state_id_origin int, city_state_id_destination int, start_time time,
        end_time time, weekday_id int""",
    "routes_cabin_types": """route_cabin_type_id int!, route_id int!, cabin_type_id int!,
        price decimal(10,2), start_date date, end_date date""",
    "planes": """plane_id int!, fabrication_date date, first_use_date date, brand varchar(50),
        model varchar(50), capacity int""",
    "planes_maintenances": """plane_maintenance_id int!, plane_id int!, maintenance_id int!, date date,
        status int, observations varchar(50), employee_id int""",
    "maintenances": "maintenance_id int!, name varchar(800), observations varchar(800)",
    "employees_job_positions": """employee_job_position_id int!, employee_id int!, job_position_id int!,
        salary decimal(10,2), start_date date, end_date date""",
    "job_positions": """job_position_id int!, name varchar(50), description varchar(800),
        salary_base decimal(10,2)""",
    "locations": """location_id int!, name varchar(50), location_type_id int, address_line1 varchar(50),
        address_line2 varchar(50), zipcode_id int, city_state_id int""",
    "location_types": "location_type_id int!, name varchar(50)",
    "cabin_types": "cabin_type_id int!, name varchar(50)",
    "discounts": """discount_id int!, name varchar(50), percentage decimal(5,2),
        observations varchar(800), start_date date, end_date date""",
    "payment_types": "payment_type_id int!, name varchar(50)",
    "weekdays": "weekday_id int!, name varchar(50), day_order int",
    "cities_states": "city_state_id int!, name varchar(50), state_id int",
    "zipcodes": "zipcode_id int!, name varchar(50), state_id int",
    "states": "state_id int!, name varchar(50)",
    "flights_roles": "flight_role_id int!, name varchar(50)",
}

# Fixed values: (child column, parent table); the parent column is the parent's key.
_REFERENCES = {
    "tickets": [
        ("customer_id", "customers"),
        ("flight_id", "flights"),
        ("purchase_location_id", "locations"),
        ("cabin_type_id", "cabin_types"),
        ("employee_id", "employees"),
        ("discount_id", "discounts"),
        ("payment_type_id", "payment_types"),
    ],
    "flights": [("route_id", "routes"), ("plane_id", "planes")],
    "customers": [("city_state_id", "cities_states"), ("zipcode_id", "zipcodes")],
    "employees": [
        ("city_state_id", "cities_states"),
        ("zipcode_id", "zipcodes"),
        ("flight_role_id", "flights_roles"),
        ("employee_id_reports_to", "employees"),
    ],
    "flights_employees": [("employee_id", "employees"), ("flight_id", "flights")],
    "routes": [
        ("city_state_id_origin", "cities_states"),
        ("city_state_id_destination", "cities_states"),
        ("weekday_id", "weekdays"),
    ],
    "routes_cabin_types": [("route_id", "routes"), ("cabin_type_id", "cabin_types")],
    "planes_maintenances": [
        ("plane_id", "planes"),
        ("maintenance_id", "maintenances"),
        ("employee_id", "employees"),
    ],
    "employees_job_positions": [("job_position_id", "job_positions"), ("employee_id", "employees")],
    "locations": [
        ("zipcode_id", "zipcodes"),
        ("city_state_id", "cities_states"),
        ("location_type_id", "location_types"),
    ],
    "cities_states": [("state_id", "states")],
    "zipcodes": [("state_id", "states")],
}

_COLUMN = re.compile(r"(\w+) (int|date|time|decimal|varchar)(?:\((\d+)(?:,(\d+))?\))?(!?)")


def _field(match: re.Match) -> T.StructField:
    name, kind, size, scale, required = match.groups()
    types = {"int": T.IntegerType(), "date": T.DateType(), "time": T.StringType(), "varchar": T.StringType()}
    data_type = T.DecimalType(int(size), int(scale)) if kind == "decimal" else types[kind]
    return T.StructField(name, data_type, not required)


TABLES: dict[str, T.StructType] = {
    table: T.StructType([_field(m) for m in _COLUMN.finditer(text)]) for table, text in _COLUMNS.items()
}


def wide(schema: T.StructType) -> T.StructType:
    """The schema with bigint ids, for tables that outgrow int; files with int ids still read."""
    return T.StructType(
        [
            T.StructField(f.name, T.LongType(), f.nullable)
            if isinstance(f.dataType, T.IntegerType) and "_id" in f.name
            else f
            for f in schema
        ]
    )


PRIMARY_KEYS: dict[str, list[str]] = {
    table: [schema[0].name] for table, schema in TABLES.items() if table != "flights_employees"
} | {"flights_employees": ["flight_id", "employee_id"]}

REFERENCES: list[tuple[str, str, str, str]] = [
    (child, column, parent, PRIMARY_KEYS[parent][0])
    for child, refs in _REFERENCES.items()
    for column, parent in refs
]

REQUIRED: dict[str, list[str]] = {
    table: [field.name for field in schema if not field.nullable] for table, schema in TABLES.items()
}

MAX_LENGTHS: dict[str, dict[str, int]] = {
    table: {m[1]: int(m[3]) for m in _COLUMN.finditer(text) if m[2] == "varchar"}
    for table, text in _COLUMNS.items()
}

# Dates the reports filter on, by which large tables are laid out.
CLUSTER_BY: dict[str, str] = {
    "tickets": "boarding_date",
    "flights": "date",
    "planes_maintenances": "date",
}

AUDIT = T.StructType(
    [
        T.StructField("aud_id", T.StringType()),
        T.StructField("aud_station", T.StringType()),
        T.StructField("aud_operation", T.StringType()),
        T.StructField("aud_date", T.DateType()),
        T.StructField("aud_time", T.StringType()),
        T.StructField("aud_username", T.StringType()),
        T.StructField("aud_table", T.StringType()),
        T.StructField("aud_identifier_id", T.StringType()),
        T.StructField("aud_column", T.StringType()),
        T.StructField("aud_before", T.StringType()),
        T.StructField("aud_after", T.StringType()),
    ]
)
