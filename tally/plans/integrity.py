"""All declared constraints of the booking tables checked in one report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.operators.quality import check_columns, check_unique
from tally.plans.reports import Tables
from tally.schemas import MAX_LENGTHS, PRIMARY_KEYS, REFERENCES, REQUIRED


def _row(counted: DataFrame, kind: str, table: str, column: str, violations: str) -> DataFrame:
    return counted.select(
        F.lit(kind).alias("kind"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.coalesce(F.col(violations), F.lit(0).cast("long")).alias("violations"),
    )


def reference_counts(tables: Tables, child: str, refs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(ref, violations) of (column, parent, parent key) references, by their place in ``refs``.

    One scan of the child counts the values of all its references; only those counts are joined.
    """
    pairs = [F.struct(F.lit(i).alias("ref"), F.col(c).cast("string").alias("value")) for i, (c, _, _) in enumerate(refs)]
    columns = list(dict.fromkeys(c for c, _, _ in refs))
    used = tables(child, *columns).select(F.inline(F.array(*pairs))).filter("value IS NOT NULL")
    used = used.groupBy("ref", "value").agg(F.count("*").alias("rows"))
    parents = [
        tables(parent, key).select(F.lit(i).alias("ref"), F.col(key).cast("string").alias("value"))
        for i, (_, parent, key) in enumerate(refs)
    ]
    missing = used.join(reduce(DataFrame.unionByName, parents), ["ref", "value"], "left_anti")
    return missing.groupBy("ref").agg(F.sum("rows").alias("violations"))


def declared_checks(tables: Tables, names: Sequence[str]) -> DataFrame:
    """One row per primary key, reference, required column and text limit of ``names``.

    For keys and references ``violations`` counts offending values' rows.  References whose
    parent is not among ``names`` are left out, and so are columns that a table does not have.
    """
    found = []
    for name in names:
        table, key = tables(name), PRIMARY_KEYS[name]
        if set(key) <= set(table.columns):
            repeated = check_unique(tables(name, *key), key).agg(F.sum("rows").alias("violations"))
            found.append(_row(repeated, "primary key", name, ", ".join(key), "violations"))
        required = [c for c in REQUIRED[name] if c in table.columns]
        limits = {c: n for c, n in MAX_LENGTHS[name].items() if c in table.columns}
        if required or limits:
            columns = check_columns(tables(name, *dict.fromkeys([*required, *limits])), required, limits)
            found.append(columns.select("kind", F.lit(name).alias("table"), "column", "violations"))
        refs = [
            (column, parent, parent_key)
            for child, column, parent, parent_key in REFERENCES
            if child == name and parent in names and column in table.columns
        ]
        if refs:
            labels = F.array(*[F.struct(F.lit(i).alias("ref"), F.lit(f"{c} -> {p}").alias("column")) for i, (c, p, _) in enumerate(refs)])
            listed = table.sparkSession.range(1).select(F.inline(labels))
            counted = listed.join(reference_counts(tables, name, refs), "ref", "left")
            found.append(
                counted.select(
                    F.lit("reference").alias("kind"),
                    F.lit(name).alias("table"),
                    "column",
                    F.coalesce("violations", F.lit(0).cast("long")).alias("violations"),
                )
            )
    return reduce(DataFrame.unionByName, found)
