"""Ranks and top-n, including a full rank that never passes through one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.functions import rank_label
from tally.workspace import store

ONE_TASK_ROWS = 100_000

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def rank_all(
    df: DataFrame,
    order: Sequence[Column],
    position: str = "position",
    bound: int | DataFrame | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Number every row by ``order``, which must end in a unique key.

    ``bound`` is a known limit on the rows: a number, or a table that holds a row for each of them
    (one they were joined to by their grouping key, never one whose key they only share by name).
    When it is no more than ``one_task_rows``, one window does.  Otherwise: one range sort, kept in
    the shared folder; then each row's rank is its place in its range plus the sizes of the
    ranges before.  Either way the rows come back in rank order without another sort.
    """
    if bound is not None:
        most = bound if isinstance(bound, int) else bound.count()
        if most <= one_task_rows:
            return df.withColumn(position, F.row_number().over(Window.orderBy(*order)).cast("long"))

    stored = store(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_at"), _ROW_BITS)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    # one row per sort range, so the broadcast is bounded by the partition count
    return (
        stored.join(F.broadcast(starts), part == F.col("_part"))
        .withColumn(position, F.col("_start") + F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1) + 1)
        .drop("_at", "_part", "_start")
    )


def first_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def ranked(
    df: DataFrame,
    order: Sequence[Column],
    labels: Mapping[int, str] | None = None,
    top: int | None = None,
    last: str | None = None,
    only_top: int | None = None,
    bound: int | DataFrame | None = None,
    rank_col: str = "orden",
    label_col: str = "position",
) -> DataFrame:
    """Rank grouped rows and label some of the ranks.

    ``labels`` maps rank to text; ``top=n`` labels the first n ``TOP n``; ``last`` labels the
    final rank whatever it is.  ``only_top`` returns just the first rows, without a full rank.
    Rows come in rank order.
    """
    if top is not None:
        labels = {**(labels or {}), **{rank: f"TOP {top}" for rank in range(1, top + 1)}}
    if only_top is not None:
        if last is not None:
            raise ValueError("the last rank is unknown when only the top is kept")
        placed = rank_all(first_n(df, order, only_top), order, rank_col, bound=only_top)
    else:
        placed = rank_all(df, order, rank_col, bound)
    if labels is None and last is None:
        return placed
    label = rank_label(rank_col, labels or {})
    if last is not None:
        final = placed.agg(F.max(rank_col)).scalar()
        label = F.coalesce(label, F.when(F.col(rank_col) == final, F.lit(last)))
    return placed.withColumn(label_col, label)


def top_n_per_group(
    df: DataFrame,
    part: str | Sequence[str],
    order: Sequence[Column],
    n: int,
    position: str = "position",
) -> DataFrame:
    """Best ``n`` rows of each group by ``order``, which must end in a unique key.

    Up to a session limit (1000) Spark itself keeps only n rows per group and task before
    shuffling.  For larger n every group is first cut over all shuffle partitions, so that a huge group is
    never sorted by one task.
    """
    part = [part] if isinstance(part, str) else list(part)
    conf = df.sparkSession.conf
    if n > int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        pieces = int(conf.get("spark.sql.shuffle.partitions"))
        piece = F.pmod(F.xxhash64(*df.columns), F.lit(pieces))
        within = Window.partitionBy(*part, "_piece").orderBy(*order)
        df = (
            df.withColumn("_piece", piece)
            .withColumn("_row", F.row_number().over(within))
            .filter(F.col("_row") <= n)
            .drop("_piece", "_row")
        )
    whole = Window.partitionBy(*part).orderBy(*order)
    placed = df.withColumn(position, F.row_number().over(whole)).filter(F.col(position) <= n)
    return placed.withColumn(position, F.col(position).cast("long"))


def extremes(df: DataFrame, keys: Sequence[str], measure: str, carry: Sequence[str] = ()) -> DataFrame:
    """Best and worst row of a grouped frame in one pass.

    The best row reports ``measure`` as ``max_<measure>`` with ``min_<measure>`` 0 and the
    worst the other way round.  Ties go to the smallest key; a NULL measure counts as lowest.
    """
    key_cols = [F.col(key) for key in keys]
    carried = [F.col(name) for name in carry]
    kind = df.schema[measure].dataType
    zero = F.lit(0).cast(kind)
    value = F.col(measure)
    best = F.min(F.struct(value.isNull().alias("_none"), (-value).alias("_m"), *key_cols, *carried))
    worst = F.min(F.struct(value.alias("_m"), *key_cols, *carried))

    def row(found: str, low: Column, high: Column) -> Column:
        picked = [F.col(f"{found}.{name}").alias(name) for name in keys]
        rest = [F.col(f"{found}.{name}").alias(name) for name in carry]
        return F.struct(
            *picked, low.cast(kind).alias(f"min_{measure}"), high.cast(kind).alias(f"max_{measure}"), *rest
        )

    both = df.agg(best.alias("_best"), worst.alias("_worst")).filter(F.col("_best").isNotNull())
    return both.select(
        F.inline(F.array(row("_best", zero, -F.col("_best._m")), row("_worst", F.col("_worst._m"), zero)))
    )
