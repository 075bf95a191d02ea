"""The change operators on micro-batches.

Each batch writes its own folder, replacing it when the batch is run again after a failure,
so a batch counts once however often it is retried.  With ``published`` readers never meet half a batch either:
it is written under a fresh name and counts from the moment it is entered in a log; see :func:`read_batches`.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tally.operators.changes import audit_changes, latest_per_key
from tally.operators.joins import join_dim
from tally.operators.quality import check_date_range
from tally.sources.commits import CommitLog

BATCH_COLUMN = "batch_id"


def _per_batch(
    changes: DataFrame,
    work: Callable[[DataFrame, int], DataFrame],
    sink: str,
    checkpoint: str,
    trigger: dict | None,
    keep: bool = False,
    published: bool = False,
) -> StreamingQuery:
    """``keep`` holds a batch that is read more than once; its size is the source's to bound."""
    log = CommitLog(changes.sparkSession, f"{sink}/log")

    def run(batch: DataFrame, batch_id: int) -> None:
        if published and batch_id in log.numbers():
            return  # the stream stopped between this entry and its own checkpoint
        if keep:
            batch.persist()
        try:
            if published:
                name = f"{BATCH_COLUMN}={batch_id}/run={uuid.uuid4().hex}"
                work(batch, batch_id).write.parquet(f"{sink}/data/{name}")
                log.publish(batch_id, [name])
            else:
                work(batch, batch_id).write.mode("overwrite").parquet(f"{sink}/{BATCH_COLUMN}={batch_id}")
        finally:
            if keep:
                batch.unpersist()

    writer = changes.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_batches(spark: SparkSession, sink: str) -> DataFrame:
    """The rows of all published batches of ``sink``, with their ``batch_id``."""
    log = CommitLog(spark, f"{sink}/log")
    names = [name for number in log.numbers() for name in log.read(number)]
    if not names:
        raise ValueError(f"{sink} has no published batch")
    return spark.read.option("basePath", f"{sink}/data").parquet(*[f"{sink}/data/{name}" for name in names]).drop("run")


def audit_stream(
    changes: DataFrame,
    current: DataFrame | Callable[[int], DataFrame],
    key: str,
    cols: Sequence[str],
    sink: str,
    checkpoint: str,
    table: str,
    user: str,
    station: str,
    at: datetime.datetime | Callable[[int], datetime.datetime] | None = None,
    deleted: Column | None = None,
    order: Column | None = None,
    trigger: dict | None = None,
    published: bool = False,
) -> StreamingQuery:
    """Audit a stream of new row images against the present table.

    ``current`` is a function from batch id to the table's state before that batch (the same answer
    on a retry).  A plain table serves a stream of one batch; a second batch is then an error, as
    it would be compared with a state that is out of date.  ``at`` is the stamp, or a function from
    batch id to it, so that a retry repeats it.  ``deleted`` marks change rows that remove
    their key (NULL does not); ``order`` ranks several changes of one key within a batch, of which
    the last counts; without it a second change of a key is an error.
    """
    if at is None:
        raise ValueError("give the time stamp: a retried batch must repeat it")
    wanted = list(dict.fromkeys([key, *cols]))

    def audit(batch: DataFrame, batch_id: int) -> DataFrame:
        if not callable(current) and batch_id > 0:
            raise ValueError("a second batch needs `current` as a function from batch id to table")
        net = latest_per_key(batch, key, order) if order is not None else batch
        present = current(batch_id) if callable(current) else current
        touched = net.select(key)
        before = join_dim(present.select(*wanted), touched, key, "left_semi")
        after = net if deleted is None else net.filter(~F.coalesce(deleted, F.lit(False)))
        stamp = at(batch_id) if callable(at) else at
        return audit_changes(before, after, key, cols, table, user, station, stamp, str(batch_id))

    return _per_batch(changes, audit, sink, checkpoint, trigger, keep=True, published=published)


def validate_stream(
    changes: DataFrame,
    rule: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    trigger: dict | None = None,
    published: bool = False,
) -> StreamingQuery:
    """Run a batch check or clamp (``rule``) on every micro-batch and keep what it returns."""
    return _per_batch(changes, lambda batch, _: rule(batch), sink, checkpoint, trigger, published=published)


def violations_stream(changes: DataFrame, col: str, low: datetime.date, high: datetime.date) -> DataFrame:
    """Date-range check as a plain streaming filter, with running counts under ``checked``."""
    outside = (F.col(col) < F.lit(low)) | (F.col(col) >= F.lit(high + datetime.timedelta(days=1)))
    watched = changes.observe(
        "checked", F.count(F.lit(1)).alias("total_rows"), F.count(F.when(outside, 1)).alias("errors")
    )
    return check_date_range(watched, col, low, high)
