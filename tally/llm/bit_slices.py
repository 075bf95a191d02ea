"""Exact top-k search by inner product over a bit-sliced index.

Vectors count as whole numbers.  Rows are taken in blocks, and a block is kept as bitmaps: slice b of
component d has a bit for every row, the b-th bit of that row's component above the block's least one.
Only the highest ``slices`` bits of the range are sliced.  For a query

1. the score of all rows of a block is summed at once: each component of the query is a few signed powers of two
   (non-adjacent form), so the score is a sum of shifted slices, or of their complements where the sign is
   minus.  Bitmaps of one weight are added three at a time, as a full adder does: a sum bitmap stays, a carry
   bitmap moves to the next weight.
2. the k-th greatest of these sums is found from the most significant slice of the sum downward, with bitmaps and
   counts of their bits.
3. what the bits left out can change is bounded, so rows that may belong to the k best are known: those above the
   k-th sum less that bound, and above what the best k so far need.  Their scores are computed exactly.

The answer is exact for any number of slices; fewer slices mean less adding and more exact scores.

Rows are dealt over cells by row number, never by content; a cell holds a part of the rows and a part of
the queries, and meets them block by block.  It returns k rows a query.  Queries in memory are bounded
by ``cell_queries``, rows by the block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.bisector import LARGEST, LONG, scaled
from tally.llm.texts import written
from tally.operators import top_n_per_group

SCALE = 1024
SLICES = 6
BLOCK_VALUES = 1 << 20  # components of a block: 16384 rows of 64
CELL_ROWS = 1 << 18
CELL_QUERIES = 4096
LEAST_ROWS = 2048  # a cell of fewer rows is not worth a task

_NO_SCORE = -(2**200)


def powers(weights: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(power, components with plus 2**power, components with minus 2**power) of whole numbers."""
    rest, found, power = weights.astype(object), [], 0
    if np.abs(weights).max(initial=0) < 2**60:
        rest = weights.astype(np.int64)
    while rest.any():
        low = (rest & 3).astype(np.int64)
        digit = np.where(low == 1, 1, np.where(low == 3, -1, 0))
        plus, minus = np.flatnonzero(digit == 1), np.flatnonzero(digit == -1)
        if len(plus) or len(minus):
            found.append((power, plus, minus))
        rest = (rest - digit) >> 1
        power += 1
    return found


def add_bitmaps(by_weight: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """The sum, as one bitmap a weight from 0 up, of any number of bitmaps a weight (as stacks of rows)."""
    summed, weight = [], 0
    pending = dict(by_weight)
    while pending:
        stacks = pending.pop(weight, [])
        rows = np.concatenate(stacks) if stacks else np.zeros((1, words), np.uint64)
        carries = []
        while len(rows) > 1:
            n = len(rows) // 3
            if n:
                a, b, c = rows[:n], rows[n : 2 * n], rows[2 * n : 3 * n]
                either = a ^ b
                carries.append((a & b) | (either & c))
                rows = np.concatenate([either ^ c, rows[3 * n :]])
            else:
                carries.append(rows[:1] & rows[1:])
                rows = rows[:1] ^ rows[1:]
        if carries:
            pending.setdefault(weight + 1, []).extend(carries)
        summed.append(rows[0])
        weight += 1
    return summed


def _ones(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def kth_greatest(summed: list[np.ndarray], among: np.ndarray, k: int) -> int | None:
    """The k-th greatest sum of the rows in ``among``, from the most significant slice downward."""
    if _ones(among) < k:
        return None
    value, left = 0, k
    for weight in range(len(summed) - 1, -1, -1):
        high = among & summed[weight]
        n = _ones(high)
        if n >= left:
            among, value = high, value | 1 << weight
        else:
            among, left = among & ~summed[weight], left - n
    return value


def at_least(summed: list[np.ndarray], among: np.ndarray, limit: int) -> np.ndarray:
    """The rows in ``among`` whose sum is ``limit`` or more."""
    if limit <= 0:
        return among
    if limit >> len(summed):
        return np.zeros_like(among)
    above, level = np.zeros_like(among), among
    for weight in range(len(summed) - 1, -1, -1):
        high = level & summed[weight]
        if limit >> weight & 1:
            level = high
        else:
            above, level = above | high, level & ~summed[weight]
    return above | level


class SlicedBlock:
    """Rows of whole numbers with a bitmap for each of the highest bits of each component."""

    def __init__(self, values: np.ndarray, slices: int):
        self.values = values
        self.largest = int(np.abs(values).max(initial=0))
        n = len(values)
        self.words = -(-n // 64)
        self.least = values.min(axis=0)
        above = (values.astype(np.uint64) - self.least.astype(np.uint64)[None, :]) if n else values.astype(np.uint64)
        width = int(above.max(initial=0)).bit_length()
        self.shift = max(0, width - slices)
        self.bits = width - self.shift
        kept = np.zeros((self.words * 64, values.shape[1]), np.uint64)
        kept[:n] = above >> np.uint64(self.shift)
        planes = [np.packbits(((kept >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T, axis=1, bitorder="little") for b in range(self.bits)]
        self.planes = [np.ascontiguousarray(p).view(np.uint64) for p in planes]
        rows = np.zeros(self.words * 64, np.uint8)
        rows[:n] = 1
        self.rows = np.packbits(rows, bitorder="little").view(np.uint64)

    def candidates(self, query: "Query", k: int, floor: int) -> np.ndarray:
        """Places of all rows that can be among the ``k`` best and reach the score ``floor``."""
        by_weight: dict[int, list[np.ndarray]] = {}
        turned = 0  # what the complements have added
        for power, plus, minus in query.powers:
            turned += len(minus) * ((1 << self.bits) - 1) << power
            for b, plane in enumerate(self.planes):
                stacks = by_weight.setdefault(power + b, [])
                if len(plus):
                    stacks.append(plane[plus])
                if len(minus):
                    stacks.append(~plane[minus])
        summed = add_bitmaps(by_weight, self.words)
        loose = (1 << self.shift) - 1  # what the bits left out may hold
        limit = 0
        if floor > _NO_SCORE:
            base = sum(int(a) * int(b) for a, b in zip(query.values, self.least))
            limit = -((base + query.gain * loose - floor - (turned << self.shift)) >> self.shift)
        kth = kth_greatest(summed, self.rows, k) if summed else None
        if kth is not None:
            limit = max(limit, kth - ((query.gain + query.loss) * loose >> self.shift))
        found = at_least(summed, self.rows, limit) if summed else self.rows
        return np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little"))

    def scores(self, query: "Query", places: np.ndarray) -> np.ndarray:
        """Exact inner products."""
        rows, values = self.values[places], query.values
        if self.largest * query.largest * max(1, len(values)) < 2**62:
            return rows @ values
        return np.array([min(LONG, max(-LONG - 1, int(s))) for s in rows.astype(object) @ values.astype(object)], dtype=np.int64)


class Query:
    """A query with the best rows found so far, as (score, id is null, id, row)."""

    def __init__(self, row: int, name: int | None, values: np.ndarray, width: int):
        self.row, self.name = row, name
        self.values = np.zeros(width, np.int64)
        self.values[: len(values)] = values
        self.largest = int(np.abs(self.values).max(initial=0))
        self.gain = sum(int(v) for v in self.values if v > 0)
        self.loss = -sum(int(v) for v in self.values if v < 0)
        self.powers = powers(self.values)
        self.best = np.zeros((0, 4), np.int64)

    def meet(self, block: SlicedBlock, ids: np.ndarray, k: int) -> None:
        """``ids``: (id is null, id, row) of the block's rows."""
        floor = int(self.best[-1, 0]) if len(self.best) == k else _NO_SCORE
        if floor >= LONG or floor <= -LONG:  # a score that was cut to a long says nothing about sums
            floor = _NO_SCORE
        places = block.candidates(self, k + 1, floor)  # one more, as the query's own row may be here
        places = places[ids[places, 2] != self.row]
        if len(places):
            found = np.column_stack([block.scores(self, places), ids[places]])
            both = np.concatenate([self.best, found])
            order = np.lexsort((both[:, 3], both[:, 2], both[:, 1], -np.maximum(both[:, 0], -LONG)))
            self.best = both[order[:k]]


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """The first ``width`` components of each row; missing ones are 0."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    lengths = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    starts = np.cumsum(lengths) - lengths
    inside = np.arange(width)[None, :] < lengths[:, None]
    made = np.zeros((len(lengths), width), np.int64)
    made[inside] = flat[(starts[:, None] + np.arange(width)[None, :])[inside]]
    return made


_FOUND = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _search(k: int, slices: int, block_values: int):
    def answers(queries: list[Query]) -> Iterator[pa.RecordBatch]:
        for q in queries:
            if len(q.best):
                n = len(q.best)
                ids = pa.array(q.best[:, 2], pa.int64(), mask=q.best[:, 1].astype(bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q.row] * n, pa.int64()), pa.array([q.name] * n, pa.int64()), pa.array(q.best[:, 3]), ids, pa.array(q.best[:, 0])],
                    schema=_FOUND,
                )

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, queries, width = None, [], 0
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def meet() -> None:
            if held:
                block = SlicedBlock(np.concatenate([v for v, _ in held]), slices)
                ids = np.concatenate([i for _, i in held])
                held.clear()
                for q in queries:
                    q.meet(block, ids, k)

        for batch in batches:
            cells = batch.column("cell").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((cells[1:] != cells[:-1]) | (asks[1:] != asks[:-1])) + 1
            for start, end in zip([0, *edges], [*edges, len(cells)]):
                part = batch.slice(start, end - start)
                if cells[start] != cell:
                    meet()
                    yield from answers(queries)
                    cell, queries, width = cells[start], [], 0
                if asks[start]:  # they come before the rows of their cell
                    asked = zip(part.column("row").to_pylist(), part.column("vec_id").to_pylist(), part.column("x"))
                    values = [(r, i, np.asarray(x.values, np.int64)) for r, i, x in asked]
                    width = max([width, *(len(x) for _, _, x in values)])
                    queries = [Query(q.row, q.name, q.values, width) for q in queries] + [Query(r, i, x, width) for r, i, x in values]
                elif queries:
                    most = max(64, block_values // max(1, width))
                    for at in range(0, end - start, most):
                        some = part.slice(at, most)
                        names = some.column("vec_id")
                        ids = [names.is_null().to_numpy(zero_copy_only=False), names.fill_null(0).to_numpy(), some.column("row").to_numpy()]
                        held.append((_matrix(some.column("x"), width), np.column_stack(ids).astype(np.int64)))
                        if sum(len(i) for _, i in held) >= most:
                            meet()
        meet()
        yield from answers(queries)

    return searched


def _scaled_rows(scale: int):
    schema = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("asks", pa.bool_()), ("x", pa.list_(pa.int64()))])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("embedding").is_valid())
            lists = batch.column("embedding")
            lengths = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null: not a number
            owner = np.repeat(np.arange(len(lengths)), lengths)
            bad = np.zeros(len(lengths), bool)
            bad[owner[~np.isfinite(values)]] = True
            good = ~bad
            numbers = scaled(values[good[owner]], scale)
            ends = np.concatenate([[0], np.cumsum(lengths[good])])
            x = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers, pa.int64()))
            kept = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([kept.column("row"), kept.column("vec_id"), kept.column("asks"), x], schema=schema)

    return made


def top_k(
    vectors: DataFrame,
    asks: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    scale: int = SCALE,
    slices: int = SLICES,
    cell_rows: int = CELL_ROWS,
    cell_queries: int = CELL_QUERIES,
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the greatest inner product for every row that ``asks``.

    ``asks`` is a condition on columns of ``vectors``; ids are integers.  Component x counts as floor(``scale`` * x).
    Every row but the query's own is a candidate; ties go to the smaller id, a null id comes last.
    Vectors that are null, or hold a null or a component that is not finite, neither ask nor are found.  A vector
    of fewer components counts as followed by zeros.  Repeated rows ask and are found once each, so a query id may have
    several answers.  Fewer than ``k`` candidates: all of them.  An empty table gives no rows; other columns
    are ignored.  Components beyond 2**62 in size count as 2**62, scores beyond a long as the nearest long.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
        F.col(f"`{embedding}`").cast("array<double>").alias("embedding"),
    )
    ddl = "row long, vec_id long, asks boolean, x array<long>"
    kept = written(rows.mapInArrow(_scaled_rows(scale), ddl), "sliced-rows")
    n, asked = kept.agg(F.count("*"), F.count_if("asks")).first()
    wide = max(1, math.ceil(asked / cell_queries))
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deep = max(1, math.ceil(n / cell_rows), min(math.ceil(tasks / wide), math.ceil(n / LEAST_ROWS)))

    # a row number, not the content, says where a row goes, so equal vectors spread as others do
    down, across = F.pmod(F.xxhash64("row"), F.lit(deep)), F.pmod(F.xxhash64(F.col("row"), F.lit(1)), F.lit(wide))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    found = kept.select("row", "vec_id", "x", F.lit(False).alias("asks"), down.alias("down"), every(wide).alias("across"))
    asking = kept.filter("asks").select("row", "vec_id", "x", F.lit(True).alias("asks"), across.alias("across"), every(deep).alias("down"))
    cell = (F.col("down") * wide + F.col("across")).alias("cell")
    cells = found.unionByName(asking).select(cell, "asks", "row", "vec_id", "x")
    dealt = cells.repartition(2 * deep * wide, "cell").sortWithinPartitions(F.col("cell"), F.col("asks").desc())
    parts = dealt.mapInArrow(_search(k, slices, block_values), "query long, query_id long, row long, vec_id long, score long")
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("row")]
    best = top_n_per_group(parts, "query", order, k, "rank")
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
