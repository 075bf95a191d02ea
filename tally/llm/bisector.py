"""Centroid clustering in whole numbers: a bisector tournament finds the nearest centroid.

For centroids i < j the points nearer to j are those beyond the bisecting plane,

    2 (c_j - c_i) . x  >  |c_j|^2 - |c_i|^2

Normals and thresholds of all pairs are worked out once a round.  A vector starts with centroid 0
as its champion and meets the others in ascending order; each meeting is one sign test, and the loser is
out.  After k - 1 tests the champion is the nearest centroid.  A vector on the plane (zero) stays with
its champion, which has the smaller number.  Only the distance to the champion is computed.

Everything is integer arithmetic, so results do not depend on how rows are dealt out.  A task
returns k sums of vectors, never the vectors; k * (dimensions + 1) numbers come to the driver a round.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.texts import written

DIMENSIONS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
LARGEST = 2**62  # components beyond are set to it
LONG = 2**63 - 1


def finite_rows(vectors: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows have exactly that many components, all finite; those rows as doubles)."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(vectors), dimensions), False)
    values = vectors.filter(fits).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    values = values.reshape(-1, dimensions)
    whole = np.isfinite(values).all(axis=1)  # a null component is not a number here
    chosen = fits.to_numpy(zero_copy_only=False).copy()
    chosen[chosen] = whole
    return chosen, values[whole]


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers."""
    grown = np.floor(values * float(scale))
    return np.where(np.abs(grown) < float(LARGEST), grown, 0).astype(np.int64) + np.where(
        np.abs(grown) < float(LARGEST), 0, np.sign(grown).astype(np.int64) * LARGEST
    )


class Tournament:
    """The planes between all pairs of centroids."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = centroids
        self.largest = max(abs(v) for c in centroids for v in c)
        exact = np.array(centroids, dtype=object)
        self.normals = 2 * (exact[None, :, :] - exact[:, None, :])  # [i, j] points from i to j
        squares = (exact**2).sum(axis=1)
        self.thresholds = squares[None, :] - squares[:, None]

    def _kind(self, vectors: np.ndarray) -> type:
        """64-bit integers where no sum of products can leave them, Python integers otherwise."""
        most = max(self.largest, int(np.abs(vectors).max(initial=0)))
        return np.int64 if 4 * vectors.shape[1] * most * most < 2**62 else object

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance to it) of each vector."""
        kind = self._kind(vectors)
        x, normals, thresholds = vectors.astype(kind), self.normals.astype(kind), self.thresholds.astype(kind)
        champion = np.zeros(len(x), dtype=np.int64)
        for j in range(1, len(self.centroids)):
            beyond = (x * normals[champion, j]).sum(axis=1) > thresholds[champion, j]
            champion[beyond.astype(bool)] = j
        apart = x - np.array(self.centroids, dtype=kind)[champion]
        return champion, (apart * apart).sum(axis=1)


_SUMS = pa.schema([("cluster", pa.int32()), ("place", pa.int32()), ("total", pa.decimal128(38, 0))])


def _sums(centroids: list[list[int]], dimensions: int, scale: int):
    """Per task and cluster: the sum of each component; at place -1 the number of vectors."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tournament = Tournament(centroids)
        totals = np.zeros((len(centroids), dimensions + 1), dtype=object)
        for batch in batches:
            x = scaled(finite_rows(batch.column("embedding"), dimensions)[1], scale)
            if len(x):
                champion, _ = tournament.nearest(x)
                exact = x if int(np.abs(x).max()) * len(x) < 2**62 else x.astype(object)
                for c in np.unique(champion):
                    own = exact[champion == c]
                    totals[c, :-1] += own.sum(axis=0).astype(object)
                    totals[c, -1] += len(own)
        for c in np.flatnonzero(totals[:, -1]):
            places = [*range(dimensions), -1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * (dimensions + 1), pa.int32()), pa.array(places, pa.int32())]
                + [pa.array([int(v) for v in totals[c]], pa.decimal128(38, 0))],
                schema=_SUMS,
            )

    return summed


def _assigned(centroids: list[list[int]], dimensions: int, scale: int, id_type: pa.DataType):
    schema = pa.schema([("vec_id", id_type), ("cluster", pa.int32()), ("distance", pa.int64())])

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tournament = Tournament(centroids)
        for batch in batches:
            chosen, values = finite_rows(batch.column("embedding"), dimensions)
            if len(values):
                champion, distance = tournament.nearest(scaled(values, scale))
                fits = [int(d) if d <= LONG else None for d in distance]
                ids = batch.column("vec_id").filter(pa.array(chosen))
                yield pa.RecordBatch.from_arrays([ids, pa.array(champion, pa.int32()), pa.array(fits, pa.int64())], schema=schema)

    return assigned


def first_centroids(vectors: DataFrame, dimensions: int, scale: int, centroids: int, seed: str) -> list[list[int]]:
    """The kept vectors with the least sha256 of ``seed:vec_id``; equal ids by their components."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    kept = vectors.filter((F.size("embedding") == dimensions) & F.forall("embedding", good))
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    least = kept.select("embedding", F.sha2(named, 256).alias("hash")).orderBy("hash", "embedding").limit(centroids)
    cut = lambda x: max(-LARGEST, min(LARGEST, math.floor(scale * float(x))))
    return [[cut(x) for x in row.embedding] for row in least.collect()]


def cluster_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: str = "1",
) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance, cluster_inertia, inertia) of each kept vector, final centroids).

    Kept are vectors with exactly ``dimensions`` components, none null or not finite.  Others have no
    row.  Component x counts as floor(``scale`` * x).  In each round every vector goes to its nearest
    centroid (ties: smaller number) and every centroid that got vectors moves to their componentwise
    floor(sum / count).  Fewer vectors than ``centroids``: each is a centroid.  Repeated rows and null
    ids are rows like others; a null id is hashed as an empty one.  No kept vector: no rows.  Other
    columns are ignored.  A squared distance that no long can hold is null, and so are the sums it
    belongs to; components beyond 2**62 in size count as 2**62.
    """
    rows = vectors.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("embedding")
    )
    found = first_centroids(rows, dimensions, scale, centroids, seed)
    id_ddl = rows.schema["vec_id"].dataType.simpleString()
    if not found:
        empty = f"vec_id {id_ddl}, cluster int, distance long, cluster_inertia long, inertia long"
        return vectors.sparkSession.createDataFrame([], empty), []
    components = rows.select("embedding")
    for _ in range(rounds):
        parts = components.mapInArrow(_sums(found, dimensions, scale), "cluster int, place int, total decimal(38,0)")
        sums = {(r.cluster, r.place): int(r.total) for r in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect()}
        found = [
            [sums[c, at] // sums[c, -1] for at in range(dimensions)] if (c, -1) in sums else old
            for c, old in enumerate(found)
        ]
    from pyspark.sql.pandas.types import to_arrow_type

    assign = _assigned(found, dimensions, scale, to_arrow_type(rows.schema["vec_id"].dataType))
    members = written(rows.mapInArrow(assign, f"vec_id {id_ddl}, cluster int, distance long"), "cluster-members")
    exact = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    totals = {r.cluster: r.total for r in members.groupBy("cluster").agg(exact.alias("total")).collect()}  # one row a centroid
    known = [totals.get(c, 0) for c in range(len(found))]
    everything = None if None in known else sum(int(t) for t in known)

    def number(total) -> Column:
        return F.lit(None if total is None or total > LONG else int(total)).cast("long")

    by_cluster = F.element_at(F.array(*map(number, known)), F.col("cluster") + 1)
    return members.withColumns({"cluster_inertia": by_cluster, "inertia": number(everything)}), found


def centroid_digests(centroids: list[list[int]]) -> list[str]:
    """sha256 of each centroid's components, as decimal integers joined by commas."""
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
