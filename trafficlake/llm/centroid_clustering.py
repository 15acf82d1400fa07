"""Centroid clustering that rescans only vectors whose nearest centroid is in doubt.

Each vector carries an upper bound of the distance to its own centroid and a lower bound of the distance to
every other one. When centroids move, the upper bound grows by the own centroid's way. The lower bound shrinks
by less than the longest way: all vectors of a cluster lie in a sphere around its centroid, and from within that
sphere a centroid that moves from c to c' comes closer by at most ``|c' - c| * cos(angle)``, the smallest angle at
the middle of the way between its direction and a point of the sphere (in the plane of the three centroids; at
90 degrees or more it comes no closer). Vectors whose bounds still part keep their cluster; the others are
compared with all centroids in whole numbers, ties included, so the result is that of comparing every vector.

Vectors travel in blocks with their bounds and the block's sums by cluster. A round writes the next generation
of blocks and removes the one before; the driver sees sums and centroids only.
"""

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.paths import remove
from trafficlake.session import scratch_dir

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
SCALE = 1024
#: Vectors of a block.
BLOCK = 4096
#: Components up to this size, scaled, keep squared distances within 64 bits.
LARGEST = 1 << 27

#: Relative slack for rounding in bounds.
_SLACK = 1e-9
_STATE = (
    "ids array<bigint>, vectors binary, own binary, upper binary, lower binary, "
    "sums array<bigint>, sizes array<bigint>, radii array<double>, scanned bigint"
)
_RESULT = "vec_id bigint, cluster int, distance bigint"


class Move(NamedTuple):
    """What a task needs to know of a round: the centroids, and by cluster how bounds change."""

    centroids: np.ndarray
    drift: np.ndarray
    """Way of each centroid, which loosens upper bounds."""
    loosening: np.ndarray
    """How much closer any other centroid can have come to a vector of the cluster."""
    half: np.ndarray
    """Half the distance to the nearest other centroid."""


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors by centroids."""
    largest = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    # Doubles are exact as long as all sums stay below 2^53.
    kind = np.float64 if largest * largest * vectors.shape[1] * 4 < 1 << 53 else np.int64
    x, c = vectors.astype(kind), centroids.astype(kind)
    return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)


def loosenings(before: np.ndarray, after: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """For each cluster, how much closer any other centroid can have come to a point of the cluster's sphere."""
    before, after = before.astype(np.float64), after.astype(np.float64)
    way = after - before
    drift = np.sqrt((way * way).sum(1))
    middle = (before + after) / 2
    k = len(before)
    loose = np.zeros((k, k))
    for own in range(k):
        arm = before[own] - middle
        reach = np.sqrt((arm * arm).sum(1))
        with np.errstate(divide="ignore", invalid="ignore"):
            angle = np.arccos(np.clip((arm * way).sum(1) / (reach * drift), -1, 1))
            angle = angle - np.arcsin(np.minimum(radii[own] / reach, 1))
        # Inside the sphere, or with its centre at the middle, every direction is possible.
        cosine = np.where(reach > radii[own] * (1 + _SLACK), np.cos(np.clip(angle, 0, np.pi / 2)), 1.0)
        loose[own] = np.where(drift > 0, np.minimum(cosine + _SLACK, 1.0) * drift, 0.0)
        loose[own, own] = 0.0
    return loose.max(axis=1) if k > 1 else np.zeros(k)


def _move(before: np.ndarray, after: np.ndarray, radii: np.ndarray) -> Move:
    way = (after - before).astype(np.float64)
    apart = np.sqrt(squared_distances(after, after).astype(np.float64))
    np.fill_diagonal(apart, np.inf)
    drift = np.sqrt((way * way).sum(1))
    return Move(after, drift, loosenings(before, after, radii), apart.min(axis=1) / 2)


class _Block:
    """Vectors with their clusters and bounds."""

    def __init__(self, ids: pa.Array, vectors: np.ndarray, own=None, upper=None, lower=None, sums=None):
        self.ids, self.vectors = ids, vectors
        self.own, self.upper, self.lower, self.sums = own, upper, lower, sums
        self.scanned = 0

    @classmethod
    def read(cls, batch: pa.RecordBatch, row: int) -> "_Block":
        def numbers(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(batch[name][row].as_buffer(), kind).copy()

        vectors = numbers("vectors", "<i4").reshape(-1, DIMENSIONS)
        sums = batch["sums"][row].values.to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS).copy()
        return cls(batch["ids"][row].values, vectors, numbers("own", "<i4"), numbers("upper", "<f8"), numbers("lower", "<f8"), sums)

    def _scan(self, which: np.ndarray, centroids: np.ndarray) -> None:
        """Compare some vectors with all centroids; the smaller number wins ties."""
        squared = squared_distances(self.vectors[which], centroids)
        best = squared.argmin(axis=1)
        rows = np.arange(len(best))
        distances = np.sqrt(squared.astype(np.float64))
        self.upper[which] = distances[rows, best] * (1 + _SLACK)
        distances[rows, best] = np.inf
        self.lower[which] = distances.min(axis=1) * (1 - _SLACK)
        before, self.own[which] = self.own[which], best
        moved = before != best
        np.subtract.at(self.sums, before[moved & (before >= 0)], self.vectors[which][moved & (before >= 0)])
        np.add.at(self.sums, best[moved], self.vectors[which][moved])
        self.scanned = len(best)

    def start(self, centroids: np.ndarray) -> None:
        n = len(self.vectors)
        self.own, self.upper, self.lower = np.full(n, -1, np.int32), np.zeros(n), np.zeros(n)
        self.sums = np.zeros(centroids.shape, np.int64)
        self._scan(np.arange(n), centroids)

    def follow(self, move: Move) -> None:
        """Loosen the bounds by a move of the centroids and scan the vectors that are then in doubt."""
        self.upper += move.drift[self.own] * (1 + _SLACK)
        self.lower -= move.loosening[self.own] * (1 + _SLACK)
        known = np.maximum(self.lower, move.half[self.own] * (1 - _SLACK))
        doubt = np.flatnonzero(self.upper >= known)
        way = (self.vectors[doubt] - move.centroids[self.own[doubt]]).astype(np.int64)
        self.upper[doubt] = np.sqrt((way * way).sum(1).astype(np.float64)) * (1 + _SLACK)
        doubt = doubt[self.upper[doubt] >= known[doubt]]
        if len(doubt):
            self._scan(doubt, move.centroids)

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        way = self.vectors - centroids[self.own]
        return (way * way).sum(1)

    def written(self, k: int) -> pa.RecordBatch:
        radii = np.zeros(k)
        np.maximum.at(radii, self.own, self.upper)
        columns = {
            "ids": pa.ListArray.from_arrays([0, len(self.ids)], self.ids),
            "vectors": pa.array([self.vectors.astype("<i4").tobytes()], pa.binary()),
            "own": pa.array([self.own.astype("<i4").tobytes()], pa.binary()),
            "upper": pa.array([self.upper.astype("<f8").tobytes()], pa.binary()),
            "lower": pa.array([self.lower.astype("<f8").tobytes()], pa.binary()),
            "sums": pa.array([self.sums.reshape(-1)], pa.list_(pa.int64())),
            "sizes": pa.array([np.bincount(self.own, minlength=k)], pa.list_(pa.int64())),
            "radii": pa.array([radii], pa.list_(pa.float64())),
            "scanned": pa.array([self.scanned], pa.int64()),
        }
        return pa.RecordBatch.from_pydict(columns)


def kept_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, components): vectors of ``embeddings`` (vec_id, embedding; other columns are ignored) with exactly 64
    components, none null or non-finite, as whole numbers ``floor(1024 x)``.

    A component beyond 131,072 in size raises an error: squared distances would not fit 64 bits.
    """
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    whole = F.transform(
        "x",
        lambda v: F.when(F.abs(v) <= LARGEST // SCALE, F.floor(v * SCALE)).otherwise(
            F.raise_error(F.lit("a vector's component is too large for 64-bit distances")).cast("bigint")
        ),
    )
    return rows.where((F.size("x") == DIMENSIONS) & finite).select("vec_id", whole.alias("components"))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 digest of ``seed:vec_id``, in that order; of vectors with the same id
    the one with the smaller components comes first. Vectors without an id are not taken, and fewer vectors give
    fewer centroids."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.where(F.col("vec_id").isNotNull()).orderBy(digest, "components").limit(k).collect()
    return np.array([r["components"] for r in first], np.int64).reshape(len(first), DIMENSIONS)


def _started(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            part = batch.slice(at, BLOCK)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
            block = _Block(part.column(0), flat)
            block.start(centroids)
            yield block.written(len(centroids))


def _followed(batches: Iterator[pa.RecordBatch], move: Move) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            block = _Block.read(batch, row)
            block.follow(move)
            yield block.written(len(move.centroids))


def _finished(batches: Iterator[pa.RecordBatch], move: Move) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            block = _Block.read(batch, row)
            block.follow(move)
            columns = [block.ids, pa.array(block.own, pa.int32()), pa.array(block.distances(move.centroids), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])


def _moved(state: DataFrame, before: np.ndarray) -> Move:
    """The round's move: each centroid with vectors goes to the floor of their mean."""
    k = len(before)
    added = state.select(F.posexplode(F.concat("sums", "sizes")).alias("at", "n"))
    total = {r["at"]: int(r["n"]) for r in added.groupBy("at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()}
    radius = state.agg(*[F.max(F.get("radii", i)).alias(f"r{i}") for i in range(k)]).first()
    after = before.copy()
    for c in range(k):
        size = total[k * DIMENSIONS + c]
        if size:
            after[c] = [total[c * DIMENSIONS + d] // size for d in range(DIMENSIONS)]
    return _move(before, after, np.array(list(radius)) * (1 + _SLACK))


class Clustering(NamedTuple):
    vectors: DataFrame
    """vec_id, cluster, distance (squared): one row a vector that was kept."""
    centroids: np.ndarray
    scanned: list[int]
    """Vectors compared with all centroids, by round."""


def cluster(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> Clustering:
    """Lloyd's rounds over whole-number vectors (``kept_vectors``) from ``first_centroids``.

    Each round assigns every vector to the nearest centroid (the smaller number if two are as near) and moves
    each centroid with vectors to the floor of their mean, by component; then vectors are assigned once
    more. Vectors that repeat, or have no id, are vectors like any other. With no vector with an id there are no
    centroids, and an empty result.
    """
    spark = embeddings.sparkSession
    vectors = kept_vectors(embeddings)
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return Clustering(spark.createDataFrame([], _RESULT), centroids, [])
    state, path = _written(spark, vectors.mapInArrow(lambda b, c=centroids: _started(b, c), _STATE))
    scanned = []
    try:
        for i in range(rounds):
            scanned.append(state.agg(F.sum("scanned")).first()[0])
            move = _moved(state, centroids)
            centroids = move.centroids
            if i < rounds - 1:
                old = path
                state, path = _written(spark, state.mapInArrow(lambda b, m=move: _followed(b, m), _STATE))
                remove(spark, old)
        out = scratch_dir(spark, "clusters")
        last = state.mapInArrow(lambda b: _finished(b, move), _RESULT) if rounds else _unmoved(state, centroids)
        last.write.parquet(out)
    finally:
        remove(spark, path)
    return Clustering(spark.read.schema(_RESULT).parquet(out), centroids, scanned)


def _unmoved(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    move = _move(centroids, centroids, np.zeros(len(centroids)))
    return state.mapInArrow(lambda b: _finished(b, move), _RESULT)


def _written(spark: SparkSession, state: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_dir(spark, "cluster-blocks")
    state.write.parquet(path)
    return spark.read.schema(_STATE).parquet(path), path


def described(found: Clustering) -> DataFrame:
    """The vectors with their cluster's inertia, that of all, and a digest of their final centroid."""
    spark = found.vectors.sparkSession
    inertia = {r["cluster"]: int(r["d"]) for r in found.vectors.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.centroids]
    rows = [(c, inertia.get(c, 0), sum(inertia.values()), digest) for c, digest in enumerate(digests)]
    # As many rows as there are clusters.
    clusters = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.vectors.join(F.broadcast(clusters), "cluster")
