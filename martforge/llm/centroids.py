"""k-means whose vectors wait in heaps until their bound expires.

Every cluster keeps a heap of its vectors, ordered by the gap between the
distance to the second nearest centroid and the distance to its own. When
centroids move, a vector of cluster j can lose at most the move of j plus the
largest move of any other centroid; this loss is added up per cluster and is
not written into the heaps: a key is the gap at insertion plus the loss up to
then. Only vectors whose key is no longer above the accumulated loss are
popped and compared with all centroids again; the others cannot have changed.

Vectors are integers (floor of scale * x), centroids are exact floors of sum /
count, all distances are exact, and keys are rounded towards expiry, so the
result is that of comparing every vector with every centroid in every round.

On Spark: vectors are packed into blocks and written once, bucketed by block.
The heaps of a block are one small row of a table that every round writes
anew; a round joins it with the buckets, so that vectors are never exchanged
again. A round sends the driver k * (dimension + 1) sums, whatever the number
of vectors. All tables lie in the shared folder: lost executors re-read them.

Defined results: vectors of another length, with null or with non-finite
components are left out; equal vectors and repeated rows are all clustered;
ties go to the smaller centroid number; a null id is kept and comes last among
the initial centroids; with fewer vectors than k there are fewer centroids, an
empty table gives an empty result; other columns are ignored, whatever their
names. Components beyond 2^27 after scaling are an error, as their squared
distances leave 64 bits.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, materialize, new_work_dir, shuffle_partitions

BLOCK_ROWS = 1024
COMPONENT_LIMIT = 1 << 27     # squared distances of 64 components stay below 2^63
FLOAT_LIMIT = 1 << 22         # up to here they are exact in doubles, too
SLACK = 1e-9                  # keys are lowered by this share of the distances
STATE = "block bigint, sizes array<int>, keys binary, members binary, delta array<bigint>, rescanned bigint"


def finite_vectors(df: DataFrame, vector: str, dimension: int) -> Column:
    """Whether the vector column has ``dimension`` finite components."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) == dimension) & fine, F.lit(False))


def _pack(scale: int, dimension: int, id_type: pa.DataType) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                scaled = np.floor(scale * flat)
                if len(scaled) and np.abs(scaled).max() > COMPONENT_LIMIT:
                    raise ValueError("a component is beyond 2^27 after scaling")
                vectors = scaled.astype(np.int32)
                if len(vectors) and np.abs(vectors).max() < 1 << 15:
                    vectors = vectors.astype(np.int16)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0).cast(id_type))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), ids, pa.array([vectors.tobytes()], pa.binary())],
                    names=["block", "ids", "vectors"])
                block += 1
    return pack


def _vectors(data: bytes, rows: int, dimension: int) -> np.ndarray:
    width = np.int16 if len(data) == 2 * rows * dimension else np.int32
    return np.frombuffer(data, width).reshape(rows, dimension).astype(np.int64)


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows by centroids, as 64-bit integers."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if largest <= FLOAT_LIMIT:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    out = np.empty((len(x), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        diff = x - c
        out[:, j] = (diff * diff).sum(1)
    return out


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, gap) of every row: the smallest number among the nearest, and
    a lower bound of the distance that separates it from the second."""
    d = squared_distances(x, centroids)
    cluster = d.argmin(1)
    if len(centroids) == 1:
        return cluster, np.full(len(x), np.inf)
    two = np.partition(d, 1, axis=1)[:, :2]
    first, second = np.sqrt(two[:, 0].astype(np.float64)), np.sqrt(two[:, 1].astype(np.float64))
    return cluster, second - first - SLACK * (1.0 + second)


def losses(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """What the gap of a vector of each cluster can lose by one move."""
    diff = (old - new).astype(np.float64)
    moves = np.sqrt((diff * diff).sum(1)) * (1 + SLACK)
    if len(moves) == 1:
        return np.zeros(1)
    top = np.argsort(moves)[-2:]
    others = np.where(np.arange(len(moves)) == top[1], moves[top[0]], moves[top[1]])
    return moves + others


class Heaps:
    """The heaps of one block: per cluster a list of (key, row)."""

    def __init__(self, heaps: list[list[tuple[float, int]]]):
        self.heaps = heaps

    @classmethod
    def build(cls, cluster: np.ndarray, keys: np.ndarray, k: int) -> "Heaps":
        order = np.lexsort((keys, cluster))  # a sorted list is a heap
        bounds = np.searchsorted(cluster[order], np.arange(k + 1))
        pairs = list(zip(keys[order].tolist(), order.tolist()))
        return cls([pairs[bounds[j]:bounds[j + 1]] for j in range(k)])

    @classmethod
    def load(cls, sizes: list[int], keys: bytes, members: bytes) -> "Heaps":
        pairs = list(zip(np.frombuffer(keys, np.float64).tolist(), np.frombuffer(members, np.int32).tolist()))
        ends = np.cumsum(sizes).tolist()
        return cls([pairs[e - n:e] for n, e in zip(sizes, ends)])

    def dump(self) -> tuple[list[int], bytes, bytes]:
        flat = [p for heap in self.heaps for p in heap]
        return ([len(h) for h in self.heaps], np.array([p[0] for p in flat], np.float64).tobytes(),
                np.array([p[1] for p in flat], np.int32).tobytes())

    def expired(self, loss: np.ndarray) -> tuple[list[int], list[int]]:
        """Pop every vector whose gap may be used up: (rows, their clusters)."""
        rows, clusters = [], []
        for j, heap in enumerate(self.heaps):
            limit = loss[j]
            while heap and heap[0][0] <= limit:
                rows.append(heapq.heappop(heap)[1])
                clusters.append(j)
        return rows, clusters

    def push(self, cluster: np.ndarray, keys: np.ndarray, rows: list[int]) -> None:
        for j, key, row in zip(cluster.tolist(), keys.tolist(), rows):
            heapq.heappush(self.heaps[j], (key, row))

    def assignment(self, rows: int) -> np.ndarray:
        out = np.empty(rows, np.int32)
        for j, heap in enumerate(self.heaps):
            out[[row for _, row in heap]] = j
        return out


def _assign(x: np.ndarray, state: dict | None, centroids: np.ndarray, loss: np.ndarray,
            delta: np.ndarray | None) -> tuple[Heaps, int]:
    """Bring the heaps of a block up to date; add what its clusters gained and
    lost (sums, then counts) to ``delta``. Returns the heaps and how many rows
    were compared with all centroids."""
    k = len(centroids)
    if state is None:
        cluster, gap = nearest(x, centroids)
        heaps, rows, came, left = Heaps.build(cluster, gap + loss[cluster], k), np.arange(len(x)), cluster, None
    else:
        heaps = Heaps.load(state["sizes"], state["keys"], state["members"])
        popped, old = heaps.expired(loss)
        rows, left = np.array(popped, np.int64), np.array(old, np.int64)
        if not len(rows):
            return heaps, 0
        came, gap = nearest(x[rows], centroids)
        heaps.push(came, gap + loss[came], popped)
    if delta is not None:
        ones = np.concatenate([x[rows], np.ones((len(rows), 1), np.int64)], axis=1)
        if left is None:
            np.add.at(delta, came, ones)
        else:
            moved = came != left
            np.add.at(delta, came[moved], ones[moved])
            np.subtract.at(delta, left[moved], ones[moved])
    return heaps, len(rows)


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int, with_state: bool):
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            ids = row.column("ids").flatten()
            x = _vectors(row.column("vectors")[0].as_py(), len(ids), dimension)
            state = {c: row.column(c)[0].as_py() for c in ("sizes", "keys", "members")} if with_state else None
            yield row.column("block")[0].as_py(), ids, x, state


def _round(centroids: np.ndarray, loss: np.ndarray, with_state: bool) -> Callable:
    k, dimension = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int64()), ("sizes", pa.list_(pa.int32())), ("keys", pa.binary()),
                            ("members", pa.binary()), ("delta", pa.list_(pa.int64())), ("rescanned", pa.int64())])
        delta, scanned = np.zeros((k, dimension + 1), np.int64), 0
        for block, _, x, state in _blocks(batches, dimension, with_state):
            heaps, n = _assign(x, state, centroids, loss, delta)
            scanned += n
            sizes, keys, members = heaps.dump()
            yield pa.RecordBatch.from_pylist([{"block": block, "sizes": sizes, "keys": keys, "members": members}], schema)
        if scanned:  # one row a task: what its clusters gained
            yield pa.RecordBatch.from_pylist([{"delta": delta.ravel().tolist(), "rescanned": scanned}], schema)
    return run


def _final(centroids: np.ndarray, loss: np.ndarray, with_state: bool) -> Callable:
    dimension = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, x, state in _blocks(batches, dimension, with_state):
            cluster = _assign(x, state, centroids, loss, None)[0].assignment(len(x))
            diff = x - centroids[cluster]
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster), pa.array((diff * diff).sum(1))],
                                             names=["id", "cluster", "distance"])
    return run


def initial_centroids(kept: DataFrame, k: int, seed: int, scale: int) -> np.ndarray:
    """The k vectors whose id has the smallest hash; null ids come last, equal
    ids are ordered by their vectors. k rows reach the driver."""
    scaled = F.transform(F.col("vector"), lambda x: F.floor(F.lit(float(scale)) * x))
    rows = kept.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("h"), scaled.alias("v")) \
        .orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _write_bucketed(blocks: DataFrame, buckets: int) -> DataFrame:
    """Blocks in a table bucketed by block number, so that later joins on it
    leave them where they are. The folder outlives its catalog entry."""
    spark = blocks.sparkSession
    name = f"martforge_blocks_{uuid.uuid4().hex}"
    blocks.repartition(buckets, "block").write.bucketBy(buckets, "block") \
        .option("path", new_work_dir(spark, "intermediate/blocks")).saveAsTable(name)
    return spark.table(name)


def cluster_vectors(df: DataFrame, id_column: str, vector_column: str, k: int = 40, rounds: int = 5,
                    dimension: int = 64, scale: int = 256, seed: int = 2) -> tuple[DataFrame, np.ndarray, list[int]]:
    """(id, cluster, distance) of every kept vector after ``rounds`` rounds, the
    final centroids, and the rows that each round compared with all centroids.
    The result is a written table."""
    spark = df.sparkSession
    kept = df.where(finite_vectors(df, vector_column, dimension)) \
        .select(F.col(vector_column).cast("array<double>").alias("vector"), F.col(id_column).alias("id")).select("id", "vector")
    id_type = kept.schema["id"].dataType
    empty = T.StructType([T.StructField("id", id_type), T.StructField("cluster", T.IntegerType()),
                          T.StructField("distance", T.LongType())])
    centroids = initial_centroids(kept, k, seed, scale)
    if not len(centroids):
        return spark.createDataFrame([], empty), centroids, []
    from pyspark.sql.pandas.types import to_arrow_type
    packed = arrow_map(kept, _pack(scale, dimension, to_arrow_type(id_type)),
                       f"block bigint, ids array<{id_type.simpleString()}>, vectors binary")
    blocks = _write_bucketed(packed, min(shuffle_partitions(spark), 100_000))
    sums = np.zeros((len(centroids), dimension + 1), dtype=object)
    loss, state, scans = np.zeros(len(centroids)), None, []

    def joined() -> DataFrame:
        if state is None:
            return blocks
        return blocks.join(state.where("block is not null").select("block", "sizes", "keys", "members")
                           .hint("shuffle_hash"), "block")

    for _ in range(rounds):
        state = materialize(arrow_map(joined(), _round(centroids, loss, state is not None), STATE), "heaps")
        gained = state.where("block is null")
        for pos, total in gained.select(F.posexplode("delta").alias("pos", "n")).groupBy("pos").agg(F.sum("n")).collect():
            sums[pos // (dimension + 1), pos % (dimension + 1)] += total
        scans.append(gained.agg(F.coalesce(F.sum("rescanned"), F.lit(0))).first()[0])
        moved = centroids.copy()
        for j in range(len(centroids)):
            if sums[j, dimension]:
                moved[j] = [int(s) // int(sums[j, dimension]) for s in sums[j, :dimension]]
        loss = loss + losses(centroids, moved)
        centroids = moved
    assigned = arrow_map(joined(), _final(centroids, loss, state is not None),
                         f"id {id_type.simpleString()}, cluster int, distance bigint")
    return materialize(assigned, "assigned"), centroids, scans


def clustered(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", **settings) -> DataFrame:
    """Per kept vector: its id, cluster, squared distance, the distances summed
    over its cluster and over all, and the digest of its final centroid."""
    assigned, centroids, _ = cluster_vectors(df, id_column, vector_column, **settings)
    spark = df.sparkSession
    per = {r[0]: r[1] for r in assigned.groupBy("cluster").agg(F.sum("distance")).collect()}  # k rows at most
    rows = [(j, per[j], sum(per.values()), hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest())
            for j in sorted(per)]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster") \
        .select(F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
