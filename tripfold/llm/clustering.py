"""Lloyd's algorithm over shards of columns, in exact whole numbers.

A block of vectors is cut into shards of neighbouring columns.  A task that holds a shard of
a block needs only that slice of the centroids: it gives exact partial squared distances,
which are added block by block before the nearest centroid is taken.  The assignments go back
to the shards, and each shard's sums move its own slice.  The shards of a block are dealt to
one partition once and stay there, so of a round only the sums are shuffled."""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm import frames

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = "3"
SHARD_COLUMNS = 32
BLOCK_ROWS = 8192
#: Squared distances of larger components would not fit the 64 bits of the result.
LARGEST = 1 << 27


def whole_vectors(
    frame: DataFrame, dimensions: int, scale: int, id_col: str, vector_col: str
) -> DataFrame:
    """vec_id and x, the floors of the scaled components, of the vectors that take part."""
    rows = frames.narrow(frame, vec_id=id_col, embedding=vector_col)
    finite = F.forall(
        "embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))
    )
    sound = F.coalesce((F.size("embedding") == dimensions) & finite, F.lit(False))

    def whole(component):
        value = F.floor(component.cast("double") * scale)
        return F.when(F.abs(component) < LARGEST / scale, value).otherwise(
            F.raise_error(F.lit("a component is too large for exact 64-bit distances"))
        )

    return rows.where(sound).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform("embedding", whole).alias("x"),
    )


def first_centroids(vectors: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors whose seeded identifiers hash least; a null identifier comes last."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    chosen = vectors.select(place.alias("place"), "x").orderBy(F.asc_nulls_last("place"), "x")
    return np.array([r.x for r in chosen.limit(clusters).collect()], dtype=np.int64)


def blocks(vectors: DataFrame, rows: int, columns: int) -> DataFrame:
    """block, shard and data: each shard's columns of a block as bytes; the identifiers are
    the shard -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, parts = TaskContext.get().partitionId() << 32, [], []

        def done() -> pa.RecordBatch:
            table, x = pa.concat_arrays(ids), np.concatenate(parts)
            validity = np.array(table.is_valid().to_pylist(), dtype=bool)
            numbers = table.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data = [numbers.tobytes() + validity.tobytes()]
            data += [
                np.ascontiguousarray(x[:, at : at + columns]).tobytes()
                for at in range(0, x.shape[1], columns)
            ]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(data), pa.int64()),
                    pa.array(range(-1, len(data) - 1), pa.int32()),
                    pa.array(data, pa.binary()),
                ],
                ["block", "shard", "data"],
            )

        for batch in batches:
            for part in frames.slices([batch], rows):
                x = part.column("x").flatten().to_numpy(zero_copy_only=False)
                if ids and sum(map(len, ids)) + part.num_rows > rows:
                    yield done()
                    block, ids, parts = block + 1, [], []
                ids.append(part.column("vec_id"))
                parts.append(x.reshape(part.num_rows, -1).astype(np.int64))
        if ids:
            yield done()

    return vectors.mapInArrow(run, "block bigint, shard int, data binary")


@dataclass(frozen=True)
class Moved:
    """What a shard knows of its new slice: sums of each centroid's vectors, and how many.

    Sums are Python's whole numbers, so no corpus is too large for them."""

    sums: np.ndarray
    counts: np.ndarray

    def __add__(self, other: "Moved") -> "Moved":
        return Moved(self.sums + other.sums, self.counts + other.counts)

    def slice(self, before: np.ndarray) -> np.ndarray:
        """Floored means; a centroid without vectors stays."""
        after = before.copy()
        for c in np.flatnonzero(self.counts):
            after[c] = [int(total) // int(self.counts[c]) for total in self.sums[c]]
        return after


def by_block(key) -> int:
    """Where a block goes, alone or with one of its shards."""
    return zlib.crc32(str(key[1] if isinstance(key, tuple) else key).encode())


class Lloyd:
    """The shards of all blocks, kept where they are dealt, and one round over them."""

    def __init__(self, staged: DataFrame, columns: int, dimensions: int):
        self.context = staged.sparkSession.sparkContext
        self.starts = list(range(0, dimensions, columns))
        self.columns = columns
        shards = staged.where("shard >= 0").select("shard", "block", "data").rdd
        self.shards: RDD = (
            shards.map(lambda r: ((r.shard, r.block), bytes(r.data)))
            .partitionBy(max(2, shards.getNumPartitions()), by_block)
            .persist(StorageLevel.DISK_ONLY)
        )
        self.parts = self.shards.getNumPartitions()

    def slices(self, centroids: np.ndarray) -> list[np.ndarray]:
        return [centroids[..., at : at + self.columns] for at in self.starts]

    def nearest(self, centroids: np.ndarray) -> RDD:
        """block and, for each of its rows, the nearest centroid and the distance; of equally
        near ones the first."""
        held = self.context.broadcast(self.slices(centroids))

        def partial(shards):
            for (number, block), data in shards:
                own = held.value[number]
                x = np.frombuffer(data, dtype=np.int64).reshape(-1, own.shape[1])
                distance = np.empty((len(x), len(own)), dtype=np.int64)
                for c, centre in enumerate(own):
                    distance[:, c] = ((x - centre) ** 2).sum(axis=1)
                yield block, distance

        def least(distance):
            best = distance.argmin(axis=1)
            return best.astype(np.int32), distance[np.arange(len(best)), best]

        parts = self.shards.mapPartitions(partial, preservesPartitioning=True)
        return parts.reduceByKey(np.add, self.parts, by_block).mapValues(least)

    def moved(self, centroids: np.ndarray) -> np.ndarray:
        """The centroids after one round; the driver sees one slice of them a shard."""
        held = self.context.broadcast(self.slices(centroids))
        numbers = range(len(self.starts))
        clusters = len(centroids)

        def to_shards(assigned):
            for block, (best, _) in assigned:
                for number in numbers:
                    yield (number, block), best

        def sums(pair):
            (number, _), values = pair
            data, best = sorted(values, key=lambda value: not isinstance(value, bytes))
            x = np.frombuffer(data, dtype=np.int64).reshape(len(best), -1)
            total = np.zeros((clusters, x.shape[1]), dtype=np.int64)
            for c in range(clusters):
                total[c] = x[best == c].sum(axis=0)
            return number, Moved(total.astype(object), np.bincount(best, minlength=clusters))

        assigned = self.nearest(centroids).mapPartitions(to_shards, preservesPartitioning=True)
        own = self.shards.union(assigned).groupByKey(self.parts, by_block).map(sums)
        update = own.reduceByKey(lambda one, other: one + other, len(self.starts)).map(
            lambda pair: (pair[0], pair[1].slice(held.value[pair[0]]))
        )
        return np.hstack([part for _, part in sorted(update.collect(), key=lambda p: p[0])])


def cluster(
    frame: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: str = SEED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_columns: int = SHARD_COLUMNS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid (its components).

    Vectors that are null, of another length or hold a null or non-finite component take no
    part.  Repeated rows are vectors of their own, and so is a row without an identifier,
    whose hash comes last among the first centroids.  Fewer vectors than ``clusters`` give
    as many centroids as there are vectors; ties go to the smaller number; an empty table
    gives no row.  A component of 2^27 / ``scale`` or more is an error, since its distance
    would not fit the result.  Extra columns are ignored."""
    session = frame.sparkSession
    vectors = whole_vectors(frame, dimensions, scale, id_col, vector_col)
    centroids = first_centroids(vectors, clusters, seed)
    staged = frames.staged(blocks(vectors, block_rows, shard_columns), "column-blocks")
    work = Lloyd(staged, shard_columns, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        centroids = work.moved(centroids)
    nearest = work.nearest(centroids).map(
        lambda pair: (pair[0], pair[1][0].tobytes(), pair[1][1].tobytes())
    )
    found = session.createDataFrame(nearest, "block bigint, best binary, distance binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames.slices(batches, 1):
            best = np.frombuffer(batch.column("best")[0].as_py(), dtype=np.int32)
            distance = np.frombuffer(batch.column("distance")[0].as_py(), dtype=np.int64)
            data = batch.column("data")[0].as_py()
            valid = np.frombuffer(data[8 * len(best) :], dtype=bool)
            ids = np.frombuffer(data[: 8 * len(best)], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=~valid), pa.array(best), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )

    ids = staged.where("shard = -1").select("block", "data")
    assigned = frames.staged(
        found.join(ids, "block")
        .select("best", "distance", "data")
        .mapInArrow(run, "vec_id bigint, cluster int, distance bigint"),
        "assigned",
    )
    work.shards.unpersist()
    inertia = (
        assigned.groupBy("cluster")
        .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
        .collect()
    )
    every = sum(int(r.own) for r in inertia)
    rows = [
        (r.cluster, int(r.own), every, [int(x) for x in centroids[r.cluster]]) for r in inertia
    ]
    centres = session.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    )
    return assigned.join(F.broadcast(centres), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
