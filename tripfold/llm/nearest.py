"""Nearest neighbours by inner product: int8 tiles first, then doubles for what survives.

Each vector is coded as int8 with a scale of its own.  The product of two codes differs
from the true one by no more than the norms of what the codes leave out allow, so a
candidate whose upper bound is below the best lower bounds found so far is out for sure;
the others are computed again from the original numbers and merged in heaps."""

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripfold.llm import frames, vectors

TILES_A_GROUP = 8
LEAST_GROUPS = 8
QUERY_TILES = 4  # of one group; a task holds the heaps of their queries
BLOCK = 512  # queries compared at a time


def quantised(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, norms of the coded vectors and norms of what the codes leave out."""
    rows = rows.astype(np.float64)
    scale = np.abs(rows).max(axis=1) / 127
    scale = np.where(scale > 0, scale, 1.0)
    codes = np.rint(rows / scale[:, None])
    coded = codes * scale[:, None]
    return (
        codes.astype(np.int8),
        scale,
        np.linalg.norm(coded, axis=1),
        np.linalg.norm(rows - coded, axis=1),
    )


def _tiles(found: DataFrame, dimension: int, kind: str, name: str) -> DataFrame:
    size = vectors.tile_rows(dimension, kind)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, part in vectors.gathered(batches, size, ["vec_id", "embedding"], kind):
            codes, scale, norm, rest = quantised(part["embedding"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tile], pa.int64()),
                    pa.array([part["vec_id"].astype("<i8").tobytes()], pa.binary()),
                    pa.array([part["embedding"].tobytes()], pa.binary()),
                    pa.array([codes.tobytes()], pa.binary()),
                    pa.array([np.stack([scale, norm, rest]).tobytes()], pa.binary()),
                ],
                ["tile", "ids", "data", "codes", "bounds"],
            )

    schema = "tile bigint, ids binary, data binary, codes binary, bounds binary"
    parts = max(1, found.count() // (2 * size))
    return frames.staged(found.repartition(parts, "vec_id").mapInArrow(pack, schema), name)


class _Tile:
    def __init__(self, row: dict, dimension: int, kind: str):
        self.ids = np.frombuffer(row["ids"], dtype="<i8")
        shape = (len(self.ids), dimension)
        self.rows = np.frombuffer(row["data"], dtype=kind).reshape(shape)
        codes = np.frombuffer(row["codes"], dtype=np.int8).reshape(shape)
        # Sums of at most 1024 products of int8 are whole numbers below 2^24, so single
        # precision holds them exactly; longer vectors use double precision.
        self.codes = codes.astype(np.float32 if dimension <= 1024 else np.float64)
        self.scale, self.norm, self.rest = np.frombuffer(row["bounds"]).reshape(3, -1)


class _Heaps:
    """The best ``k`` of each query so far, as heaps of (score, -id), the worst on top."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in queries]

    def worst(self, part: slice) -> np.ndarray:
        return np.array(
            [h[0][0] if len(h) >= self.k else -np.inf for h in self.heaps[part]], dtype=np.float64
        )

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        heap = self.heaps[query]
        for item in zip(scores.tolist(), (-ids).tolist(), strict=True):
            if len(heap) < self.k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)


def _search(query: _Tile, tile: _Tile, heaps: _Heaps) -> None:
    for start in range(0, len(query.ids), BLOCK):
        part = slice(start, start + BLOCK)
        products = (query.codes[part] @ tile.codes.T).astype(np.float64)
        products *= query.scale[part, None] * tile.scale
        length = query.norm[part, None] + query.rest[part, None]
        error = length * tile.rest + query.rest[part, None] * tile.norm
        error += 1e-12 * length * (tile.norm + tile.rest)
        products[query.ids[part, None] == tile.ids] = -np.inf
        least = heaps.worst(part)
        if len(tile.ids) >= heaps.k:
            lower = np.partition(products - error, -heaps.k, axis=1)[:, -heaps.k]
            least = np.maximum(least, lower)
        survives = (products + error >= least[:, None]) & (products > -np.inf)
        which, where = np.nonzero(survives)
        scores = np.empty(len(which))
        for at in range(0, len(which), 1 << 16):
            some = slice(at, at + (1 << 16))
            terms = query.rows[start + which[some]].astype(np.float64)
            terms *= tile.rows[where[some]].astype(np.float64)
            # Added from the first component to the last, so that no other order differs.
            scores[some] = np.add.accumulate(terms, axis=1)[:, -1]
        cuts = np.searchsorted(which, np.arange(survives.shape[0] + 1))
        for k in range(survives.shape[0]):
            own = slice(cuts[k], cuts[k + 1])
            heaps.add(start + k, scores[own], tile.ids[where[own]])


def nearest(
    embeddings: DataFrame,
    queries: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Each query's ``k`` nearest: query_id, rank from 1, vec_id and score.

    ``queries`` is a condition on vec_id.  Every vector of the query's length but its own
    is a candidate; the result is exact.  Ties go to the smaller vec_id.  Null or zero
    vectors and those with a null or non-finite component take no part, nor do rows
    without an identifier; of rows that repeat an identifier one counts.  With fewer than
    ``k`` candidates all are returned; an empty table gives an empty result, and extra
    columns are ignored.

    Tasks form a grid: a group of candidate tiles meets a group of query tiles in one, which
    returns ``k`` rows a query.  A tile is sent once for each group of the other side, and
    the few rows of each task are ranked at the end."""
    found = frames.staged(vectors.unique_vectors(embeddings, id_col, vector_col), "vectors")
    kind = vectors.kind_of(found)
    parts = []
    for dimension in vectors.dimensions(found.where(queries)):
        same = found.where(F.size("embedding") == dimension)
        parts.append(_best_of_groups(same, same.where(queries), k, dimension, kind))
    schema = "query_id bigint, vec_id bigint, score double"
    empty = found.sparkSession.createDataFrame([], schema)
    best = reduce(DataFrame.unionByName, parts, empty)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _best_of_groups(
    found: DataFrame, queries: DataFrame, k: int, dimension: int, kind: str
) -> DataFrame:
    tiles = _tiles(found, dimension, kind, "candidate-tiles")
    asked = _tiles(queries, dimension, kind, "query-tiles")
    count, query_tiles = tiles.count(), asked.count()
    # Some groups to share the work; then so many rows a group that results stay few.
    rows = TILES_A_GROUP * vectors.tile_rows(dimension, kind)
    groups = max(1, min(count, LEAST_GROUPS), -(-found.count() // rows))
    query_groups = max(1, -(-query_tiles // QUERY_TILES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list[tuple[_Tile, _Heaps]]) -> pa.RecordBatch:
            rows = [
                (query, -other, score)
                for _, heaps in held
                for query, heap in zip(heaps.queries.tolist(), heaps.heaps, strict=True)
                for score, other in heap
            ]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))],
                ["query_id", "vec_id", "score"],
            )

        key, held = None, []
        for batch in frames.slices(batches, 1):
            row = batch.to_pylist()[0]
            if (row["q"], row["c"]) != key:
                if held:
                    yield done(held)
                key, held = (row["q"], row["c"]), []
            tile = _Tile(row, dimension, kind)
            if not row["candidate"]:  # queries come first
                held.append((tile, _Heaps(tile.ids, k)))
                continue
            for query, heaps in held:
                _search(query, tile, heaps)
        if held:
            yield done(held)

    def group_of(size: int) -> Column:
        return F.pmod(F.xxhash64("tile"), F.lit(size)).cast("int")

    def every(size: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(size - 1)))

    columns = ("ids", "data", "codes", "bounds")
    candidates = tiles.select(
        every(query_groups).alias("q"), group_of(groups).alias("c"), F.lit(True).alias("candidate"), *columns
    )
    queried = asked.select(
        group_of(query_groups).alias("q"), every(groups).alias("c"), F.lit(False).alias("candidate"), *columns
    )
    grid = (
        queried.unionAll(candidates.select(*queried.columns))
        .repartition(max(1, groups * query_groups), "q", "c")
        .sortWithinPartitions("q", "c", "candidate")
    )
    return grid.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
