"""Near-duplicate vectors by tiles in the order of their principal axes.

Vectors are scaled to length one and turned so that leading coordinates hold most of the
sum of squares.  A tile holds vectors that are neighbours along the first axis.  Two tiles
whose boxes are too far apart are never compared; in the others the products of the leading
coordinates are summed first, what the rest can add is bounded by the norms of the
suffixes, and only rows that can still reach the threshold go on."""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.llm import frames, vectors
from tripfold.llm.components import components

THRESHOLD = 0.95
LEADING = 16  # coordinates added at a time
BOX = 8  # coordinates of a tile's box
BLOCK = 1024  # rows of a tile compared at a time
TILES_A_GROUP = 32  # at most; a task holds two groups
TILES_A_SHARE = 64  # of a cell, that meet the cell's other tiles in one task


def principal_axes(reps: DataFrame, dimension: int, kind: str) -> np.ndarray:
    """Axes by falling sum of squares, over all vectors.

    Each task adds up its matrix of products; the sums, one number for each pair of
    coordinates, are all that reaches the driver."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension))
        for batch in batches:
            if batch.num_rows:
                rows = vectors.unit(vectors.matrix(batch.column("embedding"), kind))
                total += rows.T @ rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dimension * dimension)), pa.array(total.ravel())], ["k", "s"]
        )

    sums = (
        reps.select("embedding")
        .mapInArrow(products, "k bigint, s double")
        .groupBy("k")
        .agg(F.sum("s").alias("s"))
        .collect()
    )
    total = np.zeros(dimension * dimension)
    for row in sums:
        total[row["k"]] = row["s"]
    total = total.reshape(dimension, dimension)
    return np.ascontiguousarray(np.linalg.eigh((total + total.T) / 2)[1][:, ::-1])


def _tiles(reps: DataFrame, axes: np.ndarray, kind: str, count: int) -> DataFrame:
    dimension = len(axes)
    size = vectors.tile_rows(dimension, kind)
    box = min(BOX, dimension)
    held = reps.sparkSession.sparkContext.broadcast(axes)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = vectors.unit(vectors.matrix(batch.column("embedding"), kind))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(rows @ held.value[:, 0])],
                    [*batch.schema.names, "lead"],
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, part in vectors.gathered(batches, size, ["vec_id", "copies", "embedding"], kind):
            turned = vectors.unit(part["embedding"]) @ held.value[:, :box]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tile], pa.int64()),
                    pa.array([part["vec_id"].astype("<i8").tobytes()], pa.binary()),
                    pa.array([part["copies"].astype("<i8").tobytes()], pa.binary()),
                    pa.array([part["embedding"].tobytes()], pa.binary()),
                    pa.array([turned.min(axis=0).tolist()], pa.list_(pa.float64())),
                    pa.array([turned.max(axis=0).tolist()], pa.list_(pa.float64())),
                ],
                ["tile", "ids", "copies", "data", "low", "high"],
            )

    element = reps.schema["embedding"].dataType.simpleString()
    ordered = reps.mapInArrow(
        lead, f"vec_id bigint, copies bigint, embedding {element}, lead double"
    )
    # Whole tiles for each partition, several tiles each where there are many.
    parts = max(1, count // (8 * size))
    ordered = ordered.repartitionByRange(parts, "lead", "vec_id").sortWithinPartitions("lead")
    schema = (
        "tile bigint, ids binary, copies binary, data binary, low array<double>, high array<double>"
    )
    return frames.staged(ordered.mapInArrow(pack, schema), "tiles")


def _tile_pairs(tiles: DataFrame, threshold: float, count: int) -> DataFrame:
    """Pairs of tiles whose boxes hold points near enough, each once.

    Two vectors of length one reach the threshold only within this distance, so along the
    first axis tiles meet only in cells that wide or in the next ones; the boxes of those
    that meet are then compared in all their coordinates.  There are few cells, so the
    tiles of one are dealt into shares, and each share meets the whole cell in its own task.
    Of the cells in which two tiles meet only the first one tells."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    shares = max(1, -(-count // TILES_A_SHARE))
    first = F.floor(F.col("low")[0] / reach)
    last = F.floor(F.col("high")[0] / reach)
    boxes = tiles.select("tile", "low", "high")
    one = boxes.select(
        F.col("tile").alias("a"), F.col("low").alias("la"), F.col("high").alias("ha"),
        first.alias("fa"),
        F.explode(F.sequence(first, last)).alias("cell"),
        F.pmod(F.xxhash64("tile"), F.lit(shares)).cast("int").alias("share"),
    )
    other = boxes.select(
        F.col("tile").alias("b"), F.col("low").alias("lb"), F.col("high").alias("hb"),
        (first - 1).alias("fb"),
        F.explode(F.sequence(first - 1, last + 1)).alias("cell"),
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))
    gap = F.aggregate(
        F.zip_with(
            F.zip_with("la", "hb", lambda x, y: x - y),
            F.zip_with("lb", "ha", lambda x, y: x - y),
            lambda x, y: F.greatest(x, y, F.lit(0.0)),
        ),
        F.lit(0.0),
        lambda total, x: total + x * x,
    )
    return (
        one.join(other, ["cell", "share"])
        .where((F.col("a") <= F.col("b")) & (F.col("cell") == F.greatest("fa", "fb")))
        .where(gap <= reach * reach)
        .select("a", "b")
    )


def reaching(
    one: np.ndarray, other: np.ndarray, threshold: float, axes: np.ndarray
) -> np.ndarray:
    """Which rows of two blocks of unit vectors reach the threshold, as a matrix.

    Sums in single precision decide but within ``slack`` of the threshold, where the
    product is taken in double precision."""
    dimension = len(axes)
    slack = 1e-5 * max(1.0, dimension / 256)
    turned = [(block @ axes).astype(np.float32) for block in (one, other)]
    result = np.zeros((len(one), len(other)), dtype=bool)
    rows, columns = np.arange(len(one)), np.arange(len(other))
    sums = np.zeros((len(rows), len(columns)), dtype=np.float32)
    for start in range(0, dimension, LEADING):
        a, b = turned[0][rows], turned[1][columns]
        end = min(dimension, start + LEADING)
        sums += a[:, start:end] @ b[:, start:end].T
        if end < dimension:
            rest = np.linalg.norm(a[:, end:], axis=1)[:, None] * np.linalg.norm(
                b[:, end:], axis=1
            )
            alive = sums + rest >= threshold - slack
            keep_rows, keep_columns = alive.any(axis=1), alive.any(axis=0)
            if not keep_rows.any():
                return result
            if not (keep_rows.all() and keep_columns.all()):
                rows, columns = rows[keep_rows], columns[keep_columns]
                sums = sums[np.ix_(keep_rows, keep_columns)]
    linked = sums >= threshold
    near = np.argwhere(np.abs(sums - threshold) <= slack)
    for start in range(0, len(near), 1 << 16):
        i, j = near[start : start + (1 << 16)].T
        exact = np.einsum("ij,ij->i", one[rows[i]], other[columns[j]])
        linked[i, j] = exact >= threshold
    result[np.ix_(rows, columns)] = linked
    return result


def _least_labels(linked: np.ndarray, one: np.ndarray, other: np.ndarray) -> tuple:
    """For rows and columns of a link matrix the least label each reaches within it."""
    far = np.iinfo(np.int64).max
    while True:
        rows = np.minimum(one, np.where(linked, other, far).min(axis=1, initial=far))
        columns = np.minimum(other, np.where(linked, rows[:, None], far).min(axis=0, initial=far))
        if np.array_equal(rows, one) and np.array_equal(columns, other):
            return rows, columns
        one, other = rows, columns


def _compare_tiles(left: tuple, right: tuple, same: bool, threshold: float, axes: np.ndarray):
    """Linked vectors of two tiles: ids, their numbers of links, the least id they reach.

    Each block of rows gives its own, so that no link between blocks is lost."""
    (ids, copies, rows), (other_ids, other_copies, others) = left, right
    for start in range(0, len(ids), BLOCK):
        part = slice(start, start + BLOCK)
        linked = reaching(rows[part], others, threshold, axes)
        if same:
            linked[np.arange(len(linked)), np.arange(start, start + len(linked))] = False
        has, has_other = linked.any(axis=1), linked.any(axis=0)
        if not has.any():
            continue
        small = linked[np.ix_(has, has_other)]
        one, other = ids[part][has], other_ids[has_other]
        roots, other_roots = _least_labels(small, one, other)
        yield one, small @ other_copies[has_other], roots
        # In a tile met with itself every link shows up from both sides.
        counts = np.zeros(len(other), dtype=np.int64) if same else copies[part][has] @ small
        yield other, counts, other_roots


def _links(reps: DataFrame, dimension: int, threshold: float) -> DataFrame:
    """vec_id, links and root: partial numbers of links, and edges that connect what is linked."""
    kind = vectors.kind_of(reps)
    reps = reps.where(F.size("embedding") == dimension)
    axes = principal_axes(reps, dimension, kind)
    tiles = _tiles(reps, axes, kind, reps.count())
    count = tiles.count()
    context = reps.sparkSession.sparkContext
    # Few groups, as a tile is sent once for each it meets, but enough pairs of them to share.
    groups = max(-(-count // TILES_A_GROUP), min(count, int(np.sqrt(4 * context.defaultParallelism))))

    def group_of(tile: str) -> Column:
        return F.pmod(F.xxhash64(tile), F.lit(max(1, groups))).cast("int")

    # A pair of groups is a task of the grid; of two tiles the one in the lesser group leads.
    pairs = frames.staged(
        _tile_pairs(tiles, threshold, count)
        .withColumns({"ga": group_of("a"), "gb": group_of("b")})
        .select(
            F.least("ga", "gb").alias("one"),
            F.greatest("ga", "gb").alias("two"),
            F.when(F.col("ga") <= F.col("gb"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.when(F.col("ga") <= F.col("gb"), F.col("b")).otherwise(F.col("a")).alias("b"),
        ),
        "tile-pairs",
    )
    none = F.array().cast("array<bigint>")
    sent = (
        pairs.groupBy("one", "two", F.col("a").alias("tile"))
        .agg(F.collect_list("b").alias("partners"))  # at most a group of tiles
        .unionByName(
            pairs.select("one", "two", F.col("b").alias("tile"), none.alias("partners"))
        )
        .groupBy("one", "two", "tile")
        .agg(F.max("partners").alias("partners"))
    )
    held = context.broadcast(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(met: dict) -> Iterator[pa.RecordBatch]:
            def tile(number):
                row = met[number]
                ids = np.frombuffer(row["ids"], dtype="<i8")
                rows = np.frombuffer(row["data"], dtype=kind).reshape(len(ids), dimension)
                return ids, np.frombuffer(row["copies"], dtype="<i8"), vectors.unit(rows)

            for number, row in met.items():
                left = tile(number) if row["partners"] else None
                for partner in row["partners"]:
                    same = partner == number
                    right = left if same else tile(partner)
                    for found in _compare_tiles(left, right, same, threshold, held.value):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(values) for values in found], ["vec_id", "links", "root"]
                        )

        key, met = None, {}
        for batch in frames.slices(batches, 1):
            row = batch.to_pylist()[0]
            if (row["one"], row["two"]) != key:
                yield from compared(met)
                key, met = (row["one"], row["two"]), {}
            met[row["tile"]] = row
        yield from compared(met)

    grid = (
        sent.join(tiles.select("tile", "ids", "copies", "data"), "tile")
        .repartition(max(1, groups * (groups + 1) // 2), "one", "two")
        .sortWithinPartitions("one", "two")
    )
    return grid.mapInArrow(run, "vec_id bigint, links bigint, root bigint")


def near_duplicates(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept.

    Two vectors are linked if their cosine is ``threshold`` or more.  Equal vectors are
    compared once and counted as often as they occur.  Null or zero vectors, those with a
    null or non-finite component and those of another length link with nothing and are a
    component of their own.  Of rows that repeat an identifier one counts; a row without
    an identifier has no links, no component and is not kept.  An empty table gives an
    empty result, extra columns are ignored."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    everything = embeddings.select(F.col(id_col).cast("bigint").alias("vec_id")).distinct()
    found = frames.staged(vectors.unique_vectors(embeddings, id_col, vector_col), "vectors")
    reps = frames.staged(
        found.groupBy("embedding")
        .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
        .select("vec_id", "copies", "embedding"),
        "distinct-vectors",
    )
    parts = [_links(reps, dimension, threshold) for dimension in vectors.dimensions(reps)]
    if not parts:
        return everything.select(
            "vec_id",
            F.lit(0).cast("bigint").alias("n_links"),
            F.col("vec_id").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    links = frames.staged(reduce(DataFrame.unionByName, parts), "links")
    counted = links.groupBy("vec_id").agg(F.sum("links").alias("links"))
    reached = components(links, "vec_id", "root").withColumnsRenamed(
        {"node": "vec_id", "component": "least"}
    )
    of_rep = (
        reps.join(counted, "vec_id", "left")
        .join(reached, "vec_id", "left")
        .select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("least", "vec_id").alias("component_id"),
        )
    )
    of_vector = found.join(of_rep, "embedding").select("vec_id", "n_links", "component_id")
    component = F.coalesce("component_id", "vec_id")
    return everything.join(of_vector, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
