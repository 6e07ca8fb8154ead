"""Vectors in tiles: one row holds many vectors as a block of bytes."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE_BYTES = 1 << 20


def usable(name: str) -> Column:
    """Neither null, empty nor zero, and every component a finite number."""
    finite = F.forall(
        name,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(finite & F.exists(name, lambda x: x != 0), F.lit(False))


def unique_vectors(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and embedding, one row for each identifier that has a usable vector; of
    several the least counts.  Rows without an identifier are left out."""
    rows = frame.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("embedding")
    )
    rows = rows.where(usable("embedding") & F.col("vec_id").isNotNull())
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def dimensions(vectors: DataFrame) -> list[int]:
    """The lengths that occur; vectors of different lengths are never compared."""
    return sorted(r[0] for r in vectors.select(F.size("embedding")).distinct().collect())


def kind_of(vectors: DataFrame) -> str:
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    return "<f4" if element == "float" else "<f8"


def matrix(column: pa.Array, kind: str) -> np.ndarray:
    """The list column of a batch as rows; all lists are of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def tile_rows(dimension: int, kind: str) -> int:
    return max(64, TILE_BYTES // (dimension * int(kind[-1])))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so no square overflows."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def gathered(
    batches: Iterator[pa.RecordBatch], size: int, columns: list[str], kind: str
) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """Tile number and its columns, ``size`` rows at a time, from one partition's rows."""
    held: list[dict[str, np.ndarray]] = []
    count, tile = 0, TaskContext.get().partitionId() << 32

    def joined() -> dict[str, np.ndarray]:
        return {c: np.concatenate([part[c] for part in held]) for c in columns}

    for batch in batches:
        held.append(
            {
                c: matrix(batch.column(c), kind)
                if c == "embedding"
                else batch.column(c).to_numpy(zero_copy_only=False)
                for c in columns
            }
        )
        count += batch.num_rows
        if count >= size:
            everything = joined()
            full = count // size * size
            for at in range(0, full, size):
                yield tile, {c: values[at : at + size] for c, values in everything.items()}
                tile += 1
            held = [{c: values[full:] for c, values in everything.items()}]
            count -= full
    if count:
        yield tile, joined()
