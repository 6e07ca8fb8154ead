"""Small helpers that the operators share: narrow inputs, staged tables, Arrow slices."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripfold.llm import words
from tripfold.session import stage

SLICE_ROWS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def narrow(frame: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that extra columns of
    the caller can clash with nothing."""
    return frame.select(*[frame[source].alias(name) for name, source in columns.items()])


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: str) -> DataFrame:
    """Identifier and whole text; a null text is an empty one."""
    frame = narrow(docs, doc_id=id_col, text=text_col, **more)
    return frame.withColumn("text", F.coalesce(F.col("text"), F.lit("")))


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts lineage where every executor reads."""
    return stage(frame, f"llm-{name}")


def drop_staged(frame: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    jvm = frame.sparkSession._jvm
    settings = frame.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(settings).delete(path, True)


def beside(
    docs: DataFrame, text_col: str, compute, schema: str, keep: list[str] | None = None
) -> DataFrame:
    """What ``compute`` makes of each whole text, beside ``rest``, a struct of the columns
    ``keep`` names (all if none are named).

    ``compute`` takes a list of texts, a null text as empty, and returns one list for each
    column of ``schema``.  Every column goes to Python once, and back once if it is kept;
    names of their own let no column clash.  Rows need no key and are not shuffled."""
    kept = docs.columns if keep is None else keep
    own = [f"__{k}" for k in range(len(kept))]
    columns = [F.col(f"`{c}`").alias(name) for c, name in zip(kept, own, strict=True)]
    text = own[kept.index(text_col)] if text_col in kept else "__text"
    if text == "__text":
        columns.append(F.col(f"`{text_col}`").alias(text))
    rows = docs.select(*columns)
    found = StructType.fromDDL(schema).fields
    names = [*own, *[field.name for field in found]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.working(schema)
        for batch in slices(batches):
            computed = compute([t or "" for t in batch.column(text).to_pylist()])
            arrays = [batch.column(name) for name in own]
            yield pa.RecordBatch.from_arrays([*arrays, *computed], names)

    done = rows.mapInArrow(run, StructType([*[rows.schema[name] for name in own], *found]))
    rest = F.struct(*[F.col(name).alias(c) for c, name in zip(kept, own, strict=True)])
    return done.select(rest.alias("rest"), *[field.name for field in found])


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that few texts are Python objects at one time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    pa.default_memory_pool().release_unused()


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list column from one array for each row."""
    ends = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(part) for part in parts], out=ends[1:])
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))
