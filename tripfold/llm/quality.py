"""Quality scores from learned subword embeddings.

Hashed words and hashed runs of one to three characters each have a learned vector; a
document is the average of its vectors, and a softmax over it gives the label.  Vectors
and output are trained together by stochastic gradient descent."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm import frames, ngrams, sampling

SIZES = (1, 2, 3)
WORD_BUCKETS = 4096
CHARACTER_BUCKETS = 8192
BUCKETS = WORD_BUCKETS + CHARACTER_BUCKETS
DIMENSIONS = 16
MAX_ROWS = 4_000  # learned from, over both labels
EPOCHS = 20
BATCH = 64
RATE = 0.5


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur, and each one's share; words and characters weigh the same."""
    parts = []
    words = ngrams.word_counts(text, WORD_BUCKETS)
    characters = ngrams.character_counts(text, SIZES, CHARACTER_BUCKETS)
    for part in (words, characters):
        total = part.sum()
        parts.append(part / (2 * total) if total else part.astype(float))
    shares = np.concatenate(parts).astype(np.float32)
    buckets = np.flatnonzero(shares)
    return buckets.astype(np.uint16), shares[buckets]


class Model:
    def __init__(self, vectors: np.ndarray, output: np.ndarray):
        # The average and the output are both linear, so one weight a bucket remains.
        self.weights = (vectors @ (output[1:, 1] - output[1:, 0])).astype(np.float32)
        self.bias = float(output[0, 1] - output[0, 0])

    def score(self, text: str) -> float:
        buckets, shares = counts(text)
        margin = float(shares @ self.weights[buckets]) + self.bias
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Model:
    """Train on balanced labels; without both labels every text scores 0.5."""
    random = np.random.default_rng(seed)
    vectors = random.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((DIMENSIONS + 1, 2), dtype=np.float32)
    if len(set(labels.tolist())) < 2:
        return Model(vectors, output)
    positive = labels.mean()
    importance = np.where(labels == 1, 0.5 / positive, 0.5 / (1 - positive)).astype(np.float32)
    squares = np.full((BUCKETS, 1), 1e-8, dtype=np.float32)
    output_squares = np.full(output.shape, 1e-8, dtype=np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = random.permutation(len(labels))
        for start in range(0, len(order), BATCH):
            part = order[start : start + BATCH]
            x = np.zeros((len(part), BUCKETS), dtype=np.float32)
            for k, row in enumerate(part):
                x[k, rows[row][0]] = rows[row][1]
            hidden = np.hstack([np.ones((len(part), 1), dtype=np.float32), x @ vectors])
            logits = hidden @ output
            logits -= logits.max(axis=1, keepdims=True)
            chance = np.exp(logits)
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(part)), labels[part]] -= 1
            pull = chance * importance[part, None] / len(part)
            # Step sizes shrink with the squared gradients each bucket has seen.
            to_vectors = x.T @ (pull @ output[1:].T)
            to_output = hidden.T @ pull
            squares += (to_vectors**2).mean(axis=1, keepdims=True)
            output_squares += to_output**2
            vectors -= rate * 0.1 * to_vectors / np.sqrt(squares)
            output -= rate * 0.1 * to_output / np.sqrt(output_squares)
    return Model(vectors, output)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = MAX_ROWS,
) -> Model:
    """A model from labelled rows that are not held out.

    At most ``max_rows`` identifiers are learned from, as many of each label, and one row of
    each, that of the least text; their bucket shares reach the driver, 74 KB for the
    longest texts.  Labels other than 0 and 1, null texts and a document with contradicting
    labels teach nothing."""
    rows = frames.narrow(docs, doc_id=id_col, text=text_col).where(F.col("text").isNotNull())
    marked = sampling.agreed(labels, id_col, label_col)
    present = marked.join(rows.select("doc_id"), "doc_id", "left_semi")
    chosen = sampling.bounded(present, "label", max_rows // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames.slices(batches):
            found = [counts(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label").cast(pa.int32()),
                    pa.array([b.tobytes() for b, _ in found], pa.binary()),
                    pa.array([s.tobytes() for _, s in found], pa.binary()),
                ],
                ["doc_id", "label", "buckets", "shares"],
            )

    sample = sampling.one_row_each(rows.join(F.broadcast(chosen), "doc_id"))
    sample = sample.select("doc_id", "text", "label")
    kind = sample.schema["doc_id"].dataType.simpleString()
    table = sample.mapInArrow(
        run, f"doc_id {kind}, label int, buckets binary, shares binary"
    ).toArrow()
    table = table.sort_by([("doc_id", "ascending")])
    # The arrays are views of the table's own memory.
    found = [
        (np.frombuffer(b.as_buffer(), dtype=np.uint16), np.frombuffer(s.as_buffer(), np.float32))
        for b, s in zip(table.column("buckets"), table.column("shares"), strict=True)
    ]
    model = fit(found, np.array(table.column("label").to_pylist(), dtype=np.int64))
    del found, table
    pa.default_memory_pool().release_unused()
    return model


def scored(
    docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """One row per input row: ``rest``, a struct of its columns or of those ``keep`` names,
    and ``score``, the likelihood of label 1.

    A null text counts as empty, and the empty text scores by the bias alone.  Null
    identifiers and repeated rows are kept as they are, and an empty table gives an empty
    result."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def compute(texts: list[str]) -> list[pa.Array]:
        return [pa.array([held.value.score(text) for text in texts], pa.float64())]

    return frames.beside(docs, text_col, compute, "score double", keep)


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and score of each row, see ``scored``; extra columns are ignored."""
    found = scored(frames.narrow(docs, doc_id=id_col, text=text_col), model, keep=["doc_id"])
    return found.select("rest.doc_id", "score")
