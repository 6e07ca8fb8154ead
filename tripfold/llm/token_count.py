"""Token counts by byte-pair merging, without emitting identifiers."""

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm import bpe, frames, words

TOKEN_LIMIT = 2048


@lru_cache(maxsize=2)
def _counter(path: str) -> words.Bounded:
    """Tokens of a chunk between white space, remembered for the worker's life."""
    vocabulary = bpe.word_vocabulary(path)
    first, last, pairs = vocabulary["first"], vocabulary["last"], vocabulary["pairs"]
    special = vocabulary["special"]
    split = words.with_specials(special) if special else None

    def tokens_of_part(part: str) -> int:
        data = part.encode()
        symbols = [first[byte] for byte in data[:-1]]
        symbols.append(last[data[-1]])
        return bpe.count_merged(symbols, pairs)

    of_part = words.Bounded(tokens_of_part)

    def tokens_of_chunk(chunk: str) -> int:
        if special and any(text in chunk for text in special):
            plain = split(chunk)
            marks = len(plain) // 2
            return marks + sum(of_part[p] for text in plain[::2] for p in words.parts(text, path))
        return sum([of_part[part] for part in words.parts(chunk, path)])

    return words.Bounded(tokens_of_chunk)


def count_tokens(text: str, path: str) -> int:
    return sum(map(_counter(path).__getitem__, words.chunks(text)))


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens.

    Each part of a word starts as one symbol per byte; the pair of lowest rank is popped
    from a heap and merged in a linked list until none is left, and the count is the
    symbols at the start less the merges.  White space never joins a token, so a word met
    before costs one lookup.  A null text counts as empty (0 tokens); a null identifier
    and repeated rows are kept as they are; an empty table gives an empty result; extra
    columns are ignored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.working("token_count")
        for batch in frames.slices(batches):
            counts = [count_tokens(text, path) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    rows = frames.texts(docs, id_col, text_col).select(
        "doc_id", "text", F.octet_length("text").cast("bigint").alias("n_bytes")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")


def over_limit(counts: DataFrame, limit: int = TOKEN_LIMIT) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
