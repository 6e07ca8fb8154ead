"""Vector best-fit packing of tokenised documents into sequences.

Pieces of one length have the same demands, so the bins are planned on the histogram of
lengths, whose size is bounded by the capacity and not by the corpus; the pieces
then take their places by their rank within the length."""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripfold.llm import bpe, frames, words

END_ID = 1
RANKED_ROWS = 100_000


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold.  Attention costs the square of each piece's length.

    By default the two further capacities are as wide as the token capacity allows, so
    they never cost a sequence; narrower ones bind."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.05, 0.2)
    rule: str = "residual"  # or "dot"


# -- tokenising ----------------------------------------------------------------------


#: What parts of plain texts and other whole chunks encode to, remembered between tasks.
_of_part = words.Bounded(limit=144 << 20)
_of_chunk = words.Bounded(limit=16 << 20)
PARTS_A_CALL = 500


def _coded(alone) -> list[bytes]:
    return [np.array(one.ids, dtype="<u4").tobytes() for one in alone]


@lru_cache(maxsize=1)
def _ends_word(path: str) -> np.ndarray:
    """Whether each id stands at the end of a word; every word has one such id."""
    vocabulary = words.library(path).get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    ends[[k for token, k in vocabulary.items() if token.endswith(bpe.END_OF_WORD)]] = True
    return ends


def _encode_parts(parts: list[str], path: str) -> list[bytes]:
    """The library's ids of each part: one call for many, told apart by the ends of words."""
    library, ends, result = words.library(path), _ends_word(path), []
    groups = [parts[at : at + PARTS_A_CALL] for at in range(0, len(parts), PARTS_A_CALL)]
    joined = [" ".join(group) for group in groups]
    for some, coded in zip(
        groups, library.encode_batch_fast(joined, add_special_tokens=False), strict=True
    ):
        ids = np.array(coded.ids, dtype="<u4")
        cuts = np.flatnonzero(ends[ids]) + 1
        if len(cuts) == len(some) and cuts[-1] == len(ids):
            data, cuts = ids.tobytes(), [0, *(cuts * 4).tolist()]
            result += [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        else:  # some part is no single word to the library
            result += _coded(library.encode_batch_fast(some, add_special_tokens=False))
    return result


def _encode_chunks(chunks: list[str], path: str) -> list[bytes]:
    return _coded(words.library(path).encode_batch_fast(chunks, add_special_tokens=False))


def _looked_up(split: list[list[str]], cache: words.Bounded, encode, path: str) -> list[bytes]:
    """Ids of texts from those of their pieces; pieces not met before are encoded in bulk.

    The pieces of one call are few enough to stay near the processor, so each text looks
    them up there and the large cache is asked once a piece."""
    known = {piece: cache.get(piece) for piece in set().union(*split)}
    fresh = [piece for piece, ids in known.items() if ids is None]
    new = dict(zip(fresh, encode(fresh, path), strict=True))
    known.update(new)
    cache.keep_all(new)
    return [b"".join(map(known.__getitem__, pieces)) for pieces in split]


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """The library's ids of each text, as little-endian unsigned 32-bit numbers.

    The vocabulary drops white space and never joins across it, nor across the parts of
    its own pattern, so a part is encoded once, in bulk, and remembered.  Texts with special
    strings or characters beyond the plain ones go by whole chunks, which are the library's
    from composition on."""
    by_part = ["<|" not in text and words.plain(text) for text in texts]
    split = [
        words.parts(text, path) if own else words.chunks(text)
        for text, own in zip(texts, by_part, strict=True)
    ]
    parts = iter(
        _looked_up([p for p, own in zip(split, by_part, strict=True) if own], _of_part, _encode_parts, path)
    )
    chunks = iter(
        _looked_up(
            [p for p, own in zip(split, by_part, strict=True) if not own], _of_chunk, _encode_chunks, path
        )
    )
    return [next(parts) if own else next(chunks) for own in by_part]


def tokenised_pieces(
    docs: DataFrame,
    path: str,
    capacity: int = Limits.tokens,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
) -> DataFrame:
    """Each document's ids and the end id, cut at ``capacity``: doc_id, piece, start,
    length and ids (little-endian unsigned 32-bit numbers as binary), or with ``digest``
    their crc32 as ids_crc32, where the ids themselves need not leave the task.

    A null text counts as empty and gives one piece of the end id alone; a null identifier
    and repeated rows are kept as they are; extra columns are ignored."""
    end = np.array([END_ID], dtype="<u4").tobytes()
    last = "ids_crc32" if digest else "ids"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.working("packing")
        for batch in frames.slices(batches):
            rows, piece, start, length, ids = [], [], [], [], []
            for row, data in enumerate(token_bytes(batch.column("text").to_pylist(), path)):
                data += end
                for number, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append(row)
                    piece.append(number)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    ids.append(zlib.crc32(part) if digest else part)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int32())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.int64() if digest else pa.binary()),
                ],
                ["doc_id", "piece", "start", "length", last],
            )

    rows = frames.texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    kind_of_last = "bigint" if digest else "binary"
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, {last} {kind_of_last}"
    return rows.mapInArrow(run, schema)


# -- planning ------------------------------------------------------------------------


class _States:
    """Bins that hold equally much, as arrays of what they hold and ranges of bin numbers."""

    def __init__(self, limits: Limits):
        self.capacity = np.array(
            [limits.tokens, limits.documents, limits.attention], dtype=np.float64
        )
        self.weights, self.rule = np.array(limits.weights), limits.rule
        self.used = np.zeros((64, 3))
        self.ranges: list[list[list[int]]] = []
        self.at: dict[tuple[int, int, int], int] = {}
        self.alive = np.zeros(64, dtype=bool)

    def ranges_of(self, state: tuple[int, int, int]) -> list[list[int]]:
        """The ranges of a state, which may be empty; the caller fills them."""
        row = self.at.get(state)
        if row is None:
            row = self.at[state] = len(self.ranges)
            if row == len(self.used):
                self.used = np.concatenate([self.used, np.zeros_like(self.used)])
                self.alive = np.concatenate([self.alive, np.zeros_like(self.alive)])
            self.used[row] = state
            self.ranges.append([])
        self.alive[row] = True
        return self.ranges[row]

    def emptied(self, state: tuple[int, int, int]) -> None:
        self.alive[self.at[state]] = False
        if len(self.ranges) > 256 and 4 * int(self.alive.sum()) < len(self.ranges):
            rows = np.flatnonzero(self.alive)
            self.ranges = [self.ranges[row] for row in rows]
            used = self.used[rows]
            self.at = {tuple(map(int, state)): row for row, state in enumerate(used)}
            self.used = np.concatenate([used, np.zeros((len(rows) + 64, 3))])
            self.alive = np.arange(len(self.used)) < len(rows)

    def best(self, demand: np.ndarray) -> tuple[int, int, int] | None:
        """The feasible state that fits best: the least weighted norm of what would remain,
        or the largest weighted product of demand and what is left."""
        rows = np.flatnonzero(self.alive)
        remaining = self.capacity - self.used[rows]
        fits = (remaining >= demand).all(axis=1)
        if not fits.any():
            return None
        rows, remaining = rows[fits], remaining[fits]
        if self.rule == "dot":
            score = -(remaining * demand / self.capacity**2) @ self.weights
        else:
            score = (((remaining - demand) / self.capacity) ** 2) @ self.weights
        return tuple(map(int, self.used[rows[int(np.argmin(score))]]))


def plan(counts: dict[int, int], limits: Limits) -> np.ndarray:
    """Places for ``counts[length]`` pieces of each length, longest first.

    Bins that hold equally many tokens, documents and attention cost are one state, kept
    as ranges of bin numbers.  Each length goes to the state that fits best, and to new
    bins if none does.  Rows of the result: length, first rank, number of pieces,
    first bin, offset; piece ``first rank + i`` goes to bin ``first bin + i``."""
    states = _States(limits)
    places: list[tuple[int, int, int, int, int]] = []
    bins = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        cost = (length, 1, length * length)
        demand = np.array(cost, dtype=np.float64)
        if (demand > states.capacity).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while left:
            best, times = states.best(demand), 1
            if best is None:
                times = int(min(states.capacity // demand))
                best = (0, 0, 0)
                states.ranges_of(best).append([bins, bins + -(-left // times)])
                bins += -(-left // times)
            for _ in range(times):
                taken = _place(states, best, length, left, rank, places)
                left, rank = left - taken, rank + taken
                best = tuple(held + more for held, more in zip(best, cost, strict=True))
                if not left:
                    break
    return np.array(places, dtype=np.int64).reshape(-1, 5)


def _place(states: _States, state, length, left, rank, places) -> int:
    """One piece for each bin of a state, as far as pieces or bins go."""
    moved = states.ranges_of((state[0] + length, state[1] + 1, state[2] + length * length))
    ranges, taken = states.ranges_of(state), 0
    while ranges and taken < left:
        first, last = ranges.pop()
        number = min(last - first, left - taken)
        places.append((length, rank + taken, number, first, state[0]))
        moved.append([first, first + number])
        taken += number
        if first + number < last:
            ranges.append([first + number, last])
    if not ranges:
        states.emptied(state)
    return taken


# -- placing -------------------------------------------------------------------------


def pack(pieces: DataFrame, limits: Limits | None = None) -> DataFrame:
    """The pieces with sequence_id and offset; every other column is kept.

    ``pieces`` needs doc_id, piece and length, and should be a stored table, since it is
    read more than once.  The histogram of lengths goes to the driver, one row for each
    length up to the capacity.  Ranks are counted within buckets of a length, so a length
    that a third of all pieces share is no single group.  Equal rows are interchangeable.
    No piece gives no row; a length that is null or below one is an error."""
    limits = limits or Limits()
    spark = pieces.sparkSession
    sound = F.when(F.col("length").between(1, limits.tokens), F.col("length")).otherwise(
        F.raise_error(F.lit("the length of a piece is out of range")).cast("bigint")
    )
    histogram = pieces.groupBy(sound.alias("length")).count().collect()
    counts = {row["length"]: row["count"] for row in histogram}
    places = plan(counts, limits)

    order = [c for c in pieces.columns if c != "ids"]
    shares = [(length, -(-count // RANKED_ROWS)) for length, count in counts.items()]
    spread = F.broadcast(spark.createDataFrame(shares, "length bigint, __spread bigint"))
    bucketed = pieces.join(spread, "length").withColumn(
        "__bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.col("__spread"))
    )
    before = (
        bucketed.groupBy("length", "__bucket")
        .count()
        .select(
            "length",
            "__bucket",
            (
                F.sum("count").over(Window.partitionBy("length").orderBy("__bucket"))
                - F.col("count")
            ).alias("__before"),
        )
    )
    number = F.row_number().over(Window.partitionBy("length", "__bucket").orderBy(*order))
    ranked = (
        bucketed.withColumn("__number", number)
        .join(before, ["length", "__bucket"])
        .withColumn("__rank", F.col("__before") + F.col("__number") - 1)
    )
    keys = places[:, 0] * (1 << 44) + places[:, 1]
    by_key = np.argsort(keys, kind="stable")
    held = spark.sparkContext.broadcast((keys[by_key], places[by_key]))
    names = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_keys, rows = held.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("__rank").to_numpy(zero_copy_only=False)
            found = rows[np.searchsorted(sorted_keys, length * (1 << 44) + rank, "right") - 1]
            columns = [batch.column(name) for name in names]
            columns += [pa.array(found[:, 3] + rank - found[:, 1]), pa.array(found[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.select(*names, "__rank").mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


