"""Byte-level byte-pair encoding with vectorised pre-tokenisation, and decoding.

The pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^\\s L N]+|\\s+(?!\\S)|\\s+`` (L letters,
N numbers) needs at most two characters of look-ahead.  So every character becomes a
symbol that already knows what follows, and a small automaton over symbols says where a
match begins.  Transition functions compose associatively; the functions that can arise
are enumerated once with their multiplication table, and states at all positions come
from a scan over blocks of positions."""

import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripfold.llm import bpe, frames
from tripfold.llm.words import Bounded, working

#: White space as the pattern means it.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
WHITE += [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

LETTER, NUMBER, OTHER, QUOTE1, QUOTE2, SPACE, GLUE, LONE, RESET = range(9)
# States: nothing open, in letters, in numbers, in others, in white space, after a space
# that joins what follows, one and two characters left of a contraction.
FRESH, IN_L, IN_N, IN_O, IN_W, GLUED, ONE, TWO = range(8)
BLOCK = 64
BATCH_CHARACTERS = 2_000_000


@cache
def _classes() -> np.ndarray:
    """Letter, number, other or white space for each code point."""
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            kinds[point] = LETTER
        elif kind == "N":
            kinds[point] = NUMBER
    kinds[WHITE] = SPACE
    return kinds


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The state after a symbol, and whether a match begins at it."""
    if symbol == RESET:
        return FRESH, False
    if symbol in (SPACE, GLUE, LONE):
        if symbol == GLUE:
            return GLUED, True
        if symbol == LONE:
            return FRESH, True
        return IN_W, state != IN_W
    if symbol == LETTER and state in (ONE, TWO):
        return (FRESH if state == ONE else ONE), False
    inside = {LETTER: IN_L, NUMBER: IN_N}.get(symbol, IN_O)
    joined = state in (GLUED, inside)
    if not joined and symbol in (QUOTE1, QUOTE2):
        return (ONE if symbol == QUOTE1 else TWO), True
    return inside, not joined


@cache
def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The transition functions that compositions of symbols give: multiplication table,
    function of each symbol, state each gives from FRESH, and begin[state, symbol]."""
    states = range(8)
    of_symbol = [tuple(_step(s, symbol)[0] for s in states) for symbol in range(9)]
    known = {tuple(states): 0}
    queue = [tuple(states)]
    for function in queue:
        for symbol in of_symbol:
            after = tuple(symbol[s] for s in function)
            if after not in known:
                known[after] = len(known)
                queue.append(after)
    listed = list(known)
    product = np.array(
        [[known[tuple(second[s] for s in first)] for second in listed] for first in listed],
        dtype=np.uint16,
    )
    symbols = np.array([known[f] for f in of_symbol], dtype=np.uint16)
    ends = np.array([f[FRESH] for f in listed], dtype=np.uint8)
    begins = np.array([[_step(s, symbol)[1] for symbol in range(9)] for s in states])
    return product, symbols, ends, begins


def _symbols(points: np.ndarray, resets: np.ndarray) -> np.ndarray:
    """What each character is, given the characters behind it."""
    symbols = _classes()[points]
    white = symbols == SPACE
    follows = np.zeros(len(points), dtype=bool)
    follows[:-1] = ~white[1:]
    follows[resets[resets > 0] - 1] = False
    plain = points == 32
    symbols[white & follows & plain] = GLUE
    symbols[white & follows & ~plain] = LONE
    quotes = np.flatnonzero(points == 39)
    if len(quotes):
        padded = np.append(points, [0, 0])
        one, two = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
        long |= (one == ord("l")) & (two == ord("l"))
        symbols[quotes[short]] = QUOTE1
        symbols[quotes[long]] = QUOTE2
    symbols[resets] = RESET
    return symbols


def _starts(symbols: np.ndarray) -> np.ndarray:
    """Positions at which a match begins."""
    product, of_symbol, ends, begins = _functions()
    count = len(symbols)
    rows = -(-count // BLOCK)
    functions = np.zeros(rows * BLOCK, dtype=np.uint16)
    functions[:count] = of_symbol[symbols]
    scan = functions.reshape(rows, BLOCK)
    size = product.shape[0]
    flat = product.ravel()
    for column in range(1, BLOCK):
        scan[:, column] = flat[scan[:, column - 1].astype(np.int32) * size + scan[:, column]]
    entry = scan[:, -1].copy()
    step = 1
    while step < rows:
        entry[step:] = flat[entry[:-step].astype(np.int32) * size + entry[step:]]
        step *= 2
    before = np.zeros(rows, dtype=np.int32)
    before[1:] = entry[:-1]
    states = np.full(rows * BLOCK + 1, FRESH, dtype=np.uint8)
    states[1:] = ends[flat[before[:, None] * size + scan]].ravel()
    return np.flatnonzero(begins[states[:count], symbols])


def boundaries(texts: list[str]) -> list[np.ndarray]:
    """For each text the byte offsets at which matches begin, closed by its length."""
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    sizes = np.array([len(text) + 1 for text in texts])
    resets = np.cumsum(sizes) - 1
    starts = _starts(_symbols(points, resets))
    widths = np.ones(len(points), dtype=np.int64)
    if not joined.isascii():
        for least in (0x80, 0x800, 0x10000):
            widths += points >= least
    places = np.concatenate([[0], np.cumsum(widths)])
    first = np.concatenate([[0], resets[:-1] + 1])
    cuts = np.searchsorted(starts, np.append(first, len(points)))
    return [
        np.append(places[starts[cuts[k] : cuts[k + 1]]], places[resets[k]]) - places[first[k]]
        for k in range(len(texts))
    ]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Bounded:
    """Ids of one match, remembered for the worker's life."""
    vocabulary = bpe.rank_vocabulary(path)
    whole, pairs = vocabulary["whole"], vocabulary["pairs"]

    def ids(piece: bytes) -> tuple[int, ...]:
        found = whole.get(piece)
        if found is not None:
            return (found,)
        symbols = [whole[piece[k : k + 1]] for k in range(len(piece))]
        return tuple(bpe.merge_symbols(symbols, pairs))

    return Bounded(ids, limit=96 << 20)


def _grouped(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > BATCH_CHARACTERS:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def encode_texts(texts: list[str], path: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and match offsets of each text."""
    ids_of = _encoder(path).__getitem__
    result = []
    for group in _grouped(texts):
        for text, offsets in zip(group, boundaries(group), strict=True):
            data, at = text.encode(), offsets.tolist()
            pieces = [data[a:b] for a, b in zip(at, at[1:], strict=False)]
            ids = np.fromiter(chain.from_iterable(map(ids_of, pieces)), dtype=np.int32)
            result.append((ids, offsets[:-1].astype(np.int32)))
    return result


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, ids array<int>, offsets array<int>.

    ``offsets`` are the byte offsets at which the matches of the pattern begin, so that
    ids can be related to the text and decoded in parts.  A null text counts as empty and
    gives two empty arrays; a null identifier and repeated rows are kept as they are; an
    empty table gives an empty result; extra columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working("byte_bpe")
        for batch in frames.slices(batches):
            coded = encode_texts(batch.column("text").to_pylist(), path)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    frames.list_array([ids for ids, _ in coded], pa.int32()),
                    frames.list_array([offsets for _, offsets in coded], pa.int32()),
                ],
                ["doc_id", "ids", "offsets"],
            )

    rows = frames.texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, offsets array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded``, the bytes that the ids stand for.

    Null ids give null bytes; an id outside the vocabulary is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = bpe.rank_vocabulary(path)["bytes"]
        for batch in frames.slices(batches):
            column = batch.column("ids")
            ids, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_pylist()
            data = [
                b"".join(map(names.__getitem__, ids[start:end].tolist())) if known else None
                for start, end, known in zip(
                    ends, ends[1:], column.is_valid().to_pylist(), strict=False
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(data, pa.binary())], [*batch.schema.names, "decoded"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{schema}, decoded binary")
