"""Byte-pair merging over a heap and a linked list, with the tables of public vocabularies."""

import base64
import heapq
import json
from functools import cache, lru_cache

END_OF_WORD = "</w>"


def _merged(
    symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]
) -> int:
    """Merge adjacent symbols in place, lowest rank first and leftmost among equals; returns
    how many merges there were.  A symbol that went into the one before it becomes -1.

    ``pairs`` gives rank and merged symbol of a pair.  The symbols form a linked list; an
    entry of the heap is stale when either of its symbols has changed since, which costs
    n log n where rescanning for the best pair would cost n squared."""
    count, merges = len(symbols), 0
    after = list(range(1, count + 1))
    before = list(range(-1, count - 1))
    heap = []
    for at in range(count - 1):
        found = pairs.get((symbols[at], symbols[at + 1]))
        if found:
            heap.append((found[0], at, symbols[at], symbols[at + 1], found[1]))
    heapq.heapify(heap)
    while heap:
        _, at, left, right, merged = heapq.heappop(heap)
        other = after[at]
        if symbols[at] != left or other >= count or symbols[other] != right:
            continue
        merges += 1
        symbols[at], symbols[other] = merged, -1
        beyond = after[at] = after[other]
        if beyond < count:
            before[beyond] = at
            found = pairs.get((merged, symbols[beyond]))
            if found:
                heapq.heappush(heap, (found[0], at, merged, symbols[beyond], found[1]))
        prior = before[at]
        if prior >= 0:
            found = pairs.get((symbols[prior], merged))
            if found:
                heapq.heappush(heap, (found[0], prior, symbols[prior], merged, found[1]))
    return merges


def merge_symbols(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The symbols that remain, in order."""
    held = list(symbols)
    _merged(held, pairs)
    return [symbol for symbol in held if symbol >= 0]


def count_merged(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> int:
    """How many symbols remain: those at the start less one for each merge."""
    return len(symbols) - _merged(list(symbols), pairs)


@cache
def byte_symbols() -> str:
    """The printable stand-in of each byte in byte-level vocabulary files.

    Bytes that print as themselves in Latin-1 keep their character; the others follow,
    in order, from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return "".join(chr(b if b in set(plain) else next(spare)) for b in range(256))


@lru_cache(maxsize=2)
def word_vocabulary(path: str) -> dict:
    """Pairs and special strings of a word-end vocabulary file.

    ``first`` and ``last`` give the symbol of a byte inside a word and at its end."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    vocabulary = content["model"]["vocab"]
    pairs = {}
    for rank, merge in enumerate(content["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        pairs[vocabulary[left], vocabulary[right]] = (rank, vocabulary[left + right])
    stand_ins = byte_symbols()
    return {
        "pairs": pairs,
        "first": [vocabulary[symbol] for symbol in stand_ins],
        "last": [vocabulary[symbol + END_OF_WORD] for symbol in stand_ins],
        "special": [token["content"] for token in content["added_tokens"]],
    }


@lru_cache(maxsize=2)
def rank_vocabulary(path: str) -> dict:
    """Ranks of a byte-level rank file: ``whole`` by bytes, ``pairs`` by two ids, ``bytes`` by id.

    Any two tokens whose bytes joined are a token may merge, at that token's rank."""
    whole = {}
    with open(path, "rb") as file:
        for line in file:
            if line.strip():
                token, rank = line.split()
                whole[base64.b64decode(token)] = int(rank)
    pairs = {}
    for token, rank in whole.items():
        for cut in range(1, len(token)):
            left, right = whole.get(token[:cut]), whole.get(token[cut:])
            if left is not None and right is not None:
                pairs[left, right] = (rank, rank)
    names = [b""] * (max(whole.values(), default=-1) + 1)
    for token, rank in whole.items():
        names[rank] = token
    return {"whole": whole, "pairs": pairs, "bytes": names}
