"""Sets of five-word shingles as hashes, and signatures over them."""

import re

import numpy as np
import xxhash

from tripfold.llm.words import Bounded

SIZE = 5
WINDOW = 1 << 20  # bytes of a text whose words are held at a time
BLANK = re.compile(rb"[\t-\r ]")
#: Odd factors that combine the hashes of a shingle's words, one for each place.
FACTORS = np.array(
    [xxhash.xxh3_64_intdigest(b"place %d" % k) | 1 for k in range(SIZE)], dtype=np.uint64
)
_hash_of = Bounded(xxhash.xxh3_64_intdigest)


def shingle_set(text: str) -> np.ndarray:
    """The distinct shingles of a text, sorted, as 64-bit hashes.

    Words are runs without ASCII white space, A to Z in lower case; fewer than five words
    form one shingle, none an empty set.  Two different shingles share a hash with a
    chance of 2^-64."""
    data = text.encode("utf-8", "surrogatepass")
    parts, held = [], np.empty(0, dtype=np.uint64)  # the last words of the windows before
    start = 0
    while start < len(data):
        blank = BLANK.search(data, start + WINDOW)
        end = blank.start() if blank else len(data)
        words = data[start:end].lower().split()
        start = end
        hashes = np.fromiter(map(_hash_of.__getitem__, words), np.uint64, len(words))
        held = np.concatenate([held, hashes])
        if len(held) >= SIZE:
            parts.append(_shingles(held))
            held = held[len(held) - SIZE + 1 :]
    if parts:
        return np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
    if not len(held):
        return held
    combined = (held * FACTORS[: len(held)]).sum(dtype=np.uint64)
    return np.array([combined ^ np.uint64(len(held))], dtype=np.uint64)


def _shingles(hashes: np.ndarray) -> np.ndarray:
    """The distinct hashes of all runs of words, sorted."""
    count = len(hashes) - SIZE + 1
    value = np.zeros(count, dtype=np.uint64)
    for k in range(SIZE):
        value += hashes[k : k + count] * FACTORS[k]
    value ^= value >> np.uint64(32)
    return np.unique(value * np.uint64(0x9E3779B97F4A7C15))


class Signer:
    """The least value of each of many hash functions over a set."""

    def __init__(self, coordinates: int, seed: int = 11):
        random = np.random.default_rng(seed)
        self.factors = random.integers(0, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(
            2
        ) + np.uint64(1)
        self.shifts = random.integers(0, 1 << 63, coordinates, dtype=np.uint64)

    def sign(self, hashes: np.ndarray) -> np.ndarray:
        """64 bits for each coordinate, of which the upper ones are well mixed."""
        least = np.full(len(self.factors), np.iinfo(np.uint64).max, dtype=np.uint64)
        for start in range(0, len(hashes), 2048):
            part = hashes[start : start + 2048]
            values = part[None, :] * self.factors[:, None] + self.shifts[:, None]
            least = np.minimum(least, values.min(axis=1))
        return least


def halves(least: np.ndarray) -> tuple[bytes, bytes]:
    """The upper 32 bits of each value, by which signatures are compared, and the 16 below,
    which tell tokens apart in a large corpus."""
    upper, lower = least >> np.uint64(32), (least >> np.uint64(16)) & np.uint64(0xFFFF)
    return upper.astype("<u4").tobytes(), lower.astype("<u2").tobytes()


def tokens(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Coordinate and 48 bits of its value in one number; rows are documents.

    Unrelated sets of n shingles share one with a chance of n / 2^48 a coordinate, so of
    10^10 documents some hundredth of a stranger stands in a list."""
    places = np.arange(upper.shape[1], dtype=np.int64) << 48
    return (upper.astype(np.int64) << 16) + lower.astype(np.int64) + places


def common(one: np.ndarray, other: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(one) > len(other):
        one, other = other, one
    at = np.searchsorted(other, one)
    at[at == len(other)] = 0
    return int((other[at] == one).sum()) if len(other) else 0
