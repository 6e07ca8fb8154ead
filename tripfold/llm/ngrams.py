"""Hashed counts of character and word n-grams over whole texts."""

import re
from collections.abc import Iterator

import numpy as np

STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
WINDOW = 1 << 16
BLANK = re.compile(r"[\t-\r \xa0]")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def character_buckets(points: np.ndarray, size: int, buckets: int) -> np.ndarray:
    """The bucket of each run of ``size`` characters; none if the text is shorter."""
    count = len(points) - size + 1
    if count <= 0:
        return np.empty(0, dtype=np.int64)
    value = np.full(count, size, dtype=np.uint64)
    for k in range(size):
        value = value * STEP + points[k : k + count]
    return (_mixed(value) % np.uint64(buckets)).astype(np.int64)


def character_counts(text: str, sizes: tuple[int, ...], buckets: int) -> np.ndarray:
    """Counts of all runs of the given sizes; a long text is cut into overlapping windows,
    which count every run once."""
    counts = np.zeros(buckets, dtype=np.int64)
    for start in range(0, len(text), WINDOW):
        points = code_points(text[start : start + WINDOW + max(sizes) - 1])
        for size in sizes:
            part = points[: WINDOW + size - 1]
            counts += np.bincount(character_buckets(part, size, buckets), minlength=buckets)
    return counts


def blank_windows(text: str) -> Iterator[str]:
    """The text in windows that end before white space, so that no word is cut."""
    start = 0
    while start < len(text):
        blank = BLANK.search(text, start + WINDOW)
        end = blank.start() if blank else len(text)
        yield text[start:end]
        start = end


def word_counts(text: str, buckets: int) -> np.ndarray:
    """Counts of the words between white space; a long text is counted in windows."""
    counts = np.zeros(buckets, dtype=np.int64)
    for part in blank_windows(text):
        counts += _word_counts(part, buckets)
    return counts


def _word_counts(text: str, buckets: int) -> np.ndarray:
    points = code_points(text)
    if not len(points):
        return np.zeros(buckets, dtype=np.int64)
    inside = ~((points == 32) | ((points >= 9) & (points <= 13)) | (points == 160))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(buckets, dtype=np.int64)
    # A word's value is the polynomial of its characters; sums of prefixes give it.
    with np.errstate(over="ignore"):
        powers = np.ones(len(points), dtype=np.uint64)
        powers[1:] = STEP
        powers = np.cumprod(powers, dtype=np.uint64)
        inverse = np.ones(len(points), dtype=np.uint64)
        inverse[1:] = BACK
        inverse = np.cumprod(inverse, dtype=np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(points * powers, dtype=np.uint64)])
        values = (sums[ends] - sums[starts]) * inverse[starts]
    return np.bincount(
        (_mixed(values) % np.uint64(buckets)).astype(np.int64), minlength=buckets
    )
