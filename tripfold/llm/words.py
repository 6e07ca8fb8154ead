"""Words between white space, cut into the parts a word-end vocabulary merges in."""

import re
from functools import lru_cache

import pyarrow as pa

#: Below this character nothing composes, no lower case looks at its neighbours, and classes
#: are the same in every Unicode version.
PLAIN_END = "\u0180"
#: The split of the word-end vocabulary for lower-cased text below PLAIN_END, and
#: what is white space to it.
LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
WHITE = "\t-\r \x85\xa0"
PARTS = re.compile(
    f"[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{NUMBERS}]|[^{LETTERS}{NUMBERS}{WHITE}]+"
)
BEYOND_PLAIN = re.compile(f"[{PLAIN_END}-\U0010ffff]")
SEPARATORS = "\x1c\x1d\x1e\x1f"
BLANKS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def chunks(text: str) -> list[str]:
    """Runs without white space.

    ``str.split`` also splits at four control characters that are ordinary symbols here."""
    if any(mark in text for mark in SEPARATORS):
        return [chunk for chunk in BLANKS.split(text) if chunk]
    return text.split()


@lru_cache(maxsize=1)
def library(path: str):
    """The vocabulary's own library, one thread a task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def plain(text: str) -> bool:
    return text.isascii() or not BEYOND_PLAIN.search(text)


def parts(chunk: str, path: str) -> list[str]:
    """The parts of a chunk, or of a whole plain text, that holds no special string.

    Composition and the classes of characters beyond the plain ones are the library's."""
    if plain(chunk):
        return PARTS.findall(chunk.lower())
    own = library(path)
    normal = own.normalizer.normalize_str(chunk)
    return [normal[a:b] for _, (a, b) in own.pre_tokenizer.pre_tokenize_str(normal)]


def with_specials(special: list[str]):
    """Splits a chunk at special strings; those stand at odd places of the result."""
    pattern = re.compile("(" + "|".join(re.escape(text) for text in special) + ")")
    return pattern.split


class Bounded(dict):
    """A cache of what can always be computed again, bounded by the bytes it holds.

    It starts anew when it is full.  Caches belong to one kind of work; a worker that turns
    to another kind gives them up, see ``working``."""

    ENTRY_BYTES = 180  # a slot, two small objects and what the allocator adds

    def __init__(self, make=None, limit: int = 48 << 20):
        super().__init__()
        self.make, self.limit, self.held = make, limit, 0
        _caches.append(self)

    def __missing__(self, key):
        value = self.make(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if self.held >= self.limit:
            self.release()
        self[key] = value
        self.held += self.ENTRY_BYTES + len(key) + (8 if isinstance(value, int) else len(value))

    def keep_all(self, entries: dict) -> None:
        if self.held >= self.limit:
            self.release()
        self.update(entries)
        self.held += sum(map(len, entries)) + sum(map(len, entries.values()))
        self.held += self.ENTRY_BYTES * len(entries)

    def release(self) -> None:
        self.clear()
        self.held = 0


_caches: list[Bounded] = []
_work: list[str] = [""]


def working(kind: str) -> None:
    """Say what kind of work this worker's next task does; other work's caches go."""
    if _work[0] != kind:
        for cache in _caches:
            cache.release()
        library.cache_clear()
        _work[0] = kind
        pa.default_memory_pool().release_unused()
