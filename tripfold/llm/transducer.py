"""Minimal acyclic transducers: sorted terms in, each one's place in their order out.

States with the same set of continuations are one state, so shared endings are stored once
as shared beginnings are.  Every arc carries how many terms come before those that lead
through it; the sum along a path is the term's ordinal."""

from collections.abc import Iterable, Iterator

import numpy as np


class Transducer:
    """Arcs sorted by state and byte: keys (state * 256 + byte), targets and outputs."""

    def __init__(self, final: list[bool], arcs: list[tuple], counts: list[int], root: int):
        self.root, self.number = root, counts[root]
        self.final = np.array(final, dtype=bool)
        keys, targets, skips = [], [], []
        for state, pairs in enumerate(arcs):
            before = int(final[state])
            for byte, target in pairs:
                keys.append(state * 256 + byte)
                targets.append(target)
                skips.append(before)
                before += counts[target]
        self.keys = np.array(keys, dtype=np.int64)
        self.targets = np.array(targets, dtype=np.int32)
        self.skips = np.array(skips, dtype=np.int64)

    def ordinals(self, terms: list[bytes]) -> np.ndarray:
        """Each term's ordinal, or -1; all terms move through the arcs side by side, one
        byte of each at a time, and one that finds no arc leaves."""
        found = np.full(len(terms), -1, dtype=np.int64)
        if not terms or not len(self.keys):
            found[[k for k, term in enumerate(terms) if not term and self.final[self.root]]] = 0
            return found
        flat = np.frombuffer(b"".join(terms), dtype=np.uint8)
        lengths = np.fromiter(map(len, terms), dtype=np.int64, count=len(terms))
        starts = np.cumsum(lengths) - lengths
        moving = np.arange(len(terms))
        state = np.full(len(terms), self.root, dtype=np.int64)
        sums = np.zeros(len(terms), dtype=np.int64)
        position = 0
        while len(moving):
            done = lengths[moving] == position
            if done.any():
                ended = done & self.final[state]
                found[moving[ended]] = sums[ended]
                moving, state, sums = moving[~done], state[~done], sums[~done]
            wanted = state * 256 + flat[starts[moving] + position]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[at] == wanted
            moving, at = moving[hit], at[hit]
            state, sums = self.targets[at].astype(np.int64), sums[hit] + self.skips[at]
            position += 1
        return found

    def terms(self) -> Iterator[bytes]:
        """All terms in their order."""
        ends = np.searchsorted(self.keys, np.arange(len(self.final) + 1) * 256).tolist()
        keys, targets = (self.keys & 255).tolist(), self.targets.tolist()
        stack = [(self.root, b"")]
        while stack:
            state, prefix = stack.pop()
            if self.final[state]:
                yield prefix
            for arc in range(ends[state + 1] - 1, ends[state] - 1, -1):
                stack.append((targets[arc], prefix + bytes((keys[arc],))))


def build(terms: Iterable[bytes]) -> Transducer:
    """From distinct terms in byte order, in one pass.

    Only the path of the last term is open; what the next one leaves behind is closed from
    its end and merged with an equal state if there is one."""
    final: list[bool] = []
    arcs: list[tuple] = []
    counts: list[int] = []
    known: dict[tuple, int] = {}
    path: list[list] = [[False, []]]
    labels: list[int] = []  # of the arcs between the open states
    last: bytes | None = None

    def closed(node: list) -> int:
        key = (node[0], *node[1])
        state = known.get(key)
        if state is None:
            state = known[key] = len(final)
            final.append(node[0])
            arcs.append(tuple(node[1]))
            counts.append(node[0] + sum(counts[target] for _, target in node[1]))
        return state

    def close_to(depth: int) -> None:
        while len(labels) > depth:
            state = closed(path.pop())
            path[-1][1].append((labels.pop(), state))

    for term in terms:
        if last is not None and term <= last:
            raise ValueError("terms must be distinct and in byte order")
        shared = 0
        for one, other in zip(term, last or b"", strict=False):
            if one != other:
                break
            shared += 1
        close_to(shared)
        for byte in term[shared:]:
            labels.append(byte)
            path.append([False, []])
        path[-1][0] = True
        last = term
    close_to(0)
    return Transducer(final, arcs, counts, closed(path[0])) if final or path[0][0] else Transducer(
        [False], [()], [0], 0
    )
