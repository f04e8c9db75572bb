"""A minimal acyclic transducer: sorted terms to their positions in the order, in as few states as can be.

States that accept the same endings are one state.  An edge carries the number of terms that come before
those reached through it; the numbers along a term's path sum to the term's ordinal.
"""

from dataclasses import dataclass

import numpy as np


@dataclass
class Transducer:
    """Edges in order of (state, byte): ``key`` is state * 256 + byte; ``skip`` is the edge's number."""

    key: np.ndarray
    target: np.ndarray
    skip: np.ndarray
    final: np.ndarray
    root: int
    n_terms: int

    @property
    def nbytes(self) -> int:
        return self.key.nbytes + self.target.nbytes + self.skip.nbytes + self.final.nbytes

    def term(self, ordinal: int) -> bytes:
        """The term with an ordinal; the inverse of the lookup."""
        out, state = bytearray(), self.root
        while not (self.final[state] and ordinal == 0):
            a, b = np.searchsorted(self.key, (state << 8, (state + 1) << 8))
            edge = a + int(np.searchsorted(self.skip[a:b], ordinal, "right")) - 1
            out.append(int(self.key[edge]) & 255)
            ordinal -= int(self.skip[edge])
            state = int(self.target[edge])
        return bytes(out)


def build(terms: list[bytes]) -> Transducer:
    """The minimal transducer of distinct terms in sorted order."""
    register: dict[tuple, int] = {}
    below: list[int] = []

    def settle(node: list) -> int:
        """The state that equals a finished node; a new one only if there is none."""
        shape = (node[0], *node[1])
        state = register.get(shape)
        if state is None:
            state = register[shape] = len(below)
            below.append(node[0] + sum(below[to] for _, to in node[1]))
        return state

    path, last = [[False, []]], b""  # path[k]: the open node after k bytes of the last term

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(node)))

    for term in terms:
        common, shorter = 0, min(len(term), len(last))
        while common < shorter and term[common] == last[common]:
            common += 1
        close(common)
        path.extend([False, []] for _ in range(len(term) - common))
        path[-1][0] = True
        last = term
    close(0)
    root = settle(path[0])
    key, target, skip, final = [], [], [], np.zeros(len(below), bool)
    for (is_final, *edges), state in register.items():
        final[state] = is_final
        before = int(is_final)
        for byte, to in edges:
            key.append(state << 8 | byte)
            target.append(to)
            skip.append(before)
            before += below[to]
    return Transducer(np.array(key, np.int64), np.array(target, np.int32), np.array(skip, np.int32), final, root, len(terms))


class Vocabulary:
    """Transducers of consecutive ranges of one sorted vocabulary, searched for many words at once."""

    def __init__(self, parts: list[tuple[bytes, int, Transducer]]):
        """``parts``: first term, its ordinal, transducer; in order."""
        states = np.cumsum([0, *[len(t.final) for _, _, t in parts]])
        self.firsts = _prefixes(np.frombuffer(b"".join(f for f, _, _ in parts), np.uint8),
                                np.cumsum([0, *[len(f) for f, _, _ in parts]])[:-1], np.array([len(f) for f, _, _ in parts]))
        self.offset = np.array([o for _, o, _ in parts], np.int64)
        self.root = np.array([t.root + s for (_, _, t), s in zip(parts, states)], np.int64)
        self.key = np.concatenate([t.key + (s << 8) for (_, _, t), s in zip(parts, states)])
        self.target = np.concatenate([t.target + s for (_, _, t), s in zip(parts, states)])
        self.skip = np.concatenate([t.skip for _, _, t in parts])
        self.final = np.concatenate([t.final for _, _, t in parts])

    def ordinals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ordinal of each word ``data[start:end]``, -1 for words that are no terms."""
        out = np.full(len(starts), -1, np.int64)
        prefix = _prefixes(data, starts, ends - starts)
        # a word's range is the last that does not begin behind it; beginnings are compared by eight bytes
        part = np.searchsorted(self.firsts, prefix, "right") - 1
        least = np.searchsorted(self.firsts, prefix, "left") - 1
        rows = np.flatnonzero(part >= 0)
        while len(rows):
            out[rows] = self._walk(data, starts[rows], ends[rows], part[rows])
            rows = rows[(out[rows] < 0) & (part[rows] > np.maximum(least[rows], 0))]
            part[rows] -= 1
        return out

    def _walk(self, data: np.ndarray, at: np.ndarray, end: np.ndarray, part: np.ndarray) -> np.ndarray:
        """All words go through their transducer at the same time, one byte a step."""
        out = np.full(len(at), -1, np.int64)
        rows, state, ordinal = np.arange(len(at)), self.root[part], self.offset[part]
        while len(rows) and len(self.key):
            key = state << 8 | data[at]
            edge = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            go = np.flatnonzero(self.key[edge] == key)
            edge, rows, at, end = edge[go], rows[go], at[go] + 1, end[go]
            state, ordinal = self.target[edge], ordinal[go] + self.skip[edge]
            over = at == end
            hit = np.flatnonzero(over & self.final[state])
            out[rows[hit]] = ordinal[hit]
            go = np.flatnonzero(~over)
            rows, at, end, state, ordinal = rows[go], at[go], end[go], state[go], ordinal[go]
        return out


def _prefixes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first eight bytes of words as numbers in the order of the words; shorter ones are filled with zeros."""
    out = np.zeros(len(starts), np.uint64)
    for k in range(8):
        there = np.flatnonzero(lengths > k)
        out[there] |= data[starts[there] + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out
