"""Minimal acyclic transducer: a sorted vocabulary that maps each term to its
lexicographic ordinal.

Built in one pass over terms in byte order: the states behind the prefix that a
term shares with the next one can't change any more, so each is replaced by an
equal state met before or registered.  An edge's output is the number of terms
that come before all terms through it; the outputs along a term add up to its
ordinal.  States have a 256-bit map of their edges' bytes, so a step is two
look-ups for any alphabet, and `read` takes all words of a text a byte at a time.
"""

from __future__ import annotations

import pickle

import numpy as np

STEP = np.int64(1 << 32)


class Builder:
    def __init__(self):
        self.register: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.below: list[int] = []
        self.path: list[list] = [[False, []]]
        self.last = b""

    def add(self, term: bytes) -> None:
        """Take the next term, which must be greater than the last one."""
        same, most = 0, min(len(term), len(self.last))
        while same < most and term[same] == self.last[same]:
            same += 1
        self._freeze(same)
        for byte in term[same:]:
            self.path[-1][1].append((byte, -1))
            self.path.append([False, []])
        self.path[-1][0] = True
        self.last = term

    def _freeze(self, depth: int) -> None:
        while len(self.path) > depth + 1:
            child = self._state(self.path.pop())
            edges = self.path[-1][1]
            edges[-1] = (edges[-1][0], child)

    def _state(self, made: list) -> int:
        key = (made[0], tuple(made[1]))
        known = self.register.get(key)
        if known is None:
            known = self.register[key] = len(self.states)
            self.states.append(key)
            self.below.append(made[0] + sum(self.below[c] for _, c in made[1]))
        return known

    def packed(self) -> bytes:
        """The transducer; nothing can be added any more."""
        self._freeze(0)
        self._state(self.path.pop())
        edges, bytes_, targets, outputs = [], bytearray(), [], []
        for final, out in self.states:
            edges.append(len(out))
            before = int(final)
            for byte, child in out:
                bytes_.append(byte)
                targets.append(child)
                outputs.append(before)
                before += self.below[child]
        return pickle.dumps((np.array(edges, dtype=np.uint16), bytes(bytes_), np.array(targets, dtype=np.uint32),
                             np.array(outputs, dtype=np.uint32), np.packbits([f for f, _ in self.states])))


class Transducer:
    def __init__(self, packed: bytes):
        edges, bytes_, targets, outputs, final = pickle.loads(packed)
        n = len(edges)
        byte = np.frombuffer(bytes_, dtype=np.uint8)
        word = np.repeat(np.arange(n, dtype=np.int64), edges) * 4 + (byte >> 6)
        self.bits = np.zeros(4 * n, dtype=np.uint64)
        np.bitwise_or.at(self.bits, word, np.uint64(1) << (byte & 63).astype(np.uint64))
        count = np.bincount(word, minlength=4 * n)
        # Edges lie by state and byte, so each word's edges are a run.
        self.base = np.cumsum(count) - count
        self.edges = targets.astype(np.int64) * STEP + outputs
        self.final = np.unpackbits(final, count=n).astype(bool)
        self.root = n - 1

    def read(self, text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which, ordinal) of the words that are terms; word i lies in `text`
        from starts[i] to the next zero byte, and the text ends with one."""
        which = np.arange(len(starts))
        at, state, ordinal = starts.astype(np.int64), np.full(len(starts), self.root), np.zeros(len(starts), dtype=np.int64)
        found, values = [], []
        while len(at):
            byte = text[at]
            ends = byte == 0
            if ends.any():
                done = ends & self.final[state]
                found.append(which[done])
                values.append(ordinal[done])
            spot = state * 4 + (byte >> 6)
            bits, low = self.bits[spot], (byte & 63).astype(np.uint64)
            goes = ((bits >> low) & np.uint64(1)).astype(bool) & ~ends
            spot, bits, low = spot[goes], bits[goes], low[goes]
            rank = np.bitwise_count(bits & ((np.uint64(1) << low) - np.uint64(1)))
            edge = self.edges[self.base[spot] + rank]
            which, at, ordinal = which[goes], at[goes] + 1, ordinal[goes] + edge % STEP
            state = edge // STEP
        if not found:
            return which[:0], ordinal[:0]
        return np.concatenate(found), np.concatenate(values)
