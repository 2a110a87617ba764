"""Double-array tries over sequences of numbers, walked by numpy for all places of a text at once."""

from __future__ import annotations

import numpy as np

# A number is spelled in digits of this base, so that the children of a node fill a narrow range.
BITS = 10
BASE = 1 << BITS
# Nodes with so many children look for their place one by one, those with fewer all at once.
_WIDE = 24


class DoubleArray:
    """Sequences of one length over non-negative numbers.

    The children of the node at ``s`` stand at ``base[s] + digit``; ``check`` holds the parent
    of each used place, and -1 elsewhere.  ``number`` gives the row in ``phrases`` at
    whose end a node stands.  ``phrases`` are in ascending order.
    """

    def __init__(self, phrases: np.ndarray, seed: int = 1):
        phrases = np.unique(np.asarray(phrases, np.int64), axis=0)
        self.phrases, self.length = phrases, phrases.shape[1]
        most = int(phrases.max(initial=0))
        self.digits = max(1, -(-most.bit_length() // BITS))
        self._rng = np.random.default_rng(seed)
        spelled = np.stack(
            [(phrases[:, j] >> (BITS * d)) & (BASE - 1) for j in range(self.length) for d in reversed(range(self.digits))],
            axis=1,
        )
        self._grow(4 * len(phrases) + 4 * BASE)
        self.check[0] = 0  # the root
        self._place(spelled)
        used = np.flatnonzero(self.check >= 0)
        self.base, self.check = self.base[: used[-1] + 2 * BASE], self.check[: used[-1] + 2 * BASE]
        self.number = self.number[: len(self.base)]

    def _grow(self, size: int) -> None:
        old = len(self.base) if hasattr(self, "base") else 0
        new = np.full(size - old, -1, np.int32)
        if not old:
            self.base, self.check, self.number = np.zeros(size, np.int32), new, new.copy()
        else:
            self.base = np.concatenate([self.base, np.zeros(size - old, np.int32)])
            self.check = np.concatenate([self.check, new])
            self.number = np.concatenate([self.number, new])

    def _place(self, spelled: np.ndarray) -> None:
        n, depth = spelled.shape
        at = np.zeros(n, np.int64)  # the node that each phrase has come to
        fresh = np.zeros(n, bool)
        fresh[:1] = True
        for d in range(depth):
            before = fresh.copy()
            fresh[1:] |= spelled[1:, d] != spelled[:-1, d]
            first = np.flatnonzero(fresh)  # one row for each child
            parent = np.searchsorted(np.flatnonzero(before), first, "right") - 1
            nodes, digit = at[np.flatnonzero(before)], spelled[first, d]
            self._settle(nodes, parent, digit)
            child = self.base[nodes[parent]] + digit
            at = child[np.cumsum(fresh) - 1]
        self.number[at] = np.arange(n, dtype=np.int32)

    def _settle(self, nodes: np.ndarray, parent: np.ndarray, digit: np.ndarray) -> None:
        """Find a base for each node such that its children's places are free."""
        begin = np.searchsorted(parent, np.arange(len(nodes) + 1))
        sizes = np.diff(begin)
        for i in np.flatnonzero(sizes >= _WIDE)[np.argsort(-sizes[sizes >= _WIDE], kind="stable")].tolist():
            self._settle_wide(int(nodes[i]), digit[begin[i] : begin[i + 1]])
        for size in range(_WIDE - 1, 0, -1):
            rows = np.flatnonzero(sizes == size)
            own = digit[begin[rows][:, None] + np.arange(size)]
            failed = 0
            while len(rows):
                tried = self._rng.integers(1, len(self.base) - BASE, len(rows))
                places = tried[:, None] + own
                flat = places.ravel()
                # Of several that ask for a place the first one has it.
                _, owner, group = np.unique(flat, return_index=True, return_inverse=True)
                mine = (owner[group] // size == np.arange(len(flat)) // size).reshape(places.shape)
                good = (mine & (self.check[places] < 0)).all(axis=1)
                self.base[nodes[rows[good]]] = tried[good]
                self.check[places[good]] = nodes[rows[good], None]
                failed = failed + 1 if good.mean() < 0.05 else 0
                rows, own = rows[~good], own[~good]
                if failed > 4:
                    self._grow(len(self.base) * 3 // 2)

    def _settle_wide(self, node: int, digit: np.ndarray) -> None:
        while True:
            for _ in range(8):
                tried = self._rng.integers(1, len(self.base) - BASE, 64)
                free = (self.check[tried[:, None] + digit] < 0).all(axis=1)
                if free.any():
                    base = int(tried[np.argmax(free)])
                    self.base[node] = base
                    self.check[base + digit] = node
                    return
            self._grow(len(self.base) * 3 // 2)

    def walk(self, tokens: np.ndarray) -> np.ndarray:
        """For each place of ``tokens`` the number of the phrase that begins there, -1 for none.

        All places go down one level at a time; those without a phrase drop out.
        Negative tokens belong to no phrase.
        """
        out = np.full(len(tokens), -1, np.int32)
        place = np.arange(max(len(tokens) - self.length + 1, 0))
        state = np.zeros(len(place), np.int64)
        for j in range(self.length):
            token = tokens[place + j]
            fits = (token >= 0) & (token < 1 << (BITS * self.digits))
            place, state, token = place[fits], state[fits], token[fits]
            for d in reversed(range(self.digits)):
                digit = (token >> (BITS * d)) & (BASE - 1)
                child = self.base[state] + digit
                fits = self.check[child] == state
                place, state, token = place[fits], child[fits], token[fits]
        out[place] = self.number[state]
        return out
