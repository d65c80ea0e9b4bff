"""Merging sorted runs by a loser tree that never compares a known common prefix again."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """For each row of a matrix of bytes, the length of the prefix it shares with the row before."""
    out = np.zeros(len(rows), np.int64)
    for at in range(1, len(rows), 1 << 16):
        end = min(len(rows), at + (1 << 16))
        off = rows[at:end] != rows[at - 1 : end - 1]
        out[at:end] = np.where(off.any(axis=1), off.argmax(axis=1), rows.shape[1])
    return out


class Run:
    """A sorted run, front-coded: of each string only what follows the prefix shared with the one before."""

    def __init__(self, prefixes: Sequence[int], tails: bytes, length: int):
        self.prefixes, self.tails, self.length = prefixes, tails, length
        self.at, self.offset, self.string = -1, 0, b""

    def advance(self) -> int:
        """Step to the next string; its prefix shared with the one before, or -1 at the end."""
        self.at += 1
        if self.at >= len(self.prefixes):
            return -1
        prefix = self.prefixes[self.at]
        end = self.offset + self.length - prefix
        self.string = self.string[:prefix] + self.tails[self.offset : end]
        self.offset = end
        return prefix


def merged(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """(run, position in it, prefix shared with the string given before), in order of the strings.

    A run waits in the tree with the length of the prefix that its string shares with the one that
    beat it. Of two runs that lost to the same string, the one with the longer such prefix is the
    smaller; only on equal lengths are bytes compared, and only those behind the prefix.
    """
    k = 1
    while k < len(runs):
        k *= 2
    known = [run.advance() for run in runs]
    if not runs:
        return

    def beats(a: int, b: int) -> bool:
        """Whether run a's string comes first; notes the loser's prefix shared with the winner."""
        if b < 0 or known[b] < 0:
            return True
        if a < 0 or known[a] < 0:
            return False
        at = known[a]
        if at != known[b]:
            return at > known[b]
        x, y = runs[a].string[at:], runs[b].string[at:]
        if x == y:
            known[b] = at + len(x)
            return True
        off = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
        shared = at + len(x) - (off.bit_length() + 7) // 8
        if x < y:
            known[b] = shared
            return True
        known[a] = shared
        return False

    tree = [-1] * k
    level = [i if i < len(runs) else -1 for i in range(k)]
    first = k
    while first > 1:
        first //= 2
        winners = []
        for i in range(first):
            a, b = level[2 * i], level[2 * i + 1]
            if beats(a, b):
                winners.append(a)
                tree[first + i] = b
            else:
                winners.append(b)
                tree[first + i] = a
        level = winners
    winner = level[0]
    while winner >= 0 and known[winner] >= 0:
        run = runs[winner]
        yield winner, run.at, known[winner]
        known[winner] = run.advance()
        node = (winner + k) // 2
        while node:
            if beats(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2
