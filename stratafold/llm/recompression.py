"""A run-length grammar of sequences by recompression, and longest common extensions on it.

Rounds alternate.  A block round gives every maximal repetition of one symbol a symbol of its
own; a pair round splits the symbols by a hash into left and right ones and joins each left
one with a right one behind it.  Both depend on the symbols alone, so equal stretches are cut
alike but for their ends, and two places are compared by climbing from the words to ever longer
symbols and down again.  No suffix array is built.
"""

from __future__ import annotations

import numpy as np

# A pair round joins a quarter of all neighbours in the mean, so so many rounds suffice for any
# input in memory; what they leave is compared symbol by symbol.
MAX_ROUNDS = 80

_STEP = 0x9E3779B97F4A7C15


class _Level:
    """Symbols of one level; ``starts`` has the place of each and, last, the end of all."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, of_blocks: bool):
        self.symbols, self.starts, self.of_blocks = symbols, starts, of_blocks


def _sides(symbols: np.ndarray, number: int) -> np.ndarray:
    """Whether a symbol is a left one in this round."""
    step = np.uint64(_STEP)
    mixed = (symbols.astype(np.uint64) + np.uint64((number + 1) * _STEP % 2**64)) * step
    mixed ^= mixed >> np.uint64(31)
    return (mixed * step >> np.uint64(63)).astype(bool)


def _blocks(level: _Level, free: int) -> tuple[_Level | None, int]:
    """The next level after a block round, None if nothing repeats; ``free`` is the first unused symbol."""
    symbols = level.symbols
    first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
    if len(first) == len(symbols):
        return None, free
    count = np.diff(np.append(first, len(symbols)))
    merged = symbols[first]
    long = np.flatnonzero(count > 1)
    names, place = np.unique(np.stack([merged[long], count[long]]), axis=1, return_inverse=True)
    merged[long] = free + place.reshape(-1)
    return _Level(merged, np.append(level.starts[first], level.starts[-1]), True), free + names.shape[1]


def _pairs(level: _Level, free: int, number: int) -> tuple[_Level | None, int]:
    """The next level after a pair round, None if no pair is joined.  Negative symbols stay alone."""
    symbols = level.symbols
    left = _sides(symbols, number)
    joined = np.flatnonzero(left[:-1] & ~left[1:] & (symbols[:-1] >= 0) & (symbols[1:] >= 0))
    if not len(joined):
        return None, free
    names, place = np.unique(symbols[joined] * np.int64(free) + symbols[joined + 1], return_inverse=True)
    merged = symbols.copy()
    merged[joined] = free + place
    keep = np.ones(len(symbols), bool)
    keep[joined + 1] = False
    return _Level(merged[keep], np.append(level.starts[:-1][keep], level.starts[-1]), False), free + len(names)


class Grammar:
    """Levels over a sequence of symbols from 0 on; negative ones are ends that equal nothing."""

    def __init__(self, symbols: np.ndarray):
        symbols = np.asarray(symbols, np.int64)
        level = _Level(symbols, np.arange(len(symbols) + 1), False)
        self._levels = [level]
        free = int(symbols.max(initial=-1)) + 1
        ends = int((symbols < 0).sum())
        for number in range(MAX_ROUNDS):
            if len(level.symbols) <= 2 * ends + 1:
                break
            blocks, free = _blocks(level, free)
            pairs, free = _pairs(blocks or level, free, number)
            made = [new for new in (blocks, pairs) if new is not None]
            self._levels += made
            level = self._levels[-1]

    def _step(self, number: int, x: np.ndarray, y: np.ndarray, forward: bool, climb: bool) -> np.ndarray:
        """How far each pair of places can go on level ``number``: a symbol, or what both have left of a block."""
        level = self._levels[number]
        starts, symbols = level.starts, level.symbols
        above = self._levels[number + 1] if number + 1 < len(self._levels) else None
        i, j = np.searchsorted(starts, x), np.searchsorted(starts, y)
        here = (starts[i] == x) & (starts[j] == y)
        if not forward:
            i, j = i - 1, j - 1
        inside = here & (i >= 0) & (j >= 0) & (i < len(symbols)) & (j < len(symbols))
        i, j = np.where(inside, i, 0), np.where(inside, j, 0)
        equal = inside & (symbols[i] == symbols[j]) & (symbols[i] >= 0)
        go = np.where(equal, starts[i + 1] - starts[i], 0)
        if above is not None and (climb or above.of_blocks):
            side = "right" if forward else "left"
            p, q = np.searchsorted(above.starts, x, side) - 1, np.searchsorted(above.starts, y, side) - 1
            p, q = np.clip(p, 0, len(above.symbols) - 1), np.clip(q, 0, len(above.symbols) - 1)
            if above.of_blocks:
                rest = np.minimum(above.starts[p + 1] - x, above.starts[q + 1] - y) if forward else np.minimum(x - above.starts[p], y - above.starts[q])
                go = np.where(equal, rest, 0)
            if climb:
                edge_x = above.starts[p] == x if forward else above.starts[p + 1] == x
                edge_y = above.starts[q] == y if forward else above.starts[q + 1] == y
                go = np.where(edge_x & edge_y, 0, go)
        return go

    def _extend(self, x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
        total = np.zeros(len(x), np.int64)
        top = len(self._levels) - 1
        turn = 1 if forward else -1
        for number, climb in [*((n, True) for n in range(top)), *((n, False) for n in range(top, -1, -1))]:
            active = np.arange(len(x))
            while len(active):
                go = self._step(number, x[active] + turn * total[active], y[active] + turn * total[active], forward, climb)
                total[active] += go
                active = active[go > 0]
        return total

    def common_ahead(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For each pair of places, how many symbols from there on are the same."""
        return self._extend(np.asarray(x), np.asarray(y), True)

    def common_behind(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For each pair of places, how many symbols right before them are the same."""
        return self._extend(np.asarray(x), np.asarray(y), False)
