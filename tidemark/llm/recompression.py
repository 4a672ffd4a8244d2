"""Recompression of sequences of numbers into a run-length grammar, and how far two places of a sequence agree.

Every round first writes maximal blocks of one symbol as one symbol (its letter and length) and then pairs of neighbours whose
letters fall on opposite sides of a coin. Equal stretches are so written alike but for their ends, which lets a question climb from
the words to where the two places differ and come back, with a fixed number of steps in each level, for very many places at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

from tidemark.llm.blocks import mixed


@dataclass
class Level:
    """The sequence after some rounds. ``first`` are the places where the next level's symbols begin, and the length; ``up`` is the next
    level's symbol over each place; ``most`` is how many steps differing parents with the same first letter share: one below pairs."""

    symbols: np.ndarray
    first: np.ndarray | None = None
    up: np.ndarray | None = None
    pairs: bool = False

    def group(self, first: np.ndarray, pairs: bool) -> None:
        self.first, self.pairs = np.append(first, len(self.symbols)).astype(np.int32), pairs
        self.up = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(self.first))


def _renumbered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers for the pairs of ``a`` and ``b``, equal for equal pairs, and how many there are."""
    codes, known = pd.factorize(a.astype(np.int64) * (int(b.max()) + 1) + b)
    return codes.astype(np.int32), len(known)


def _heads(s: np.ndarray, turn: int) -> np.ndarray:
    """Whether each place and the next one become a pair: neighbours on opposite sides, in the order that gives more pairs."""
    side = (mixed(s.astype(np.uint64) + np.uint64((turn + 1) << 32)) & np.uint64(1)).astype(bool)
    one, other = side[:-1] & ~side[1:], ~side[:-1] & side[1:]
    return one if one.sum() >= other.sum() else other


def grammar(sequence: np.ndarray) -> list[Level]:
    """The levels over ``sequence``, whose last symbol must occur nowhere else. In the last level no symbol repeats."""
    s, levels = sequence.astype(np.int32), []
    s, distinct = _renumbered(s, np.zeros(len(s), np.int32))
    turn = 0
    while distinct < len(s):
        first = np.flatnonzero(np.diff(s, prepend=-1))
        if len(first) < len(s):
            levels.append(Level(s))
            levels[-1].group(first, pairs=False)
            s, distinct = _renumbered(s[first], np.diff(levels[-1].first))
        heads = np.append(_heads(s, turn), False)
        turn += 1
        if heads.any():
            levels.append(Level(s))
            first = np.flatnonzero(~np.concatenate(([False], heads[:-1])))
            levels[-1].group(first, pairs=True)
            paired = heads[first]
            second = np.zeros(len(first), np.int64)
            second[paired] = s[first[paired] + 1] + 1
            s, distinct = _renumbered(s[first], second)
    return [*levels, Level(s)]


def agreement(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each pair of different places, how many symbols agree from there on."""
    a, b = i.astype(np.int32), j.astype(np.int32)
    differ = np.full(len(a), len(levels) - 1)
    active = np.arange(len(a))
    for t, level in enumerate(levels[:-1]):
        x, y = a[active], b[active]
        px, py = level.up[x], level.up[y]
        off = np.flatnonzero((level.first[px] != x) | (level.first[py] != y))
        if len(off):  # to the next place where symbols of the next level begin, if both get there together
            xo, yo = x[off], y[off]
            rx, ry = level.first[px[off] + 1] - xo, level.first[py[off] + 1] - yo
            steps = np.where(level.symbols[xo] == level.symbols[yo], np.minimum(rx, ry), 0)
            x[off], y[off] = xo + steps, yo + steps
            stays = np.zeros(len(x), bool)
            stays[off] = (steps != rx) | (steps != ry)
            a[active[stays]], b[active[stays]], differ[active[stays]] = x[stays], y[stays], t
            active, x, y = active[~stays], x[~stays], y[~stays]
        a[active], b[active] = level.up[x], level.up[y]
        if not len(active):
            break
    order = np.argsort(-differ, kind="stable")
    reached = np.searchsorted(-differ[order], -np.arange(len(levels)), side="right")
    for t in range(len(levels) - 1, 0, -1):  # symbols differ at level t: down to where their expansions do
        level, asked = levels[t - 1], order[: reached[t]]
        if not len(asked):
            continue
        p, q = a[asked], b[asked]
        x, y = level.first[p], level.first[q]
        shared = 1 if level.pairs else np.minimum(level.first[p + 1] - x, level.first[q + 1] - y)
        steps = np.where(level.symbols[x] == level.symbols[y], shared, 0)
        a[asked], b[asked] = x + steps, y + steps
    return a - i.astype(np.int32)
