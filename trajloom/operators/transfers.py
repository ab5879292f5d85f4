"""How the state behind a block of frames follows from the state before it.

A transfer is made from the frames of a block alone, as a short row of numbers, and applied
to the incoming state once that is known. A missing state (NaN) stands for the start of a
clip. Each is exact for its kind of recurrence; only the rounding of an affine map differs
from that of the steps it stands for.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Sequence

import numpy as np

Arrays = dict[str, np.ndarray]
#: Outgoing states ``[L, S]`` of all lanes for incoming ones.
Run = Callable[[np.ndarray], np.ndarray]


class Transfer(ABC):
    """State after a block as a function of the state before it."""

    @abstractmethod
    def make(self, run: Run, x: Arrays, const: Arrays, active: np.ndarray) -> Sequence[np.ndarray]:
        """One row of numbers for each lane."""

    @abstractmethod
    def apply(self, row: np.ndarray, state: np.ndarray) -> np.ndarray:
        """The state behind the block."""


def _counts(active: np.ndarray, lanes: int) -> np.ndarray:
    """Frames of each lane."""
    return (active[:, None] > np.arange(lanes)[None, :]).sum(axis=0)


class Latest(Transfer):
    """A state that the block replaces as a whole, or leaves where it has nothing to replace it with."""

    def __init__(self, size: int):
        self.size = size

    def make(self, run, x, const, active):
        return run(np.full((active[0], self.size), np.nan))

    def apply(self, row, state):
        return state if np.isnan(row).any() else row


class Affine(Transfer):
    """A state that goes through an affine map whose matrix couples few components.

    ``coupled[j][i]`` names the component of the incoming state that the j-th unit probe
    stands for where component i is concerned; the probe sets all of those to one at once,
    as components that do not touch each other can be probed together. ``fixed`` gives the
    part of the incoming state that is known beforehand, zero elsewhere.
    """

    def __init__(self, size: int, coupled: Sequence[Sequence[int]], fixed: Callable[[np.ndarray], np.ndarray] | None = None):
        self.size, self.coupled, self.fixed = size, [np.array(c) for c in coupled], fixed

    def make(self, run, x, const, active):
        lanes = active[0]
        base = self.fixed(const["_start"][:, 0]) if self.fixed else np.zeros((lanes, self.size))
        out = [run(np.full((lanes, self.size), np.nan)), run(base)]
        for own in self.coupled:
            probe = base.copy()
            probe[:, np.unique(own[own >= 0])] = 1.0
            out.append(run(probe))
        return np.concatenate(out, axis=1)

    def apply(self, row, state):
        start, base, *units = row.reshape(-1, self.size)
        if np.isnan(state).any():
            return start
        out = base.copy()
        for own, unit in zip(self.coupled, units):
            out += np.where(own >= 0, unit - base, 0.0) * state[np.maximum(own, 0)]
        return out


def per_axis(axes: int, more: int = 0) -> list[list[int]]:
    """Couplings of ``axes`` positions and velocities, each axis by itself; ``more`` components are fixed."""
    none = [-1] * more
    return [[*range(axes), *range(axes), *none], [*range(axes, 2 * axes), *range(axes, 2 * axes), *none]]


class Choices(Transfer):
    """A vector that follows another as the nearest of its equivalents, frame by frame.

    All that the state before a block decides is which equivalent its first valid vector
    takes. The row holds that vector and the outgoing state for each choice: a table, which
    the nearest choice for the incoming state looks up. ``valid`` tells the lanes and frames
    with a vector, ``options`` lists the equivalents of a vector, itself first.
    """

    def __init__(self, at: Callable[[Arrays], tuple[np.ndarray, np.ndarray]], options: Callable[[np.ndarray], np.ndarray]):
        self.at, self.options = at, options

    def make(self, run, x, const, active):
        values, valid = self.at(x)
        lanes = values.shape[1]
        valid = valid & (np.arange(len(values))[:, None] < _counts(active, lanes)[None, :])
        first = values[valid.argmax(axis=0), np.arange(lanes)]
        first = np.where(valid.any(axis=0)[:, None], first, np.nan)
        options = self.options(first)
        return np.concatenate([first, *[run(options[:, c]) for c in range(options.shape[1])]], axis=1)

    def apply(self, row, state):
        first, *table = row.reshape(-1, 3)
        if np.isnan(first).any():
            return state
        if np.isnan(state).any():
            return table[0]
        return table[nearest(self.options(first[None])[0], state)]


def nearest(options: np.ndarray, to: np.ndarray) -> int:
    """The first of the nearest options."""
    return int(np.argmin(np.linalg.norm(options - to, axis=1)))


class Clamps(Transfer):
    """Values that move towards a target by at most ``limit`` a frame, each component by itself.

    A frame is the map y -> min(max(x, y - limit), y + limit). A composition of such maps
    is monotone and made of flat pieces and pieces of slope one, so it is told by the ends of
    its flat pieces: knots y with their values. A frame only adds knots where the value
    crosses its window, and those inside the window fall together. The row holds the state
    from the start of a clip, then for each component the number of knots, the knots and
    their values.
    """

    def __init__(self, size: int, limit: float, values: Callable[[Arrays], np.ndarray]):
        self.size, self.limit, self.values = size, float(limit), values

    def make(self, run, x, const, active):
        lanes, targets = active[0], self.values(x)
        start, n = run(np.full((lanes, self.size), np.nan)), _counts(active, lanes)
        out = []
        for lane in range(lanes):
            row = [start[lane]]
            for c in range(self.size):
                own = targets[: n[lane], lane, c]
                knots, values = clamp_map(own[~np.isnan(own)], self.limit)
                row += [[len(knots)], knots, values]
            out.append(np.concatenate(row))
        return out

    def apply(self, row, state):
        out, at = np.empty(self.size), self.size
        for c in range(self.size):
            n = int(row[at])
            knots, values = row[at + 1 : at + 1 + n], row[at + 1 + n : at + 1 + 2 * n]
            at += 1 + 2 * n
            out[c] = row[c] if np.isnan(state[c]) else clamp_value(knots, values, state[c])
        return out


def clamp_map(targets: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Knots and values of the composed map of all targets in order; of slope one outside its knots."""
    knots, values = np.zeros(0), np.zeros(0)  # the identity
    for x in targets.tolist():
        low, high = x - limit, x + limit
        if not len(knots):
            knots, values = np.array([low, high]), np.array([x, x])
            continue
        lo, hi = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
        edges = [_reach(knots, values, low, False), _reach(knots, values, high, True)]
        knots = np.concatenate([knots[:lo], edges, knots[hi:]])
        values = np.concatenate([values[:lo] + limit, [x, x], values[hi:] - limit])
    return knots, values


def _reach(knots: np.ndarray, values: np.ndarray, wanted: float, last: bool) -> float:
    """The first (or last) y where the map takes a value."""
    if last:
        i = int(np.searchsorted(values, wanted, "right")) - 1  # behind it the map rises with slope one
        return knots[i] + (wanted - values[i]) if i >= 0 else knots[0] - (values[0] - wanted)
    i = int(np.searchsorted(values, wanted, "left"))
    return knots[i] - (values[i] - wanted) if i < len(knots) else knots[-1] + (wanted - values[-1])


def clamp_value(knots: np.ndarray, values: np.ndarray, y: float) -> float:
    """The map at ``y``."""
    if not len(knots):
        return y
    if y <= knots[0]:
        return values[0] - (knots[0] - y)
    if y >= knots[-1]:
        return values[-1] + (y - knots[-1])
    i = int(np.searchsorted(knots, y, "right")) - 1
    return min(values[i] + (y - knots[i]), values[i + 1]) if values[i + 1] > values[i] else values[i]


class FirstTwo(Transfer):
    """The first two valid rows (frame number, values) from a block on, of a recurrence that runs backwards."""

    def __init__(self, width: int):
        self.width = width

    def make(self, run, x, const, active):
        return run(np.full((active[0], 2 * self.width), np.nan))

    def apply(self, row, state):
        return first_two(row[None], state[None])[0]


def first_two(own: np.ndarray, later: np.ndarray) -> np.ndarray:
    """The first two of own and later rows ``[n, 2 * width]``, NaN where there are fewer."""
    w = own.shape[1] // 2
    none, one = np.isnan(own[:, :1]), np.isnan(own[:, w : w + 1])
    rest = np.concatenate([own[:, :w], later[:, :w]], axis=1)
    return np.where(none, later, np.where(one, rest, own))
