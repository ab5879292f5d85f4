"""Arm trajectories as a batch job: forward kinematics, errors, inverse kinematics.

A chain is a handful of joint rows, so it travels inside the task closure. All
clips of an Arrow batch are solved together, each at its own frame: a numpy call
works on every clip that is not at its end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectorized import to_dense
from .blocks import KEYS
from ..session import reliable
from .recurrence import FRAMES, Kernel, pack, scan, unpack
from .transfers import Latest
from .smoothing import JointFilter, joint_kernels

# Joints 1-6 of one arm and its tool offset (xyz in metres, rpy in
# radians, revolute about the local z axis, limits in radians).
ARM_JOINTS = [
    {"ord": 1, "joint": "joint1", "type": "revolute", "xyz": [0.0, 0.0, 0.123], "rpy": [0.0, 0.0, -1.5708]},
    {"ord": 2, "joint": "joint2", "type": "revolute", "xyz": [0.0, 0.0, 0.0], "rpy": [1.5708, -0.034907, -1.5708]},
    {"ord": 3, "joint": "joint3", "type": "revolute", "xyz": [0.28358, 0.028726, 0.0], "rpy": [0.0, 0.0, 0.06604341]},
    {"ord": 4, "joint": "joint4", "type": "revolute", "xyz": [-0.24221, 0.068514, 0.0], "rpy": [-1.5708, 0.0, 1.3826]},
    {"ord": 5, "joint": "joint5", "type": "revolute", "xyz": [0.0, 0.0, 0.0], "rpy": [1.5708, 0.0, 0.0]},
    {"ord": 6, "joint": "joint6", "type": "revolute", "xyz": [0.0, 0.091, 0.0014165], "rpy": [-1.5708, -1.5708, 0.0]},
    {"ord": 7, "joint": "tcp", "type": "fixed", "xyz": [0.0, 0.0, 0.12], "rpy": [0.0, 0.0, 0.0]},
]
LIMIT = 3.14159
CHUNK = 8192  # frames measured at a time


def rpy_matrix(rpy: Sequence[float]) -> np.ndarray:
    """Fixed-axis roll, pitch, yaw to 3x3."""
    (cr, cp, cy), (sr, sp, sy) = np.cos(rpy), np.sin(rpy)
    rx = np.array([[1, 0, 0], [0, cr, -sr], [0, sr, cr]])
    ry = np.array([[cp, 0, sp], [0, 1, 0], [-sp, 0, cp]])
    rz = np.array([[cy, -sy, 0], [sy, cy, 0], [0, 0, 1]])
    return rz @ ry @ rx


def rotvec_matrix(v: np.ndarray) -> np.ndarray:
    """Rotation vectors ``[N, 3]`` to matrices."""
    angle = np.linalg.norm(v, axis=1)
    safe = np.where(angle > 1e-12, angle, 1.0)
    k = np.zeros((len(v), 3, 3))
    x, y, z = (v / safe[:, None]).T
    k[:, 0, 1], k[:, 0, 2], k[:, 1, 2] = -z, y, -x
    k[:, 1, 0], k[:, 2, 0], k[:, 2, 1] = z, -y, x
    s, c = np.sin(angle)[:, None, None], np.cos(angle)[:, None, None]
    return np.eye(3) + s * k + (1.0 - c) * (k @ k)


def matrix_rotvec(r: np.ndarray) -> np.ndarray:
    """Rotation matrices ``[N, 3, 3]`` to rotation vectors with angle in [0, pi]."""
    diag = np.einsum("nii->ni", r)
    trace = diag.sum(axis=1)
    # Quaternion from its largest component, which stays exact at 0 and pi.
    q = np.empty((len(r), 4))
    pick = np.argmax(np.concatenate([diag, trace[:, None]], axis=1), axis=1)
    for i in range(3):
        rows = np.flatnonzero(pick == i)
        j, k = (i + 1) % 3, (i + 2) % 3
        m = r[rows]
        q[rows, i] = 1.0 - trace[rows] + 2.0 * m[:, i, i]
        q[rows, j] = m[:, j, i] + m[:, i, j]
        q[rows, k] = m[:, k, i] + m[:, i, k]
        q[rows, 3] = m[:, k, j] - m[:, j, k]
    rows = np.flatnonzero(pick == 3)
    m = r[rows]
    q[rows, 0], q[rows, 1] = m[:, 2, 1] - m[:, 1, 2], m[:, 0, 2] - m[:, 2, 0]
    q[rows, 2], q[rows, 3] = m[:, 1, 0] - m[:, 0, 1], 1.0 + trace[rows]
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    q *= np.where(q[:, 3:] < 0, -1.0, 1.0)
    s = np.linalg.norm(q[:, :3], axis=1)
    angle = 2.0 * np.arctan2(s, q[:, 3])
    scale = np.where(s > 1e-9, angle / np.where(s > 1e-9, s, 1.0), 2.0)
    return q[:, :3] * scale[:, None]


def se3_log(r: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Logarithm of rigid transforms: translation part, then rotation vector."""
    w = matrix_rotvec(r)
    angle = np.linalg.norm(w, axis=1)
    a2 = angle * angle
    small = angle < 1e-4
    safe = np.where(small, 1.0, angle)
    full = (1.0 - safe * np.sin(safe) / (2.0 * np.maximum(1.0 - np.cos(safe), 1e-300))) / (safe * safe)
    coef = np.where(small, 1.0 / 12.0 + a2 / 720.0, full)
    wt = np.cross(w, t)
    v = t - 0.5 * wt + coef[:, None] * np.cross(w, wt)
    return np.concatenate([v, w], axis=1)


@dataclass(frozen=True)
class Chain:
    """Joints from base to tool: rotation and offset before each, axis, limits."""

    rot: np.ndarray
    off: np.ndarray
    axis: np.ndarray
    moving: np.ndarray
    lower: np.ndarray
    upper: np.ndarray

    @staticmethod
    def of(rows: Iterable[Mapping]) -> Chain:
        rows = sorted(rows, key=lambda r: r["ord"])
        kinds = {r["type"] for r in rows}
        if not kinds <= {"revolute", "fixed"}:
            raise ValueError(f"joint types not supported: {sorted(kinds - {'revolute', 'fixed'})}")
        moving = [r for r in rows if r["type"] == "revolute"]
        if not moving:
            raise ValueError("a chain needs at least one moving joint")
        return Chain(
            np.array([rpy_matrix(r["rpy"]) for r in rows]),
            np.array([r["xyz"] for r in rows], dtype=float),
            np.array([r.get("axis") or [0.0, 0.0, 1.0] for r in rows], dtype=float),
            np.array([r["type"] == "revolute" for r in rows]),
            np.array([r.get("lower", -LIMIT) for r in moving], dtype=float),
            np.array([r.get("upper", LIMIT) for r in moving], dtype=float),
        )

    @staticmethod
    def from_table(chain: DataFrame, arm: str) -> Chain:
        """Read one arm from a chain table; a few joint rows reach the driver, a longer table is an error."""
        rows = [r.asDict() for r in chain.filter(F.col("arm") == arm).limit(257).collect()]
        if len(rows) > 256:
            raise ValueError("a kinematic chain has at most 256 joints")
        return Chain.of(rows)

    @property
    def dof(self) -> int:
        return len(self.lower)

    def clip(self, q: np.ndarray) -> np.ndarray:
        return np.clip(q, self.lower, self.upper)

    def turns(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rotation of joint i at angle a as ``A + sin(a) B + (1 - cos(a)) C``."""
        out = []
        for rot, (x, y, z) in zip(self.rot, self.axis):
            k = np.array([[0.0, -z, y], [z, 0.0, -x], [-y, x, 0.0]])
            out.append((rot, rot @ k, rot @ k @ k))
        return out

    def forward(self, q: np.ndarray, jacobian: bool = False):
        """Tool pose of joint vectors ``[N, dof]`` and, if asked, the Jacobian in the tool frame."""
        n = len(q)
        s, c = np.sin(q)[:, :, None, None], (1.0 - np.cos(q))[:, :, None, None]
        r, p = np.broadcast_to(np.eye(3), (n, 3, 3)), np.zeros((n, 3))
        axes, origins, j = [], [], 0
        for i, (a, b, d) in enumerate(self.turns()):
            p = p + r @ self.off[i]
            if self.moving[i]:
                r = r @ (a + s[:, j] * b + c[:, j] * d)
                if jacobian:
                    axes.append(r @ self.axis[i])  # turning about its axis leaves the axis in place
                    origins.append(p)
                j += 1
            else:
                r = r @ a
        if not jacobian:
            return r, p
        z = np.stack(axes, axis=1)
        lin = np.cross(z, p[:, None, :] - np.stack(origins, axis=1))
        back = r.transpose(0, 2, 1)
        jac = np.concatenate([back @ lin.transpose(0, 2, 1), back @ z.transpose(0, 2, 1)], axis=1)
        return r, p, jac

    def error(self, q: np.ndarray, rt: np.ndarray, pt: np.ndarray) -> np.ndarray:
        """Log of the remaining transform from the tool to the target."""
        r, p = self.forward(q)
        back = r.transpose(0, 2, 1)
        return se3_log(back @ rt, np.einsum("nij,nj->ni", back, pt - p))


@dataclass(frozen=True)
class Solver:
    """Settings of the trajectory solver."""

    position_weight: float = 8.0
    orientation_weight: float = 1.0
    continuity_weight: float = 0.05
    damping: float = 1e-4
    max_iterations: int = 96
    max_joint_step: float = 0.15
    max_frame_delta: float = 0.35
    position_tolerance: float = 0.01
    orientation_tolerance: float = 0.3
    early_position: float | None = 0.005
    early_orientation: float | None = 0.12
    smooth: bool = True
    joint_filter: JointFilter = JointFilter()

    def early(self) -> tuple[float, float]:
        p = self.position_tolerance if self.early_position is None else self.early_position
        o = self.orientation_tolerance if self.early_orientation is None else self.early_orientation
        return p, o


# The eight trial steps of the line search, in the order they are tried.
TRIALS = np.array([1.0, 0.5, 0.25, 0.125, -1.0, -0.5, -0.25, -0.125])


class Links:
    """A chain as turns about the local z axis with fixed links between them.

    Values lie component first (``[6, N]``), so that numpy works along the poses. Where the
    tool is, is found from its end: a point and a quaternion go through six turns and links.
    """

    def __init__(self, chain: Chain):
        rot, off = np.eye(3), np.zeros(3)
        links = []
        for r, o, axis, moving in zip(chain.rot, chain.off, chain.axis, chain.moving):
            off, rot = off + rot @ o, rot @ r
            if moving:
                to_z = _onto_z(axis)
                links.append((rot @ to_z, off))
                rot, off = to_z.T, np.zeros(3)
        self.links, self.tail, self.tail_quat = links, off[:, None], _quaternion(rot)[:, None]
        # a turn followed by a link is linear in the cosine and sine of the angle, or of half of it
        flat, about, up = np.diag([1.0, 1.0, 0.0]), np.array([[0.0, -1, 0], [1, 0, 0], [0, 0, 0]]), np.diag([0.0, 0, 1])
        half = np.array([[0.0, 0, 0, -1], [0, 0, -1, 0], [0, 1, 0, 0], [1, 0, 0, 0]])
        self.moves = [np.concatenate([a @ flat, a @ about, a @ up]) for a, _ in links]
        self.turns = []
        for a, _ in links:
            w, x, y, z = _quaternion(a)
            left = np.array([[w, -x, -y, -z], [x, w, -z, y], [y, z, w, -x], [z, -y, x, w]])
            self.turns.append(np.concatenate([left, left @ half]))

    def tool(self, s: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position ``[3, ...]`` and quaternion ``[4, ...]`` (w first) of the tool for sines and cosines of half angles ``[dof, ...]``."""
        shape = s.shape[1:]
        s, c = s.reshape(len(s), -1), c.reshape(len(c), -1)
        s1, c1 = 2.0 * s * c, 1.0 - 2.0 * s * s
        p, turn = self.tail, self.tail_quat
        for j in range(len(s) - 1, -1, -1):
            g = self.moves[j] @ p
            p = c1[j] * g[:3]
            p += s1[j] * g[3:6]
            p += g[6:] + self.links[j][1][:, None]
            g = self.turns[j] @ turn
            turn = c[j] * g[:4]
            turn += s[j] * g[4:]
        return p.reshape(3, *shape), turn.reshape(4, *shape)

    def axes(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Joint axes and origins in the base frame, each ``[3, dof, N]``."""
        s, c = np.sin(q), np.cos(q)
        n = q.shape[1]
        # the columns of the rotation so far; a turn about z mixes the first two
        x, y, z = (np.broadcast_to(e[:, None], (3, n)) for e in np.eye(3))
        o = np.zeros((3, n))
        axes, origins = np.empty((3, *q.shape)), np.empty((3, *q.shape))
        for j, (a, b) in enumerate(self.links):
            g = np.concatenate([a.T, b[None]]) @ np.stack([x, y, z], axis=1)
            x, y, z = g[:, 0], g[:, 1], g[:, 2]
            o = o + g[:, 3]
            axes[:, j], origins[:, j] = z, o
            x, y = c[j] * x + s[j] * y, c[j] * y - s[j] * x
        return axes, origins

    def remaining(self, s: np.ndarray, c: np.ndarray, target: np.ndarray):
        """What is left to a target ``[7, ...]``: offset and quaternion in the base frame, position and orientation error."""
        gap, tool = self.tool(s, c)
        np.subtract(target[4:], gap, out=gap)
        # target times the inverse of the tool
        turn = np.empty_like(tool)
        turn[0] = (target[:4] * tool).sum(axis=0)
        turn[1:] = target[1:4] * tool[0] - target[0] * tool[1:] - _cross(target[1:4], tool[1:])
        n = np.sqrt((turn[1:] * turn[1:]).sum(axis=0))
        half = np.arctan2(n, np.abs(turn[0]))
        # the logarithm keeps the part of the offset along the axis and stretches the rest
        some = n > 1e-9
        safe = np.where(some, n, 1.0)
        grow = np.where(some, half / safe, 1.0) ** 2
        along = (turn[1:] * gap).sum(axis=0) / safe
        pe2 = grow * (gap * gap).sum(axis=0) + (1.0 - grow) * along * along
        return gap, turn, np.sqrt(np.maximum(pe2, 0.0)), 2.0 * half


def _onto_z(axis: np.ndarray) -> np.ndarray:
    """A rotation whose third column is the axis."""
    z = axis / np.linalg.norm(axis)
    if z[2] == 1.0:
        return np.eye(3)
    x = np.cross([0.0, 1.0, 0.0] if abs(z[1]) < 0.9 else [1.0, 0.0, 0.0], z)
    x /= np.linalg.norm(x)
    return np.stack([x, np.cross(z, x), z], axis=1)


def _quaternion(r: np.ndarray) -> np.ndarray:
    """Unit quaternion of a matrix, w first."""
    return target_of(np.concatenate([np.zeros(3), matrix_rotvec(r[None])[0]]))[:4]


def target_of(pose: np.ndarray) -> np.ndarray:
    """Poses ``[..., 6]`` as ``[7, ...]``: quaternion, then position."""
    half = 0.5 * np.sqrt((pose[..., 3:] ** 2).sum(axis=-1))
    turn = pose[..., 3:] * (0.5 * np.sinc(half / np.pi))[..., None]
    return np.concatenate([np.cos(half)[None], np.moveaxis(turn, -1, 0), np.moveaxis(pose[..., :3], -1, 0)])


def _cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a[1] * b[2] - a[2] * b[1]
    out = np.empty((3, *x.shape))
    out[0] = x
    out[1] = a[2] * b[0] - a[0] * b[2]
    out[2] = a[0] * b[1] - a[1] * b[0]
    return out


def _left(gap: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithm of the remaining transform in the base frame: translation and rotation part."""
    sign = np.where(turn[0] < 0, -1.0, 1.0)
    n = np.sqrt((turn[1:] ** 2).sum(axis=0))
    half = np.arctan2(n, np.abs(turn[0]))
    some = n > 1e-9
    safe = np.where(some, n, 1.0)
    w = turn[1:] * (sign * np.where(some, 2.0 * half / safe, 2.0))
    a2 = 4.0 * half * half
    small = a2 < 1e-8
    coef = np.where(small, 1.0 / 12.0 + a2 / 720.0, (1.0 - half * np.abs(turn[0]) / safe) / np.where(small, 1.0, a2))
    wg = _cross(w, gap)
    return gap - 0.5 * wg + coef * _cross(w, wg), w


def _solved(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Solutions of many small positive definite systems ``[d, d, N]``, ``[d, N]``; both are overwritten."""
    d = len(g)
    for j in range(d - 1):
        part = h[j + 1 :, j] / h[j, j]
        h[j + 1 :, j + 1 :] -= part[:, None] * h[j, None, j + 1 :]
        g[j + 1 :] -= part * g[j]
    for j in range(d - 1, -1, -1):
        g[j] /= h[j, j]
        g[:j] -= h[:j, j] * g[j]
    return g


def _trial_turns(q: np.ndarray, step: np.ndarray, sin: np.ndarray, cos: np.ndarray) -> None:
    """Sines and cosines of half the angles ``[dof, 8, N]`` of all trial steps, from those of the smallest one."""
    s0, c0 = np.sin(0.5 * q), np.cos(0.5 * q)
    least = 0.5 * TRIALS[3] * step
    s, c = np.sin(least), np.cos(least)
    for k in (3, 2, 1, 0):  # twice the step each time
        a, b, x, y = s0 * c, c0 * s, c0 * c, s0 * s
        np.add(a, b, out=sin[:, k])
        np.subtract(x, y, out=cos[:, k])
        np.subtract(a, b, out=sin[:, k + 4])
        np.add(x, y, out=cos[:, k + 4])
        s, c = 2.0 * s * c, 1.0 - 2.0 * s * s


def search(chain: Chain, cfg: Solver, lanes: int, ask: Callable, tell: Callable) -> int:
    """Damped least squares along many lanes, each from one target to its next at its own pace.

    ``ask(idle)`` names those of the idle lanes that have another target, and gives the
    targets ``[7, N]``, seeds and previous joints ``[dof, N]``. ``tell(lanes, joints,
    position error, orientation error)`` takes what was found. No lane waits for another, so
    the number of rounds, which is returned, is that of the slowest lane, not the sum of the
    slowest frames. Seeds of new targets are measured along with the trial steps of the others.
    """
    dof, links, tries = chain.dof, Links(chain), len(TRIALS)
    early_p, early_o = cfg.early()
    lower, upper = chain.lower[:, None, None], chain.upper[:, None, None]
    wp, wo, wc = cfg.position_weight, cfg.orientation_weight, cfg.continuity_weight
    target, prev, cur, best = np.zeros((7, lanes)), *(np.zeros((dof, lanes)) for _ in range(3))
    # of the joints: offset and quaternion left, errors and cost; of the best: errors and cost
    gap, turn, score, top = np.zeros((3, lanes)), np.zeros((4, lanes)), np.zeros((3, lanes)), np.zeros((3, lanes))
    rounds, stuck = np.zeros(lanes, int), np.zeros(lanes, bool)
    live = new = np.arange(0)
    idle, total = np.arange(lanes), 0
    while True:
        new = new[:0]
        if len(idle):
            new, target_new, seed, prev_new = ask(idle)
            target[:, new], cur[:, new], best[:, new], prev[:, new] = target_new, seed, seed, prev_new
            rounds[new], stuck[new] = 0, False
        if not len(live) and not len(new):
            return total
        total += 1
        n = len(live)
        trial, sin, cos = (np.empty((dof, n * tries + len(new))) for _ in range(3))
        q, was, aim = (x.take(live, axis=1) for x in (cur, prev, target))
        if n:
            axes, origins = links.axes(q)
            here = gap.take(live, axis=1)
            v, w = _left(here, turn.take(live, axis=1))
            lin = _cross(axes, (aim[4:] - here)[:, None] - origins)
            grad = wp * (lin * v[:, None]).sum(axis=0) + wo * (axes * w[:, None]).sum(axis=0) + wc * (was - q)
            both = np.concatenate([lin * np.sqrt(wp), axes * np.sqrt(wo)])
            h = np.einsum("ijn,ikn->jkn", both, both)
            h[np.arange(dof), np.arange(dof)] += cfg.damping + wc
            step = np.clip(_solved(h, grad), -cfg.max_joint_step, cfg.max_joint_step)
            to, to_sin, to_cos = (x[:, : n * tries].reshape(dof, tries, n) for x in (trial, sin, cos))
            np.add(q[:, None], TRIALS[:, None] * step[:, None], out=to)
            _trial_turns(q, step, to_sin, to_cos)
            cut = (to < lower) | (to > upper)
            if cut.any():
                np.clip(to, lower, upper, out=to)
                to_sin[cut], to_cos[cut] = np.sin(0.5 * to[cut]), np.cos(0.5 * to[cut])
        if len(new):
            trial[:, n * tries :] = seed
            sin[:, n * tries :], cos[:, n * tries :] = np.sin(0.5 * seed), np.cos(0.5 * seed)
        aims, were = (np.concatenate([np.tile(x, tries), y[:, new]], axis=1) for x, y in ((aim, target), (was, prev)))
        left, left_turn, pe, oe = links.remaining(sin, cos, aims)
        cost = wp * pe * pe + wo * oe * oe + wc * ((trial - were) ** 2).sum(axis=0)
        marks = np.stack([pe, oe, cost])

        costs = cost[: n * tries].reshape(tries, n)
        least, pick = score[2, live], np.full(n, -1)
        for k in range(tries):
            better = costs[k] + 1e-12 < least
            least, pick = np.where(better, costs[k], least), np.where(better, k, pick)
        went = np.flatnonzero(pick >= 0)
        rows, at = live[went], pick[went] * n + went
        rounds[live] += 1
        stuck[live] = True
        stuck[rows] = (np.abs(trial[:, at] - q[:, went]) <= 1e-10).all(axis=0)
        rows, at = np.concatenate([rows, new]), np.concatenate([at, np.arange(n * tries, trial.shape[1])])
        cur[:, rows], gap[:, rows], turn[:, rows], score[:, rows] = trial[:, at], left[:, at], left_turn[:, at], marks[:, at]
        top[:, new] = score[:, new]
        gain = rows[score[2, rows] + 1e-12 < top[2, rows]]
        best[:, gain], top[:, gain] = cur[:, gain], score[:, gain]

        live = np.concatenate([live, new])
        now = score[:, live]
        done = ((now[0] <= early_p) & (now[1] <= early_o)) | stuck[live] | (rounds[live] >= cfg.max_iterations)
        idle, live = live[done], live[~done]
        if len(idle):
            tell(idle, best[:, idle], top[0, idle], top[1, idle])


def _reached(cfg: Solver, pe, oe):
    return (pe <= cfg.position_tolerance) & (oe <= cfg.orientation_tolerance)


def _lengths(active: np.ndarray, lanes: int) -> np.ndarray:
    """Frames of each lane."""
    return (active[:, None] > np.arange(lanes)[None, :]).sum(axis=0)


def _next_true(flags: np.ndarray) -> np.ndarray:
    """For every frame and lane the first frame from there on that is marked; one row more, for the end."""
    steps, lanes = flags.shape
    at = np.full((steps + 1, lanes), steps)
    at[:steps] = np.where(flags, np.arange(steps)[:, None], steps)
    return np.minimum.accumulate(at[::-1], axis=0)[::-1]


def _last_true(flags: np.ndarray) -> np.ndarray:
    """For every frame and lane the last frame up to there that is marked, or -1."""
    return np.maximum.accumulate(np.where(flags, np.arange(len(flags))[:, None], -1), axis=0)


def track_kernel(chain: Chain, cfg: Solver, pose: str, initial: Sequence[float] | None) -> Kernel:
    """Warm-started solution frame by frame; an invalid frame repeats the joints."""
    dof = chain.dof
    home = chain.clip(np.zeros(dof) if initial is None else np.asarray(initial, dtype=float))
    low, high = chain.lower[:, None], chain.upper[:, None]

    def step(x, _, active, state):
        poses = x[pose]
        steps, lanes = poses.shape[:2]
        inside = np.arange(steps)[:, None] < _lengths(active, lanes)
        ok = np.isfinite(poses).all(axis=2) & inside
        coming, target = _next_true(ok), target_of(np.where(ok[..., None], poses, 0.0))
        start = np.where(np.isnan(state), home, state)
        cur, at = start.T.copy(), np.zeros(lanes, int)
        joints, errs = np.full((steps, lanes, dof), np.nan), np.full((steps, lanes, 2), np.nan)

        def ask(idle):
            at[idle] = coming[at[idle], idle]
            new = idle[at[idle] < steps]
            return new, target[:, at[new], new], cur[:, new], cur[:, new]

        def tell(done, q, pe, oe):
            t = at[done]
            if cfg.max_frame_delta > 0:
                was = cur[:, done]
                q = np.clip(was + np.clip(q - was, -cfg.max_frame_delta, cfg.max_frame_delta), low, high)
            cur[:, done] = q
            joints[t, done] = q.T
            errs[t, done, 0], errs[t, done, 1] = pe, oe
            at[done] += 1

        search(chain, cfg, lanes, ask, tell)
        if cfg.max_frame_delta > 0:
            links = Links(chain)
            rows = np.flatnonzero(ok.reshape(-1))
            flat, flat_t, flat_e = joints.reshape(-1, dof), target.reshape(7, -1), errs.reshape(-1, 2)
            for part in np.array_split(rows, len(rows) // CHUNK + 1):
                half = 0.5 * flat[part].T
                _, _, flat_e[part, 0], flat_e[part, 1] = links.remaining(np.sin(half), np.cos(half), flat_t[:, part])
        seen = _last_true(ok)
        filled = np.take_along_axis(joints, np.maximum(seen, 0)[..., None], axis=0)
        joints = np.where((seen >= 0)[..., None], filled, start)
        return {"_q": np.where(inside[..., None], joints, np.nan), "_e": errs}, cur.T.copy()

    return Kernel(step, {"_q": dof, "_e": 2}, dof)


def next_reached_kernel(cfg: Solver, dof: int) -> Kernel:
    """Frame number and joints of the next reachable frame, seen from every frame."""

    def step(x, _, active, state):
        q, e, f = x["_q"], x["_e"], x["frame_index"]
        out = np.full((*q.shape[:2], dof + 1), np.nan)
        cur = state.copy()
        for t in range(len(active) - 1, -1, -1):
            m = active[t]
            hit = _reached(cfg, e[t, :m, 0], e[t, :m, 1])
            here = np.concatenate([f[t, :m], q[t, :m]], axis=1)
            cur[:m] = np.where(hit[:, None], here, cur[:m])
            out[t, :m] = cur[:m]
        return {"_next": out}, cur

    return Kernel(step, {"_next": dof + 1}, dof + 1, True, Latest(dof + 1), ("_q", "_e"))


def retry_kernel(chain: Chain, cfg: Solver, pose: str) -> Kernel:
    """Solve unreachable frames again from the nearest reachable one.

    In frame order: the pool behind a frame holds frames that were reachable or
    became so, the pool ahead those reachable from the start.
    """
    dof = chain.dof
    low, high = chain.lower[:, None], chain.upper[:, None]

    def step(x, _, active, state):
        poses, q, e, f, ahead = x[pose], x["_q"].copy(), x["_e"].copy(), x["frame_index"][..., 0], x["_next"]
        steps, lanes = poses.shape[:2]
        inside = np.arange(steps)[:, None] < _lengths(active, lanes)
        hit = _reached(cfg, e[..., 0], e[..., 1]) & inside
        ok = np.isfinite(poses).all(axis=2) & inside
        coming, target = _next_true(ok & ~hit), target_of(np.where(ok[..., None], poses, 0.0))
        behind, again, at = _last_true(hit), np.full(lanes, -1), np.zeros(lanes, int)

        def pool(t, lane):
            """Frame number and joints of the last reachable frame before ``t``."""
            b = np.maximum(np.where(t > 0, behind[np.maximum(t - 1, 0), lane], -1), again[lane])
            here = np.concatenate([f[b, lane][:, None], q[b, lane]], axis=1)
            return np.where((b >= 0)[:, None], here, state[lane])

        def ask(idle):
            at[idle] = coming[at[idle], idle]
            new = idle[at[idle] < steps]
            t = at[new]
            back, then = pool(t, new), ahead[t, new]
            back_d, next_d = f[t, new] - back[:, 0], then[:, 0] - f[t, new]
            use_back = np.isfinite(back_d) & ~(next_d < back_d)
            near = np.where(use_back[:, None], back[:, 1:], then[:, 1:])
            # without one on either side there is none for the frames to come either
            some = np.isfinite(near).all(axis=1)
            new, t, near = new[some], t[some], near[some].T
            return new, target[:, t, new], np.clip(near, low, high), near

        def tell(done, found, pe, oe):
            t = at[done]
            old_p, old_o = e[t, done, 0], e[t, done, 1]
            better = ~np.isfinite(old_p) | (pe < old_p - 1e-9) | ~np.isfinite(old_o) | (oe < old_o - 1e-9)
            rows, lane = t[better], done[better]
            q[rows, lane], e[rows, lane, 0], e[rows, lane, 1] = found.T[better], pe[better], oe[better]
            now = _reached(cfg, e[t, done, 0], e[t, done, 1])
            again[done[now]] = t[now]
            at[done] += 1

        search(chain, cfg, lanes, ask, tell)
        return {"_q2": q, "_e2": e}, pool(np.full(lanes, steps), np.arange(lanes))

    return Kernel(step, {"_q2": dof, "_e2": 2}, dof + 1)


def measure_kernel(chain: Chain, pose: str, joints: str, clip: bool = True) -> Kernel:
    """Final joints and the errors they leave; an invalid target has none."""
    dof = chain.dof

    def step(x, _, active, state):
        poses, q = x[pose], x[joints]
        q = chain.clip(q) if clip else q
        errs = np.full((*q.shape[:2], 2), np.nan)
        flat_p, flat_q = poses.reshape(-1, poses.shape[2]), q.reshape(-1, dof)
        ok = np.flatnonzero(np.isfinite(flat_p).all(axis=1) & np.isfinite(flat_q).all(axis=1))
        flat = errs.reshape(-1, 2)
        for part in np.array_split(ok, len(ok) // CHUNK + 1):
            target = flat_p[part]
            err = chain.error(flat_q[part], rotvec_matrix(target[:, 3:6]), target[:, :3])
            flat[part, 0] = np.linalg.norm(err[:, :3], axis=1)
            flat[part, 1] = np.linalg.norm(err[:, 3:], axis=1)
        return {"_joints": q, "_errors": errs}, np.zeros((q.shape[1], 1))

    return Kernel(step, {"_joints": dof, "_errors": 2}, 1, transfer=Latest(1), uses=(pose, joints))


def _with_errors(df: DataFrame, cfg: Solver, prefix: str) -> DataFrame:
    pe, oe = F.col("_errors")[0], F.col("_errors")[1]
    hit = (pe <= cfg.position_tolerance) & (oe <= cfg.orientation_tolerance)
    return df.withColumns(
        {
            f"{prefix}position_error": pe,
            f"{prefix}orientation_error": oe,
            f"{prefix}reachable": F.coalesce(hit, F.lit(False)),
        }
    ).drop("_errors")


def fk_errors(
    df: DataFrame, chain: Chain, pose: str, joints: str, cfg: Solver = Solver(), prefix: str = ""
) -> DataFrame:
    """Errors of given joints against target poses: a narrow map without any shuffle."""
    schema = T.StructType(list(df.schema.fields)).add("_errors", T.ArrayType(T.DoubleType()))
    kernel = measure_kernel(chain, pose, joints)
    names, dof = df.columns, chain.dof

    def apply(batches):
        for b in batches:
            x = {
                pose: to_dense(b.column(names.index(pose)), 6)[:, None, :],
                joints: to_dense(b.column(names.index(joints)), dof)[:, None, :],
            }
            with np.errstate(all="ignore"):
                made, _ = kernel.step(x, {}, np.array([1]), np.zeros((1, 1)))
            errs = made["_errors"].reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * 2, pa.int32()), pa.array(errs))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], names=schema.names)

    done = df.mapInArrow(apply, schema)
    clean = F.when(~F.isnan(F.col("_errors")[0]), F.col("_errors"))
    return _with_errors(done.withColumn("_errors", clean), cfg, prefix)


def solve_ik(
    df: DataFrame,
    chain: Chain,
    pose: str = "pose",
    cfg: Solver = Solver(),
    initial: Sequence[float] | None = None,
    out: str = "joint_position",
    prefix: str = "",
    keys: Sequence[str] = KEYS,
    block: int = FRAMES,
) -> DataFrame:
    """Joint trajectory of each clip: warm-started solve, retry, smoothing, final errors.

    Adds the joints and, from the smoothed joints, both errors and reachability.
    """
    dof = chain.dof
    kernels = [track_kernel(chain, cfg, pose, initial), next_reached_kernel(cfg, dof), retry_kernel(chain, cfg, pose)]
    final = "_q2"
    if cfg.smooth:
        kernels += joint_kernels("_q2", "_smoothed", dof, cfg.joint_filter)
        final = "_smoothed"
    # a lone frame needs no smoothing; the filter returns it unchanged
    kernels.append(measure_kernel(chain, pose, final, clip=cfg.smooth))
    emit = {"_joints": dof, "_errors": 2}
    # the solver has no transfer: its rounds read the poses often, so they are written once
    p = pack(reliable(df), {pose: 6, "frame_index": 1}, keys, block)
    solved = unpack(scan(p, kernels, emit), p, emit, {"_joints": out})
    return _with_errors(solved, cfg, prefix)

