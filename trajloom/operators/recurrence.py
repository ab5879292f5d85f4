"""State-carried recurrences over the frames of a clip.

Some smoothers carry a state from frame to frame, which no window function
expresses. A clip's frames are packed into one row per bounded block. Python sees
Arrow batches of many blocks and steps through time once for all of them, so the
inner loop is vectorised over clips.

A clip that fits a block runs all its recurrences in one pass. The blocks of a longer
one run in parallel: a block returns its *transfer*, a small description of the state
it ends in as a function of the state it starts in, transfers are applied along the
clip on rows of that size, and the states they give go back to the blocks. How a
transfer looks depends on the recurrence (:mod:`transfers`): affine maps, tables of
choices, monotone piecewise linear maps, last values. It is exact, so one round over
the blocks settles a recurrence, and recurrences that do not read each other share it.

Where a step depends on its state in no such form, the blocks run from a guess, then from
what their predecessors ended in. Where that moved the state, the clip's blocks pass one
task in order, which steps through the frames of all blocks behind the first moved one.

Everything is one lazy plan: nothing is probed, written or counted while it is built. All
rounds read the shuffle of the one pass, and a guard of at most one row lets Spark drop
them at run time where no clip is long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import KEYS, spread_blocks
from .transfers import Transfer

FRAMES = 16384  # nine minutes at 30 frames per second
LANES = 4096
CELLS = 1 << 19  # frames a task holds as dense arrays at a time
TOL = 1e-12  # guessed states this near to the true ones lead to the same states but for rounding

Arrays = dict[str, np.ndarray]


@dataclass
class Kernel:
    """One recurrence.

    ``step`` gets time-major arrays ``[T, L, dim]``, the per-lane constants
    ``[L, dim]``, the number of active lanes per time step (lanes are sorted by
    length, so they are a prefix) and the incoming state ``[L, state]`` (NaN where
    a clip starts). It returns the outputs and the outgoing state.

    ``uses`` names the outputs of earlier kernels that it needs, if not all of them;
    ``reads`` those that its outgoing state depends on. ``transfer`` describes how that
    follows from the incoming state; None stands for a guess and a second run.
    """

    step: Callable[[Arrays, Arrays, np.ndarray, np.ndarray], tuple[Arrays, np.ndarray]]
    outputs: dict[str, int]
    state: int
    reverse: bool = False
    transfer: Transfer | None = None
    uses: tuple[str, ...] | None = None
    reads: tuple[str, ...] | None = None


@dataclass
class Packed:
    """A packed frame table: one row per (clip, block); ``guard`` has a row if a clip fills a block."""

    df: DataFrame
    keys: tuple[str, ...]
    dims: dict[str, int]
    rest: list[str]
    guard: DataFrame
    block: int
    consts: dict[str, int] = field(default_factory=dict)


def _flat(name: str, dim: int, n: Column) -> Column:
    """One flat array of a block's values; a missing value becomes NaN for numpy."""
    values = F.col("_rows")[name]
    if dim == 1:
        return F.transform(values, lambda v: F.coalesce(v.cast("double"), F.lit(float("nan"))))
    hole = F.array_repeat(F.lit(float("nan")), dim)
    return F.flatten(
        F.transform(values, lambda v: F.when(F.size(v) == dim, v.cast("array<double>")).otherwise(hole))
    )


def pack(
    df: DataFrame, inputs: dict[str, int], keys: Sequence[str] = KEYS, block: int = FRAMES, carry: bool = True
) -> Packed:
    """Group frames into blocks: the input columns as flat arrays, other columns carried along.

    Frames of a clip are numbered from 0 without gaps.
    """
    keys = tuple(keys)
    rest = [c for c in df.columns if c not in keys and c != "frame_index"] if carry else []
    wanted = ["frame_index", *rest, *[c for c in inputs if c not in rest and c != "frame_index"]]
    # The kernels cost far more per byte than a shuffle read: keep the session's number of
    # tasks instead of letting it be merged down by size.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = (
        spread_blocks(df, keys, block, parts)
        .groupBy(*keys, "_block")
        .agg(F.sort_array(F.collect_list(F.struct(*wanted))).alias("_rows"))
    )
    n = F.size("_rows")
    cols = {f"_x_{c}": _flat(c, d, n) for c, d in inputs.items()}
    carried = F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in rest])) if rest else None
    out = grouped.select(
        *keys,
        "_block",
        F.col("_rows")["frame_index"].alias("_frames"),
        *([carried.alias("_rest")] if rest else []),
        *[v.alias(k) for k, v in cols.items()],
    )
    one = (F.pmod(F.xxhash64("frame_index"), F.lit(1)) + 1).cast("int")  # 1, which no optimiser folds into a task of its own
    guard = df.filter(F.col("frame_index") >= block - 1).select(one.alias("_long")).distinct()
    return Packed(out, keys, dict(inputs), rest, guard, block)


def _fills(block: int) -> Column:
    """Does the packed row belong to a clip that fills a block? Frames have no gaps, so its last frame tells."""
    return F.element_at("_frames", -1) >= block - 1


def _values(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat, np.concatenate([[0], np.cumsum(lengths)])


def _table(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of ``dim`` values each; a missing row is NaN."""
    flat, off = _values(col)
    out = np.full((len(col), dim), np.nan)
    whole = np.diff(off) == dim
    if whole.any():
        out[whole] = flat.reshape(-1, dim)
    return out


def _lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.float64()))


class Lanes:
    """Kernels over the blocks of an Arrow batch.

    ``use`` are the kernels that run, each from the state in its column ``_s_<k>`` (the
    start of a clip where there is none); ``ends`` those whose outgoing state is returned,
    ``maps`` those whose transfer is.
    """

    def __init__(self, p: Packed, kernels: Sequence[Kernel], use: Sequence[int], ends: Sequence[int] = (), maps: Sequence[int] = (), many: bool = False):
        self.dims = dict(p.dims) | {o: d for k in kernels for o, d in k.outputs.items()}
        self.inputs, self.consts, self.kernels = list(p.dims), dict(p.consts), list(kernels)
        self.use, self.ends, self.maps, self.many = set(use), set(ends), set(maps), many

    def columns(self, p: Packed) -> list[str]:
        given = [f"_s_{k}" for k in sorted(self.use) if f"_s_{k}" in p.df.columns]
        return ["_frames", *[f"_x_{c}" for c in p.dims], *[f"_c_{c}" for c in p.consts], *given]

    def __call__(self, batch: pa.RecordBatch, emit: Sequence[str], states: dict[int, np.ndarray] | None = None):
        """Outputs as (flat values per frame), row starts, end states and transfers of the rows."""
        rows = batch.num_rows
        get = lambda c: batch.column(batch.schema.get_field_index(c))
        n = pc.list_value_length(get("_frames")).to_numpy(zero_copy_only=False).astype(np.int64)
        start = np.concatenate([[0], np.cumsum(n)])
        cols = {c: _values(get(f"_x_{c}")) for c in self.inputs}
        const = {c: _table(get(f"_c_{c}"), d) for c, d in self.consts.items()}
        frames = get("_frames").flatten().to_numpy(zero_copy_only=False)
        const["_start"] = frames[start[:-1]].astype(float)[:, None]
        const["_many"] = np.full((rows, 1), float(self.many))
        given = dict(states or {})
        for k in self.use - set(given):
            if batch.schema.get_field_index(f"_s_{k}") >= 0:
                given[k] = _table(get(f"_s_{k}"), self.kernels[k].state)
        result = {e: np.full((int(n.sum()), self.dims[e]), np.nan) for e in emit}
        out = {k: np.full((rows, self.kernels[k].state), np.nan) for k in self.ends}
        maps: dict[int, list] = {k: [None] * rows for k in self.maps}
        order = np.argsort(-n, kind="stable")
        done = 0
        while done < rows:
            # sorted by length, so the first lane tells how many of its kind fit
            take = order[done : done + max(1, min(LANES, CELLS // int(n[order[done]])))]
            done += len(take)
            with np.errstate(all="ignore"):
                x, ends, made = self._group(take, n, cols, {c: v[take] for c, v in const.items()}, given)
            for k, s in ends.items():
                out[k][take] = s
            for k, m in made.items():
                for lane, row in zip(take, m):
                    maps[k][lane] = row
            for e in emit:
                for j, lane in enumerate(take):
                    result[e][start[lane] : start[lane + 1]] = x[e][: n[lane], j]
        return result, start, out, maps

    def _group(self, take: np.ndarray, n: np.ndarray, cols: dict, const: Arrays, given: dict[int, np.ndarray]):
        steps, lanes = int(n[take[0]]), len(take)
        x: Arrays = {}
        for name in self.inputs:
            flat, off = cols[name]
            a = np.full((lanes, steps, self.dims[name]), np.nan)
            for i, lane in enumerate(take):
                a[i, : n[lane]] = flat[off[lane] : off[lane + 1]].reshape(-1, self.dims[name])
            x[name] = np.ascontiguousarray(a.transpose(1, 0, 2))
        active = np.searchsorted(-n[take], -np.arange(1, steps + 1), side="right")
        ends, maps = {}, {}
        for k, kernel in enumerate(self.kernels):
            if k in self.maps:
                # outputs that its state does not depend on may not be there yet
                unread = {u: np.full((steps, lanes, self.dims[u]), np.nan) for u in kernel.uses or () if u not in x}
                run = lambda state, kernel=kernel, seen=unread | x: kernel.step(seen, const, active, state.copy())[1]
                maps[k] = kernel.transfer.make(run, x, const, active)
            if k in self.use:
                state = given[k][take].copy() if k in given else np.full((lanes, kernel.state), np.nan)
                made, end = kernel.step(x, const, active, state)
                x.update(made)
                if k in self.ends:
                    ends[k] = end
        return x, ends, maps


def _run(p: Packed, kernels: Sequence[Kernel], emit: Sequence[str], keep: Sequence[str], many: bool = False) -> DataFrame:
    """Apply all kernels to every packed row: ``emit`` names outputs."""
    lanes = Lanes(p, kernels, range(len(kernels)), many=many)
    schema = T.StructType([p.df.schema[c] for c in keep])
    for name in emit:
        schema.add(f"_x_{name}", T.ArrayType(T.DoubleType()))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                result, start, _, _ = lanes(batch, emit)
                arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
                arrays += [_lists(result[e].reshape(-1), start * lanes.dims[e]) for e in emit]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return p.df.select(*dict.fromkeys([*keep, *lanes.columns(p)])).mapInArrow(apply, schema)


# ---------------------------------------------------------------- clips of several blocks


def _levels(kernels: Sequence[Kernel]) -> tuple[list[int], list[int]]:
    """The round that settles the states of each kernel, and the one behind which its outputs can be made.

    A state settles one round behind what it depends on, or two where it is guessed first.
    """
    made: dict[str, int] = {}
    settles, ready, guessed = [], [], 0
    for kernel in kernels:
        uses = [made[u] for u in (made if kernel.uses is None else kernel.uses) if u in made]
        reads = uses if kernel.reads is None else [made[r] for r in kernel.reads if r in made]
        level = 1 + max(reads, default=0)
        if kernel.transfer is None:
            level = guessed = max(level, guessed) + 1
        settles.append(level)
        ready.append(max([level, *uses]))
        made.update(dict.fromkeys(kernel.outputs, ready[-1]))
    return settles, ready


def _sent(batch: pa.RecordBatch, keep: Sequence[str], extra: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
    arrays += [pa.array([None if v is None else list(v) for v in extra[c]], pa.list_(pa.float64())) for c in extra]
    return pa.RecordBatch.from_arrays(arrays, names=[*keep, *extra])


def _described(p: Packed, kernels: Sequence[Kernel], known: Sequence[int], maps: Sequence[int], ends: Sequence[int]) -> DataFrame:
    """One row per block: known states, transfers ``_m_<k>`` and outgoing states ``_e_<k>``."""
    held = [c for c in p.df.columns if c.startswith("_s_")]
    keep = [*p.keys, "_block", *held]
    lanes = Lanes(p, kernels, [*known, *ends], ends, maps, many=True)
    schema = T.StructType([p.df.schema[c] for c in keep])
    for name in [*[f"_m_{k}" for k in maps], *[f"_e_{k}" for k in ends]]:
        schema.add(name, T.ArrayType(T.DoubleType()))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, _, out, made = lanes(batch, [])
                yield _sent(batch, keep, {f"_m_{k}": made[k] for k in maps} | {f"_e_{k}": list(out[k]) for k in ends}, None)

    return p.df.select(*dict.fromkeys([*keep, *lanes.columns(p)])).mapInArrow(apply, schema)


def _clips(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[list[dict]]:
    """The rows of each clip, from batches sorted by clip."""
    held: list[dict] = []
    for b in batches:
        for r in b.to_pylist():
            if held and any(held[0][k] != r[k] for k in keys):
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def _walked(rows: list[dict], kernels: Sequence[Kernel], maps: Sequence[int], guess: Sequence[int], again: Sequence[int]) -> bool:
    """Sets the incoming states of a clip's blocks in order; tells whether those run from again did move."""
    moved = False
    for k in [*maps, *guess, *again]:
        kernel = kernels[k]
        state = np.full(kernel.state, np.nan)
        for r in rows[::-1] if kernel.reverse else rows:
            was = r.get(f"_s_{k}")
            if k in maps:
                r[f"_s_{k}"] = state
                state = kernel.transfer.apply(np.array(r[f"_m_{k}"]), state)
            else:
                moved = moved or (k in again and _moved(np.array(was, float), state))
                r[f"_s_{k}"] = state
                state = np.array(r[f"_e_{k}"], float)
    return moved


def _moved(a: np.ndarray, b: np.ndarray) -> bool:
    same = (a == b) | (np.isnan(a) & np.isnan(b)) | (np.abs(a - b) <= TOL * (1 + np.abs(b)))
    return not bool(same.all())


def _settled(slim: DataFrame, p: Packed, kernels: Sequence[Kernel], maps: Sequence[int], guess: Sequence[int], again: Sequence[int]) -> DataFrame:
    """Transfers and guesses applied along each clip: (clip, block, states, ``_moved``: a guess of the clip was off)."""
    states = sorted({c for c in slim.columns if c.startswith("_s_")} | {f"_s_{k}" for k in [*maps, *guess, *again]})
    schema = T.StructType([slim.schema[c] for c in [*p.keys, "_block"]])
    for c in states:
        schema.add(c, T.ArrayType(T.DoubleType()))
    schema.add("_moved", T.BooleanType())
    keys = p.keys
    kinds = {f.name: f.type for f in _arrow_schema(T.StructType([slim.schema[c] for c in [*p.keys, "_block"]]))}

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _clips(batches, keys):
            moved = _walked(rows, kernels, maps, guess, again)
            arrays = [pa.array([r[c] for r in rows], kinds[c]) for c in [*keys, "_block"]]
            arrays += [pa.array([None if r[c] is None else list(r[c]) for r in rows], pa.list_(pa.float64())) for c in states]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([moved] * len(rows))], names=schema.names)

    return slim.repartition(*p.keys).sortWithinPartitions(*p.keys, "_block").mapInArrow(apply, schema)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _passed(p: Packed, kernels: Sequence[Kernel], known: Sequence[int], k: int) -> DataFrame:
    """Incoming states of kernel ``k`` where a guess moved: the clip's blocks pass in order, one at a time."""
    states = sorted(c for c in p.df.columns if c.startswith("_s_"))
    keys = p.keys
    keep = [*keys, "_block"]
    lanes = Lanes(p, kernels, [*known, k], [k], many=True)
    schema = T.StructType([p.df.schema[c] for c in [*keep, *states]])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clip, state = object(), None
        for whole in batches:
            for i in range(whole.num_rows):
                row = whole.slice(i, 1)
                now = tuple(row.column(row.schema.get_field_index(c))[0].as_py() for c in keys)
                if now != clip:
                    clip, state = now, np.full(kernels[k].state, np.nan)
                mine = {c: row.column(row.schema.get_field_index(c)).to_pylist() for c in states} | {f"_s_{k}": [state]}
                _, _, out, _ = lanes(row, [], {k: state[None, :]})
                yield _sent(row, keep, {c: mine[c] for c in states}, None)
                state = out[k][0]

    order = F.col("_block").desc() if kernels[k].reverse else F.col("_block")
    rows = p.df.select(*dict.fromkeys([*keep, *states, *lanes.columns(p)]))
    return rows.repartition(*p.keys).sortWithinPartitions(*p.keys, order).mapInArrow(apply, schema)


def _with_states(p: Packed, states: DataFrame | None) -> Packed:
    if states is None:
        return p
    names = [*p.keys, "_block"]
    other = states.select(*[F.col(c).alias(f"_k_{c}") for c in names], *[c for c in states.columns if c.startswith("_s_")])
    on = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in names]
    return replace(p, df=p.df.join(other, on).drop(*[f"_k_{c}" for c in names]))


def _long(p: Packed, kernels: Sequence[Kernel]) -> Packed:
    """Packed rows of clips that fill a block, with the incoming state of every kernel."""

    def filling(df: DataFrame) -> Packed:
        marked = df.withColumn("_long", F.when(_fills(p.block), F.lit(1)))
        return replace(p, df=marked.join(F.broadcast(p.guard), "_long").drop("_long"))

    rows = filling(p.df.drop("_rest"))
    settles, ready = _levels(kernels)
    states: DataFrame | None = None
    for level in range(1, max(settles, default=0) + 1):
        known = [k for k, at in enumerate(ready) if at < level]
        maps = [k for k, at in enumerate(settles) if at == level and kernels[k].transfer]
        # a guess is run from the start of a clip, then from where the predecessor ended
        guess = [k for k, at in enumerate(settles) if at == level + 1 and not kernels[k].transfer]
        again = [k for k, at in enumerate(settles) if at == level and not kernels[k].transfer]
        if not (maps or guess or again):
            continue
        slim = _described(_with_states(rows, states), kernels, known, maps, [*guess, *again])
        states = _settled(slim, p, kernels, maps, guess, again)
        for k in again:  # one at most, as guesses take turns
            off = _with_states(rows, states.where("_moved"))
            states = states.where("not _moved").drop("_moved").unionByName(_passed(off, kernels, known, k))
    return _with_states(filling(p.df), states)


def scan(p: Packed, kernels: Sequence[Kernel], emit: dict[str, int]) -> DataFrame:
    """Run the kernels one after another over each clip; returns packed rows with the outputs."""
    keep = [*p.keys, "_block", "_frames", *(["_rest"] if p.rest else [])]
    short = _run(replace(p, df=p.df.where(~_fills(p.block))), kernels, list(emit), keep)
    return short.unionByName(_run(_long(p, kernels), kernels, list(emit), keep, many=True))


def unpack(df: DataFrame, p: Packed, emit: dict[str, int], names: dict[str, str] | None = None) -> DataFrame:
    """Packed rows back to one row per frame; NaN outputs become NULL."""
    names = names or {}

    def value(i: Column, name: str, dim: int) -> Column:
        flat = F.col(f"_x_{name}")
        if dim == 1:
            return F.when(~F.isnan(flat[i]), flat[i])
        return F.when(~F.isnan(flat[i * dim]), F.slice(flat, i * dim + 1, dim))

    def one(i: Column) -> Column:
        parts = [F.col("_frames")[i].alias("frame_index")]
        parts += [F.col("_rest")[i][c].alias(c) for c in p.rest if c not in {names.get(e, e) for e in emit}]
        parts += [value(i, e, d).alias(names.get(e, e)) for e, d in emit.items()]
        return F.struct(*parts)

    rows = F.transform(F.sequence(F.lit(0), F.size("_frames") - 1), one)
    return df.select(*p.keys, F.inline(rows))


def recur(
    df: DataFrame,
    inputs: dict[str, int],
    kernels: Sequence[Kernel],
    emit: dict[str, int],
    names: dict[str, str] | None = None,
    keys: Sequence[str] = KEYS,
    block: int = FRAMES,
) -> DataFrame:
    """Pack, scan and unpack in one step."""
    p = pack(df, inputs, keys, block)
    return unpack(scan(p, kernels, emit), p, emit, names)
