"""Conversation structure repair by a persistent audit DP.

A conversation shall alternate user and assistant behind at most one system turn. Rows are
kept (K), given the role due (R) or deleted (D), and empty turns of the role due are
inserted (I). The role due follows from what stands before, so a repair is its string of
letters, and the cheapest repair whose string comes first is wanted.

Four states say what stands before: nothing, a system turn, a user turn, an assistant turn.
Behind every row the best prefix of each state is one node of a tree: its letter, its
parent, its ancestors at distances 1, 2, 4, ... and a rolling hash of its string. Prefixes
share their beginnings, and two of equal cost are compared by lifting both to the end of
their longest common prefix, which equal hashes mark; the prefixes are then checked to be
equal, letter by letter where they are not one node. (Of two prefixes of one state and cost
none begins with the other, as insertions alone would cost more, so what follows them
cannot turn their order.)

Rows are sorted by ranges of (conversation, turn), so a long conversation lies in many
tasks. A conversation that lies whole within a task and a block is repaired there. One that
does not is cut into blocks: a block returns the best string from each state to each state,
these tables are composed in order, and what the block repeats of earlier blocks is found
by an aggregate over digests first. Hashing a repaired conversation is sequential by its
nature: its blocks pass one task as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows and characters of a block.
BLOCK, BLOCK_CHARS = 2048, 8 << 20
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: State after a kept role initial, and after a turn of the role due.
AFTER = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
DUE = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
MOD, BASE = (1 << 61) - 1, 1_000_003

FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
#: Facts of a block that those of its conversation are made of.
EDGES = "rows long, low long, high long, turns long, first string, last string"


class Trail:
    """Strings that share their beginnings: linked nodes with ancestors at powers of two and rolling hashes."""

    def __init__(self):
        self.up: list[list[int]] = [[]]
        self.letter, self.hash, self.depth = [""], [0], [0]

    def add(self, parent: int, letter: str) -> int:
        ups, at = [parent], 0
        while len(self.up[ups[at]]) > at:
            ups.append(self.up[ups[at]][at])
            at += 1
        self.up.append(ups)
        self.letter.append(letter)
        self.hash.append((self.hash[parent] * BASE + hash_of(letter)) % MOD)
        self.depth.append(self.depth[parent] + 1)
        return len(self.up) - 1

    def lifted(self, node: int, steps: int) -> int:
        at = 0
        while steps:
            if steps & 1:
                node = self.up[node][at]
            steps >>= 1
            at += 1
        return node

    def before(self, a: int, b: int) -> bool:
        """Does the string of ``a`` come before that of ``b``?"""
        x, y = self.split(a, b)
        return self.letter[x] < self.letter[y] if x != y else self.depth[a] < self.depth[b]

    def split(self, a: int, b: int) -> tuple[int, int]:
        """The nodes just behind the longest common prefix; the same node twice where one string begins the other."""
        low = min(self.depth[a], self.depth[b])
        x, y = self.lifted(a, self.depth[a] - low), self.lifted(b, self.depth[b] - low)
        if x == y:
            return x, x
        same = self.hash[x] == self.hash[y]
        for at in range(len(self.up[x]) - 1, -1, -1):
            if not same and at < len(self.up[x]):
                p, q = self.up[x][at], self.up[y][at]
                if self.hash[p] != self.hash[q]:
                    x, y = p, q
        # What the hashes say is equal is checked: a difference found further up is the true one.
        found = None if same and self.letter[x] == self.letter[y] else (x, y)
        p, q = self.up[x][0], self.up[y][0]
        while p != q:
            if self.letter[p] != self.letter[q]:
                found = p, q
            p, q = self.up[p][0], self.up[q][0]
        return found or (x, x)

    def letters(self, node: int, stop: int = 0) -> list[str]:
        out = []
        while node != stop:
            out.append(self.letter[node])
            node = self.up[node][0]
        return out[::-1]


def hash_of(letter: str) -> int:
    return ord(letter) if len(letter) == 1 else int.from_bytes(hashlib.blake2b(letter.encode(), digest_size=7).digest(), "big")


class Best:
    """The best prefix of each state: cost and node, the node made when the prefix is used."""

    def __init__(self, trail: Trail, before):
        self.trail, self.before = trail, before
        self.of: dict[int, list] = {}

    def offer(self, state: int, cost: int, parent: int, letter: str) -> None:
        own = self.of.get(state)
        if own is not None:
            if cost > own[0]:
                return
            if cost == own[0]:
                new = self.trail.add(parent, letter)
                if not self.before(new, self.node(state)):
                    return
                own[:] = [cost, new, None]
                return
        self.of[state] = [cost, parent, letter]

    def node(self, state: int) -> int:
        own = self.of[state]
        if own[2] is not None:
            own[1:] = [self.trail.add(own[1], own[2]), None]
        return own[1]

    def insert(self) -> None:
        """Offer the turn due behind each state; a second one is due only behind a user turn."""
        for states in ((EMPTY, SYSTEM, ASSISTANT), (USER,)):
            for q in states:
                if q in self.of:
                    self.offer(DUE[q], self.of[q][0] + INSERT, self.node(q), "I")


def repairs(rows: list[tuple[str, bool, bool]], start: int, ends: bool) -> dict[int, tuple[int, str]]:
    """Cheapest (cost, audit) from ``start`` to each state over rows (initial, must go, truncated).

    Insertions stand before the row they precede; ``ends`` adds those behind the last one.
    """
    trail = Trail()
    now = Best(trail, trail.before)
    now.of[start] = [0, 0, None]
    for initial, gone, cut in rows:
        if not gone:
            now.insert()
        new = Best(trail, trail.before)
        for q in list(now.of):
            cost, node = now.of[q][0], now.node(q)
            new.offer(q, cost + DELETE, node, "D")
            if not gone:
                more = TRUNCATED if cut else 0
                if (q, initial) in AFTER:
                    new.offer(AFTER[q, initial], cost + KEEP + more, node, "K")
                new.offer(DUE[q], cost + REROLE + more, node, "R")
        now = new
    if ends:
        now.insert()
    return {q: (now.of[q][0], "".join(trail.letters(now.node(q)))) for q in now.of}


def finish(of: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """The better of the two states in which a conversation may end."""
    return min(of[q] for q in (EMPTY, ASSISTANT) if q in of)


def applied(rows: list[tuple], audit: str, state: int) -> tuple[list[str], int]:
    """``role:text`` of the repaired rows and the state behind them."""
    out, at = [], iter(rows)
    for letter in audit:
        if letter == "I":
            state = DUE[state]
            out.append(f"{ROLES[state]}:")
            continue
        _, role, text = next(at)
        if letter == "K":
            state = AFTER[state, role[:1]]
            out.append(f"{role}:{text}")
        elif letter == "R":
            state = DUE[state]
            out.append(f"{ROLES[state]}:{text}")
    return out, state


def digest(role: str, text: str) -> str:
    return hashlib.sha256(f"{role}\0{text}".encode("utf-8", "surrogatepass")).hexdigest()


def faults(rows: list[tuple], late: set[str]) -> tuple[list[tuple[str, bool, bool]], list[int]]:
    """What the DP reads of each row, and the counts of blank, duplicate and truncated rows."""
    seen, out, n = set(), [], [0, 0, 0]
    for _, role, text in rows:
        body = text.rstrip(SPACES)
        kind = None
        if not body:
            kind = 0
        elif (role, text) in seen or (late and digest(role, text) in late):
            kind = 1
        elif body[-1] not in ".!?":
            kind = 2
        seen.add((role, text))
        if kind is not None:
            n[kind] += 1
        out.append((role[:1], kind in (0, 1), kind == 2))
    return out, n


def edges(rows: list[tuple]) -> dict:
    """Turns and role initials at the ends of sorted rows."""
    turns = [t for t, _, _ in rows if t is not None]
    return {
        "rows": len(rows), "low": turns[0] if turns else None, "high": turns[-1] if turns else None, "turns": len(set(turns)),
        "first": rows[0][1][:1] if rows else None, "last": rows[-1][1][:1] if rows else None,
    }


def illegal(rows: list[tuple]) -> int:
    return sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(rows, rows[1:]))


def whole(rows: list[tuple]) -> dict:
    """The facts of a conversation from all its rows."""
    marks, n = faults(rows, set())
    cost, audit = finish(repairs(marks, EMPTY, True))
    e = edges(rows)
    text = "\n".join(applied(rows, audit, EMPTY)[0])
    gaps = e["high"] - e["low"] + 1 - e["turns"] if e["turns"] else 0
    sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
    return dict(zip(("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"), (gaps, *n, illegal(rows), cost, audit, sha)))


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(spark, ddl: str) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return ddl, to_arrow_schema(StructType.fromDDL(ddl))


def _rows(batches: Iterator[pa.RecordBatch], size: int = 1024) -> Iterator[dict]:
    for b in batches:
        for at in range(0, b.num_rows, size):
            yield from b.slice(at, size).to_pylist()


def _first(batches: Iterator[pa.RecordBatch], block: int, chars: int) -> Iterator[dict]:
    """Facts of conversations that lie whole in this task and a block; blocks of all others."""
    part = TaskContext.get().partitionId()
    none = object()
    conv, rows, size, cut, k = none, [], 0, True, 0

    def out(end: bool) -> dict:
        if not (cut or end):
            return {"conv_id": conv, **whole(rows)}
        turns, roles, texts = ([r[i] for r in rows] for i in range(3))
        own = {digest(r, t) for _, r, t in rows}
        return {"conv_id": conv, "part": part, "k": k, "turns": turns, "roles": roles, "texts": texts, "own": sorted(own)}

    first = True
    for r in _rows(batches):
        new = conv is none or r["conv_id"] != conv
        if conv is not none and (new or len(rows) >= block or size > chars):
            cut = cut or not new
            yield out(False)
            rows, size, k = [], 0, k + 1
            if new:
                cut = first = False
        if new:
            conv, cut = r["conv_id"], first
        if not r["gone"]:
            rows.append((r["turn"], r["role"], r["text"]))
            size += len(r["text"])
    if conv is not none:
        yield out(True)


def _table(r: dict) -> dict:
    """The best repairs of a block between all states, and what its conversation needs to know of it."""
    rows = list(zip(r["turns"], r["roles"], r["texts"]))
    marks, n = faults(rows, set(r["late"] or ()))
    costs, audits = [None] * 16, [None] * 16
    for p in range(4):
        for q, (cost, audit) in repairs(marks, p, False).items():
            costs[4 * p + q], audits[4 * p + q] = cost, audit
    facts = dict(zip(("blank", "duplicate", "truncated"), n)) | {"illegal": illegal(rows)}
    return {"conv_id": r["conv_id"], "part": r["part"], "k": r["k"], "costs": costs, "audits": audits, **facts, **edges(rows)}


def _composed(rows: Iterator[dict]) -> Iterator[dict]:
    """Conversations from the tables of their blocks in order: facts, and the states around each block."""
    none = object()
    conv = none
    for r in rows:
        if conv is none or r["conv_id"] != conv:
            if conv is not none:
                yield from end()
            conv, trail, places = r["conv_id"], Trail(), []

            def before(a: int, b: int, trail: Trail = trail) -> bool:
                x, y = a, b
                for at in range(len(trail.up[a]) - 1, -1, -1):
                    if at < len(trail.up[x]) and trail.up[x][at] != trail.up[y][at]:
                        x, y = trail.up[x][at], trail.up[y][at]
                stop = trail.up[x][0]
                return "".join(s[2:] for s in trail.letters(a, stop)) < "".join(s[2:] for s in trail.letters(b, stop))

            now = Best(trail, before)
            now.of[EMPTY] = [0, 0, None]
            sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
            low = high = last = None

            def end() -> Iterator[dict]:
                done = Best(trail, before)
                tails = [(q, f, *repairs([], q, True)[f]) for q in now.of for f in (EMPTY, ASSISTANT) if f in repairs([], q, True)]
                for q, _, cost, audit in tails:
                    done.offer(0, now.of[q][0] + cost, now.node(q), f"{q}0{audit}")
                chunks = trail.letters(done.node(0))
                gaps = high - low + 1 - sums["turns"] if low is not None else 0
                audit = "".join(s[2:] for s in chunks)
                facts = {c: sums[c] for c in ("blank", "duplicate", "truncated", "illegal")}
                yield {"conv_id": conv, "gaps": gaps, **facts, "cost": done.of[0][0], "audit": audit}
                for place, chunk in zip(places, chunks):
                    yield {"conv_id": conv, **place, "start": int(chunk[0]), "piece": chunk[2:], "tail": ""}
                yield {"conv_id": conv, **places[-1], "k": places[-1]["k"] + 1, "start": int(chunks[-1][0]), "piece": None, "tail": chunks[-1][2:]}

        places.append({"part": r["part"], "k": r["k"]})
        new = Best(trail, before)
        for p in list(now.of):
            for q in range(4):
                if r["costs"][4 * p + q] is not None:
                    new.offer(q, now.of[p][0] + r["costs"][4 * p + q], now.node(p), f"{p}{q}{r['audits'][4 * p + q]}")
        now = new
        for c in ("blank", "duplicate", "truncated", "illegal"):
            sums[c] += r[c]
        if r["rows"]:
            sums["illegal"] += last is not None and last + r["first"] not in LEGAL
            last = r["last"]
        if r["turns"]:
            sums["turns"] += r["turns"] - (high == r["low"])
            low, high = r["low"] if low is None else low, r["high"]
    if conv is not none:
        yield from end()


def _hashed(rows: Iterator[dict]) -> Iterator[dict]:
    """Digest of each repaired conversation from its blocks in order."""
    none = object()
    conv, sha, lines = none, None, 0
    for r in rows:
        if conv is none or r["conv_id"] != conv:
            if conv is not none:
                yield {"conv_id": conv, "sha": sha.hexdigest()}
            conv, sha, lines = r["conv_id"], hashlib.sha256(), 0
        if r["piece"] is None:
            made, _ = applied([], r["tail"], r["start"])
        else:
            made, _ = applied(list(zip(r["turns"], r["roles"], r["texts"])), r["piece"], r["start"])
        for line in made:
            sha.update((b"\n" if lines else b"") + line.encode("utf-8", "surrogatepass"))
            lines += 1
    if conv is not none:
        yield {"conv_id": conv, "sha": sha.hexdigest()}


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, gone) after the damage that crc32 of ``conv_id:turn`` deals."""
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    what = F.col("_what")
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    text = F.when(what == 1, "").when(what == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(what == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" ")))
    marked = rows.select("conv_id", "turn", "role", "text", F.pmod(F.crc32(named), F.lit(20)).alias("_what"))
    times = F.explode(F.sequence(F.lit(1), F.when(what == 3, 2).otherwise(1)))
    out = marked.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), (what == 0).alias("gone"), times.alias("_t"))
    return out.drop("_t")


def repaired(rows: DataFrame, block: int = BLOCK, chars: int = BLOCK_CHARS) -> DataFrame:
    """Per conversation conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    ``rows`` hold conv_id, turn, role, text and, if some only name their conversation, gone.
    They stand by turn, nulls first; rows of one turn by role and text. Null roles and texts
    are one space. Rows without conv_id are one conversation, of null id. A conversation
    without rows has zeros, an empty audit and the hash of an empty text. An empty table
    gives no rows; other columns are ignored. Equal rows of one turn stand in one task, as a
    stream.
    """
    spark = rows.sparkSession
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    slim = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], gone.alias("gone")
    )
    kind = slim.schema["conv_id"].dataType.simpleString()
    # A sampled key must stay short; the first characters of a text order rows as the text does.
    slim = slim.withColumns({"_r": F.substring("role", 1, 16), "_t": F.when(F.length("role") <= 16, F.substring("text", 1, 32))})
    slim = slim.repartitionByRange("conv_id", "turn", "_r", "_t").sortWithinPartitions("conv_id", "turn", "role", "text").drop("_r", "_t")
    ddl, schema = _arrow(spark, f"conv_id {kind}, {FACTS}, part int, k long, turns array<long>, roles array<string>, texts array<string>, own array<string>")
    first = stored(slim.mapInArrow(lambda b: _batches(_first(b, block, chars), schema), ddl), "conversations")
    done = first.where("part is null").select("conv_id", *[f.split()[0] for f in FACTS.split(", ")])
    blocks = first.where("part is not null").select("conv_id", "part", "k", "turns", "roles", "texts", "own")

    order = Window.partitionBy("conv_id", "d").orderBy("part", "k")
    late = blocks.select("conv_id", "part", "k", F.explode("own").alias("d")).withColumn("n", F.row_number().over(order))
    late = late.where("n > 1").groupBy("part", "k").agg(F.collect_set("d").alias("late"))
    ddl2, schema2 = _arrow(spark, f"conv_id {kind}, part int, k long, costs array<long>, audits array<string>, blank long, duplicate long, truncated long, illegal long, {EDGES}")
    tables = blocks.drop("own").join(late, ["part", "k"], "left")
    tables = stored(tables.mapInArrow(lambda b: _batches((_table(r) for r in _rows(b, 4)), schema2, 16), ddl2), "tables")

    ddl3, schema3 = _arrow(spark, f"conv_id {kind}, {FACTS}, part int, k long, start int, piece string, tail string")
    each = tables.repartition("conv_id").sortWithinPartitions("conv_id", "part", "k")
    made = stored(each.mapInArrow(lambda b: _batches(_composed(_rows(b, 16)), schema3), ddl3), "composed")
    ddl4, schema4 = _arrow(spark, f"conv_id {kind}, sha string")
    pieces = made.where("part is not null").select("conv_id", "part", "k", "start", "piece", "tail").join(blocks.drop("own", "conv_id"), ["part", "k"], "left")
    # The piece behind the last block has the number of no block, or of one of another conversation.
    pieces = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "k")
    sha = pieces.mapInArrow(lambda b: _batches(_hashed(_rows(b, 4)), schema4), ddl4)
    joined = made.where("part is null").drop("repaired_sha256").join(sha.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")))
    return done.unionByName(joined.withColumnRenamed("sha", "repaired_sha256").select(done.columns))
