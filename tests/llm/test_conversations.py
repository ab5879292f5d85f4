import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from trajloom.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, k long, part int, rows string, d string, gone boolean"


def brute_audit(rows):
    """(cost, audit) by trying every edit, from the back."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    @cache
    def rest(i, state, inserts):
        options = [(0, "")] if i == len(rows) and state in ("", "a") else []
        due = "a" if state == "u" else "u"
        if inserts < 2:
            c, s = rest(i, due, inserts + 1)
            options.append((c + 3, "I" + s))
        if i < len(rows):
            initial, gone, cut = rows[i]
            c, s = rest(i + 1, state, 0)
            options.append((c + 4, "D" + s))
            if not gone:
                if (state, initial) in step:
                    c, s = rest(i + 1, step[state, initial], 0)
                    options.append((c + 3 * cut, "K" + s))
                c, s = rest(i + 1, due, 0)
                options.append((c + 3 + 3 * cut, "R" + s))
        return min(options, default=(10**9, ""))

    return rest(0, "", 0)


def brute(rows):
    """Facts of one conversation from its rows (turn, role, text) in order."""
    seen, marks, n = set(), [], {"b": 0, "d": 0, "t": 0}
    for _, role, text in rows:
        kind = ""
        if not re.search(r"[^\x20\x09-\x0D]", text):
            kind = "b"
        elif (role, text) in seen:
            kind = "d"
        elif not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text):
            kind = "t"
        seen.add((role, text))
        if kind:
            n[kind] += 1
        marks.append((role[:1], kind in ("b", "d"), kind == "t"))
    cost, audit = brute_audit(tuple(marks))
    out, i = [], 0
    for letter in audit:
        old = ("", "")
        if letter != "I":
            old, i = rows[i][1:], i + 1
        if letter == "D":
            continue
        due = "user" if not out or out[-1][0][:1] != "u" else "assistant"
        out.append((old[0] if letter == "K" else due, old[1]))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return gaps, n["b"], n["d"], n["t"], bad, cost, audit, sha


def expected(rows):
    convs = {}
    for c, turn, role, text, gone in rows:
        own = convs.setdefault(c, [])
        if not gone:
            own.append((turn, " " if role is None else role, " " if text is None else text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return sorted(((c, *brute(sorted(own, key=order))) for c, own in convs.items()), key=str)


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(0, longest) if c else 3 * longest):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "u", "", None])
            text = rng.choice(["Yes.", "No", "What?", "", " \t", "It is so.\n", None, "é 漢!", f"Number {rng.randint(0, 40)}.", "long " * 30])
            rows.append((c, rng.choice([t, t, t + 5, None]), role, text, rng.random() < 0.1))
        rows.append((c, 1, "user", "gone", True))
    return rows + [(None, 0, "user", "Hi.", False), (None, 1, "assistant", "Yes.", False), (999, None, None, None, True)]


@pytest.mark.parametrize(("block", "parts", "longest"), [(2048, 3, 9), (3, 7, 14), (1, 2, 8)])
def test_equals_brute_force(spark, block, parts, longest):
    rows = conversations(block, 60, longest)
    df = spark.createDataFrame([(*r[:4], 1, 2, "r", "d", r[4]) for r in rows], SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = cv.repaired(df, block=block).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_one_long_conversation(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"Row {rng.randint(0, 3000)}{rng.choice(['.', '', '!'])}", False) for t in range(6000)]
    df = spark.createDataFrame([(*r[:4], 1, 2, "r", "d", r[4]) for r in rows], SCHEMA)
    several = cv.repaired(df, block=500).collect()
    alone = cv.whole([r[1:4] for r in rows])
    assert len(several) == 1 and several[0].asDict() == {"conv_id": 1, **alone}


@pytest.mark.parametrize("weak", [False, True])
def test_prefixes_compare_as_strings(monkeypatch, weak):
    if weak:  # colliding hashes may cost time, never order
        monkeypatch.setattr(cv, "MOD", 3)
    rng = random.Random(9)
    trail, texts = cv.Trail(), [""]
    for _ in range(400):
        parent = rng.choice(range(max(0, len(texts) - 30), len(texts)))
        letter = rng.choice("DI")
        trail.add(parent, letter)
        texts.append(texts[parent] + letter)
    for _ in range(4000):
        a, b = rng.randrange(401), rng.randrange(401)
        assert "".join(trail.letters(a)) == texts[a]
        if texts[a] != texts[b]:
            assert trail.before(a, b) == (texts[a] < texts[b]), (texts[a], texts[b])


def test_damage(spark):
    rows = [(c, t, "assistant", "Is it? Yes.") for c in range(30) for t in range(6)] + [(None, 1, None, None), (7, None, "assistant", "Hm.")]
    got = cv.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = []
    for c, t, role, text in rows:
        w = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = "user" if w == 4 else role or " ", text or " "
        text = "" if w == 1 else re.sub("[.!?]", "", text) if w == 2 else text
        want += [(c, t, role, text, w == 0)] * (2 if w == 3 else 1)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {zlib.crc32(f"{c}:{t}".encode()) % 20 for c in range(30) for t in range(6)} >= set(range(5))


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cv.repaired(cv.damaged(df)).count() == 0
