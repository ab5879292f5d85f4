import random
import re

import pytest
from inputs import EDGES, prose

from trajloom.llm import near_dedup as nd
from trajloom.llm.common import components


def shingles(text, width):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < width else [tuple(w[k : k + width]) for k in range(len(w) - width + 1)])


def brute(rows, width):
    sets = [(i, shingles(t, width)) for i, t in rows]
    low = {i: i for i, _ in rows if i is not None}
    links = [
        (a, b) for k, (a, s) in enumerate(sets) for b, t in sets[:k]
        if None not in (a, b) and s and t and 100 * len(s & t) >= 80 * len(s | t)
    ]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            m = min(low[a], low[b])
            moved |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return sorted(
        ((i, len(s), low.get(i), i is None or low[i] == i) for i, s in sets), key=lambda r: tuple(map(str, r))
    )


def edited(text, seed, n):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(["alpha", "beta", "gamma"]) + str(rng.random())
    return " ".join(w)


def corpus():
    rows, base = list(EDGES), [prose(k, 60 + 20 * k) for k in range(5)]
    for k in range(120):
        text = base[k % 5]
        rows.append((200 + k, edited(text, k, k % 9) if k % 3 else text))
    passage = prose(77, 60)  # shared by many documents that are not near
    rows += [(400 + k, passage + " " + prose(500 + k, 40)) for k in range(60)]
    rows += [(500 + k, prose(900 + k, 3)) for k in range(40)]
    return rows


@pytest.mark.parametrize("width,block", [(2, 512), (5, 512), (2, 16)])
def test_equals_brute_force(spark, docs, monkeypatch, width, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "COMPARED", 2 * block)
    monkeypatch.setattr(nd, "MEMBERS", 7)
    monkeypatch.setattr(nd, "SENT_IDS", 10 if block == 16 else 1 << 20)
    rows = corpus()
    got = nd.near_duplicates(docs(rows), width=width).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: tuple(map(str, r))) == brute(rows, width)


@pytest.mark.parametrize("n,pool", [(3, 10), (60, 40), (60, 5000), (400, 300)])
def test_shared_counts(n, pool):
    rng = random.Random(n)
    sets = [nd.np.array(sorted({rng.randrange(pool) for _ in range(rng.randrange(30))}), nd.np.uint64) for _ in range(n)]
    group = nd.np.arange(n) * 3 // n
    got = nd.shared_counts(sets, group)
    for a in range(0, n, 7):
        for b in range(n):
            if a != b:
                want = len(set(sets[a].tolist()) & set(sets[b].tolist())) if group[a] == group[b] else 0
                assert got[a, b] == want


def test_collisions_follow_similarity():
    rng = random.Random(1)
    for share in (0.5, 0.8, 0.95):
        both = [rng.getrandbits(64) for _ in range(int(1000 * share))]
        rest = [rng.getrandbits(64) for _ in range(1000 - len(both))]
        cut = len(rest) // 2
        sets = [nd.np.array(sorted(both + r), nd.np.uint64) for r in (rest[:cut], rest[cut:])]
        a, b = nd.signatures(sets)
        assert abs((a == b).mean() - share) < 0.22


def test_chance_of_a_miss_is_small():
    from math import comb

    miss = sum(comb(nd.K, k) * 0.8**k * 0.2 ** (nd.K - k) for k in range(nd.T))
    assert miss < 1e-5


def test_components_of_paths_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200 + k, 200 + (k + 1) % 9) for k in range(9)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges + [(7, 7)], "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {k: 200 for k in range(200, 209)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table_and_threshold(docs):
    assert nd.near_duplicates(docs([])).count() == 0
    with pytest.raises(ValueError):
        nd.near_duplicates(docs([]), percent=70)


def test_an_id_of_several_texts_is_one_node(spark, docs):
    t, u, v = prose(1, 80), prose(2, 80), prose(3, 80)
    rows = [(5, t), (5, u), (3, u), (9, v), (9, t), (12, v), (20, edited(u, 4, 2)), (30, prose(9, 80)), (None, t), (40, None), (40, "")]
    got = nd.near_duplicates(docs(rows), 2).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.component_id, r.kept))
    assert by == {5: {(3, False)}, 3: {(3, True)}, 9: {(3, False)}, 12: {(3, False)}, 20: {(3, False)}, 30: {(30, True)}, None: {(None, True)}, 40: {(40, True)}}
