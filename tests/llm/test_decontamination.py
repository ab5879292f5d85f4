import hashlib
import random
import re

import numpy as np
import pytest
from inputs import EDGES, prose

from trajloom.llm.decontamination import FmIndex, Wavelet, contamination, merge, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(doc, tests, width=13):
    w, hit, items = words(doc), set(), set()
    for item, text in tests:
        t = words(text)
        for k in range(max(1, len(t) - width + 1) if t else 0):
            g = t[k : k + width]
            for p in range(len(w) - len(g) + 1):
                if w[p : p + len(g)] == g:
                    hit |= set(range(p, p + len(g)))
                    items.add(str(item))
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return len(w), len(hit), len(items), digest, bool(hit) and 20 * len(hit) >= len(w)


def test_index_finds_every_place():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 5, 600)
    index = FmIndex(text, 5, sample=4)
    for size in (1, 2, 3, 5):
        for _ in range(20):
            at = int(rng.integers(0, 600 - size))
            pattern = text[at : at + size]
            if (pattern == 0).any():
                continue
            low, high = index.find(pattern[None, :], np.array([size]))
            got = sorted(index.locate(np.arange(low[0], high[0])).tolist())
            assert got == [k for k in range(600 - size + 1) if (text[k : k + size] == pattern).all()]


def test_wavelet_ranks():
    s = np.random.default_rng(2).integers(0, 37, 500)
    w = Wavelet(s, 37)
    at = np.arange(500)
    assert (w.rank(s, at) == [int((s[:k] == s[k]).sum()) for k in range(500)]).all()
    symbol, before = w.at(at)
    assert (symbol == s).all() and (before == w.rank(s, at)).all()


def test_suffixes_of_repeats():
    text = np.array([1, 2] * 20 + [0] + [1, 2] * 20)
    rank = text + len(text)
    rank[text == 0] = 0
    order = suffix_array(rank)
    assert order.tolist() == sorted(range(len(text)), key=lambda k: rank[k:].tolist())


def test_merge_joins_touching_spans():
    s, e = merge(np.array([5, 0, 2, 9]), np.array([7, 3, 5, 10]))
    assert s.tolist() == [0, 9] and e.tolist() == [7, 10]


@pytest.mark.parametrize("block", [1 << 24, 60])
def test_equals_brute_force(spark, docs, block):
    rng = random.Random(3)
    tests = [(k, prose(k, n)) for k, n in enumerate((30, 13, 14, 5, 1, 40))] + [(2, prose(99, 20)), (7, None), (8, ""), (None, "the of")]
    whole = []
    for k in range(30):
        t = prose(1000 + k, rng.randrange(0, 80))
        item = rng.choice(tests)[1] or ""
        w = item.split()
        cut = w[rng.randrange(0, len(w) // 2 + 1) :] if w else []
        whole.append((k, f"{t}! {' '.join(cut).upper()}? {t[:50]}"))
    whole += EDGES
    bench = spark.createDataFrame(tests, "item_id long, text string")
    named = [(i, t) for i, t in tests if i is not None and t]
    got = contamination(docs(whole), bench, block_bytes=block, shard_bytes=400).collect()
    order = lambda rows: sorted(rows, key=lambda r: tuple(str(x) for x in r))
    want = order([(i, *brute(t, named)) for i, t in whole])
    assert order([tuple(r)[:6] for r in got]) == want
    by = {i: t for i, t in whole if i is not None}
    for r in got:
        for s in r.spans:
            part = by.get(r.doc_id, "one").encode()[s.start : s.end].decode()
            assert len(words(part)) == s.words


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs([]), none).count() == 0
    assert [r.contaminated for r in contamination(docs([(1, "a b")]), none).collect()] == [False]
